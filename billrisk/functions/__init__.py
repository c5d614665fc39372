"""Column expressions shared by the operators."""

from billrisk.functions.buckets import late_class, late_class_text, late_interval
from billrisk.functions.codes import (
    area_code, binarize, flag, log_plus_one, map_values, normalize_date_text, year_offset,
)
from billrisk.functions.dates import as_int, as_number, clip_low, days_between, parse_date
from billrisk.functions.hashing import row_hash

__all__ = [
    "area_code", "as_int", "as_number", "binarize", "clip_low", "days_between", "flag",
    "late_class", "late_class_text", "late_interval", "log_plus_one", "map_values",
    "normalize_date_text", "parse_date", "row_hash", "year_offset",
]
