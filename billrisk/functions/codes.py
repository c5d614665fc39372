"""Flags and small code mappings."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def flag(condition: Column) -> Column:
    """1 where the condition holds; false and null give 0."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def binarize(col: Column) -> Column:
    """Any positive count becomes 1; other values are kept."""
    return F.when(col > 0, F.lit(1)).otherwise(col)


def map_values(col: Column, mapping: dict) -> Column:
    """Look values up in a small fixed mapping; anything else gives null."""
    out = None
    for key, value in mapping.items():
        out = F.when(col == F.lit(key), F.lit(value)) if out is None else out.when(col == F.lit(key), F.lit(value))
    return out


def area_code(pin: Column) -> Column:
    """The first two characters of the account key; the key stays text, zeros count."""
    return F.substring(pin, 1, 2)


def normalize_date_text(col: Column) -> Column:
    """Repair dates that went through a float: ``'3012019.0'`` becomes ``'03012019'``."""
    return F.lpad(F.regexp_replace(col, r"\.0$", ""), 8, "0")


def year_offset(col: Column, base: int) -> Column:
    """Years since ``base``, not below 0; null stays null."""
    return F.when(col < base, F.lit(0)).otherwise(col - F.lit(base))


def log_plus_one(col: Column) -> Column:
    """Natural log of ``x + 1``; null where that is not defined."""
    return F.when(col > -1, F.log1p(col))
