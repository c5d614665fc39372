"""Readers and writers."""

from billrisk.sources.loads import load_years, manifest, read_years
from billrisk.sources.readers import (
    BillScan, read_bills, read_bills_parquet, read_due_dates, read_payments, read_source_lookup,
    scan_bills, schema_from_header, union_years,
)
from billrisk.sources.writers import (
    load_model, save_model, write_bills_parquet, write_scores,
)

__all__ = [
    "BillScan", "load_model", "load_years", "manifest", "read_bills", "read_bills_parquet", "read_due_dates",
    "read_payments", "read_source_lookup", "read_years", "save_model", "scan_bills", "schema_from_header",
    "union_years", "write_bills_parquet", "write_scores",
]
