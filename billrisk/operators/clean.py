"""Projections, casts and row filters.

The filters are plain column predicates, so Catalyst pushes them towards the
scan; those on raw text columns reach the file reader.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from billrisk.functions import as_int, as_number
from billrisk.schema import (
    AGENT_LABEL, AGENT_SOURCES, COLUMN_GROUPS, EXEMPT_STATUS, MAX_DAYS_LATE_1, MAX_DAYS_LATE_2,
    NUMERIC_COLUMNS, VALID_SEGMENT,
)
from billrisk.session import compiled_methods

# ------------------------------------------------------------------ columns


def select_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)


def drop_groups(df: DataFrame, groups: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Drop the named column groups, apart from the columns in ``keep``."""
    doomed = {c for g in groups for c in COLUMN_GROUPS[g]} - set(keep)
    return df.drop(*[c for c in df.columns if c in doomed])


def named_columns(df: DataFrame, names: Sequence[str] = (), positions: Sequence[tuple[int, int]] = ()) -> list[str]:
    """Columns of ``df`` by name and by stretches of positions, the end exclusive; what is not there is left out."""
    there = df.columns
    listed = [c for a, b in positions for c in there[a:b]] + [c for c in names if c in there]
    return list(dict.fromkeys(listed))


def cast_numeric(df: DataFrame, columns: Sequence[str] = tuple(NUMERIC_COLUMNS)) -> DataFrame:
    """Text amounts to double in one projection; bad text gives null."""
    return df.withColumns({c: as_number(F.col(c)) for c in columns if c in df.columns})


def cast_map(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast columns to the given types; bad text gives null."""
    casts = {}
    for name, target in types.items():
        col = F.col(name)
        casts[name] = as_int(col) if target == "int" else col.try_cast(target)
    return df.withColumns(casts)


def cast_strings_to_int(df: DataFrame, keep: Sequence[str] = ("PIN",)) -> DataFrame:
    """Every text column but ``keep`` to int."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in keep]
    return df.withColumns({c: as_int(F.col(c)) for c in text}) if text else df


def numeric_columns(df: DataFrame) -> list[str]:
    """Columns that are neither text nor a date."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.NumericType, T.BooleanType))]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def fill_zero(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Null to 0 in the chosen (by default all numeric) columns."""
    chosen = list(columns) if columns is not None else numeric_columns(df)
    return df.na.fill(0, subset=chosen) if chosen else df


# ------------------------------------------------------------------ filters


def valid_row() -> Column:
    return F.col("SegmentCode") == VALID_SEGMENT


def not_exempt() -> Column:
    return as_int(F.col("TaxStatus")) != EXEMPT_STATUS


def billed(mode: str = "both") -> Column:
    """``both``: something was billed on an instalment; ``either``: on each of them."""
    first, second = F.col("AdjustedAmountDue1") != 0, F.col("AdjustedTaxDue2") != 0
    if mode == "both":
        return first | second
    if mode == "either":
        return first & second
    raise ValueError("mode must be 'both' or 'either'")


def not_agent(columns: Sequence[str], codes: Sequence[str] = tuple(AGENT_SOURCES)) -> Column:
    """No payment through an agent; a null source is not accepted either."""
    condition = F.lit(True)
    for name in columns:
        condition = condition & ~F.col(name).isin(list(codes))
    return condition


def within_days(
    late1: str = "DiffPmt1", late2: str = "DiffPmt2", lower: int | None = None,
    max1: int = MAX_DAYS_LATE_1, max2: int = MAX_DAYS_LATE_2,
) -> Column:
    """Days late below the limits; with ``lower`` at least that many on both."""
    condition = (F.col(late2) < max2) & (F.col(late1) < max1)
    if lower is not None:
        condition = condition & (F.col(late2) >= lower) & (F.col(late1) >= lower)
    return condition


def keep_valid_rows(df: DataFrame) -> DataFrame:
    return df.where(valid_row())


def exclude_exempt(df: DataFrame) -> DataFrame:
    return df.where(not_exempt())


def exclude_zero_bills(df: DataFrame, mode: str = "both") -> DataFrame:
    return df.where(billed(mode))


def exclude_sources(
    df: DataFrame,
    columns: Sequence[str] = ("LastPaymentSource1", "LastPaymentSource2"),
    codes: Sequence[str] = tuple(AGENT_SOURCES),
    by_lookup: bool = False,
) -> DataFrame:
    """Drop agent payments by code, or by the label that ``attach_source`` added."""
    if by_lookup:
        for name in columns:
            df = df.where(F.col(name) != AGENT_LABEL)
        return df
    return df.where(not_agent(columns, codes))


def bound_days_late(df: DataFrame, lower: int | None = None, **limits) -> DataFrame:
    return df.where(within_days(lower=lower, **limits))


def drop_incomplete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows without any null in the chosen (by default all) columns.

    One condition per column: a single condition over dozens of columns makes
    the optimizer derive a variant for every subset of renamed columns later.
    """
    compiled_methods(df.sparkSession)
    known = F.lit(True)
    for name in columns if columns is not None else df.columns:
        known = known & F.col(name).isNotNull()
    return df.where(known)


def account_history(df: DataFrame, pin: str, columns: Sequence[str] | None = None) -> DataFrame:
    """All rows of one account."""
    rows = df.where(F.col("PIN") == pin)
    return rows.select(*columns) if columns is not None else rows
