"""Running history per account.

An account normally has a handful of bills, and one window over ``PIN`` serves
all history columns with a single exchange and sort.  Accounts with more rows
than one task should hold are taken out first and handled by range
partitioning, so a hot key cannot stall the job; the results are the same.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from billrisk.functions import as_int
from billrisk.operators.ordering import running_sums
from billrisk.operators.sizing import MAX_ROWS_PER_KEY, fetch_small, hot_keys, small_side
from billrisk.session import written


@dataclass(frozen=True)
class HistorySum:
    """One history column.

    ``frame="range"`` gives all bills of one year the same sum; ``"rows"``
    counts row by row.  ``include_current=False`` sums strictly earlier rows
    and is 0 on the first one.
    """

    column: str
    frame: str = "rows"
    include_current: bool = True


# The three history features of the classifier.
STANDARD_HISTORY = {
    "PastTaxSaleStatusSum": HistorySum("PastTaxSaleStatus", frame="range"),
    "LatePmt2Sum": HistorySum("LatePmt2", include_current=False),
    "LatePmt1Sum": HistorySum("LatePmt1"),
}

_YEAR = "_history_year"
_MANY = object()


def history_sums(
    df: DataFrame,
    features: Mapping[str, HistorySum] = STANDARD_HISTORY,
    key: str = "PIN",
    year: str = "TaxYear",
    tie_break: Sequence[str] = (),
    max_rows_per_key: int | None = MAX_ROWS_PER_KEY,
) -> DataFrame:
    """Add running sums per account in year order.

    ``tie_break`` orders bills of one year for the row-wise sums.  Keys with
    more than ``max_rows_per_key`` rows take the range-partitioned way; None
    says that no such key exists and saves the check.
    """
    dated = df.withColumn(_YEAR, as_int(F.col(year)))
    order = [F.col(_YEAR).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in tie_break]]
    hot = _hot_frame(dated, key, max_rows_per_key)
    if hot is None:
        return _by_window(dated, features, key, order).drop(_YEAR)
    # The rows are read five times from here on, and what made them may be a join of large tables.
    dated = written(dated, "history-rows")
    if hot is _MANY:
        hot = written(hot_keys(dated, [key], max_rows_per_key).withColumnRenamed(key, "_hot"), "hot-keys")
    # A null key is one group like any other, so the match is null-safe.
    is_hot = F.col(key).eqNullSafe(F.col("_hot"))
    cold_rows = dated.join(hot, is_hot, "left_anti")
    hot_rows = dated.join(hot, is_hot, "left_semi")
    cold = _by_window(cold_rows, features, key, order)
    return cold.unionByName(_by_ranges(hot_rows, features, key, order)).drop(_YEAR)


def _hot_frame(df: DataFrame, key: str, limit: int | None):
    """The keys with more than ``limit`` rows, ``_MANY`` if they are too many to be sent to the rows, None without any."""
    if limit is None:
        return None
    keys = hot_keys(df, [key], limit).withColumnRenamed(key, "_hot")
    rows = fetch_small(keys)
    if rows is None:
        return _MANY
    if not rows:
        return None
    return F.broadcast(df.sparkSession.createDataFrame(rows, keys.schema))


def _finish(feature: HistorySum, total: Column) -> Column:
    return total if feature.include_current else F.coalesce(total, F.lit(0))


def _by_window(df, features, key, order) -> DataFrame:
    rows = Window.partitionBy(key).orderBy(*order)
    whole_years = Window.partitionBy(key).orderBy(order[0])
    first = Window.unboundedPreceding

    def total(feature: HistorySum) -> Column:
        if feature.frame == "range":
            window = whole_years.rangeBetween(first, 0)
        else:
            window = rows.rowsBetween(first, 0 if feature.include_current else -1)
        return F.sum(feature.column).over(window)

    return df.withColumns({out: _finish(f, total(f)) for out, f in features.items()})


def _by_ranges(df, features, key, order) -> DataFrame:
    by_row = {o: f for o, f in features.items() if f.frame == "rows"}
    by_year = {o: f for o, f in features.items() if f.frame == "range"}
    out = df
    if by_row:
        out = running_sums(out, [key], order, {o: (f.column, f.include_current) for o, f in by_row.items()})
        out = out.withColumns({o: _finish(f, F.col(o)) for o, f in by_row.items()})
    if by_year:
        # Sums per account and year first (combined before the shuffle), then
        # a window over at most one row per year.
        sums = {o: f.column for o, f in by_year.items()}
        yearly = df.groupBy(key, _YEAR).agg(*[F.sum(c).alias(f"_y_{o}") for o, c in sums.items()])
        upto = Window.partitionBy(key).orderBy(F.col(_YEAR).asc_nulls_first())
        upto = upto.rowsBetween(Window.unboundedPreceding, 0)
        yearly = yearly.select(
            F.col(key).alias("_k"), F.col(_YEAR).alias("_y"),
            *[F.sum(f"_y_{o}").over(upto).alias(o) for o in sums],
        )
        match = F.col(key).eqNullSafe(F.col("_k")) & F.col(_YEAR).eqNullSafe(F.col("_y"))
        out = out.join(small_side(yearly), match).drop("_k", "_y")
    return out.select(*df.columns, *features)
