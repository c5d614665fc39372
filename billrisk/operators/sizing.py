"""Size checks: what may be broadcast, and which keys are hot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

MAX_BROADCAST_ROWS = 100_000
MAX_ROWS_PER_KEY = 1_000_000


def fetch_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> list | None:
    """The rows of a small table, or None when it has more than ``max_rows``."""
    rows = df.take(max_rows + 1)
    return rows if len(rows) <= max_rows else None


def small_side(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Prepare the lookup side of a join.

    A table of at most ``max_rows`` rows becomes local rows with a broadcast
    hint, so it is computed once however often it is joined.  A larger one is
    returned as it is: Spark then shuffles it, and adaptive execution splits
    the hot keys of that join.
    """
    rows = fetch_small(df, max_rows)
    if rows is None:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def hot_keys(df: DataFrame, keys: Sequence[str], max_rows: int = MAX_ROWS_PER_KEY) -> DataFrame:
    """Keys with more than ``max_rows`` rows.

    Counts are combined before the shuffle, and at most ``rows / max_rows``
    keys can come out.
    """
    return (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > max_rows).select(*keys)
    )
