"""Counts, shares, rates, histograms and correlations.

Every report is one pass over the rows with counts combined before the
shuffle; later steps work on the small grouped result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame, functions as F, types as T

from billrisk.operators.clean import numeric_columns
from billrisk.operators.correlation import pairwise_correlations


def _count() -> Column:
    return F.count(F.lit(1))


def _long(df: DataFrame, columns: Sequence[str], name: str, value: str, keep: Sequence[str] = ()) -> DataFrame:
    """Columns to (name, value) rows; values as text."""
    pairs = F.array(*[
        F.struct(F.lit(c).alias(name), F.col(c).cast("string").alias(value)) for c in columns
    ])
    return df.select(*keep, F.inline(pairs))


# ------------------------------------------------------------- group counts


def univariate(df: DataFrame, column: str) -> DataFrame:
    """Count and percentage of all rows per category; null is a category of its own.

    The total comes from the grouped counts as a scalar subquery that reuses
    their shuffle: no second scan, and no window over all categories.
    """
    counts = df.groupBy(column).agg(_count().alias("cnt"))
    total = counts.agg(F.sum("cnt")).scalar()
    return counts.select(column, "cnt", (F.col("cnt") * 100.0 / total).alias("pct"))


def top_categories(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    """The ``k`` most frequent categories; equal counts in category order."""
    return univariate(df, column).orderBy(F.desc("cnt"), F.col(column).asc_nulls_first()).limit(k)


def near_constant(df: DataFrame, columns: Sequence[str], limit: float = 0.95) -> DataFrame:
    """Share of the most frequent category per column, and whether it exceeds ``limit``."""
    counts = _long(df, columns, "feature", "value").groupBy("feature", "value").agg(_count().alias("n"))
    share = counts.groupBy("feature").agg((F.max("n") * 1.0 / F.sum("n")).alias("top_share"))
    return share.withColumn("near_constant", (F.col("top_share") > limit).cast("int"))


def group_counts(df: DataFrame, keys: Sequence[str], out: str = "cnt") -> DataFrame:
    return df.groupBy(*keys).agg(_count().alias(out))


def group_sums(df: DataFrame, keys: Sequence[str], sums: Mapping[str, str], digits: int | None = None) -> DataFrame:
    """Sums per group; ``sums`` maps output to input column."""
    def total(column: str) -> Column:
        return F.sum(column) if digits is None else F.round(F.sum(column), digits)

    return df.groupBy(*keys).agg(*[total(c).alias(o) for o, c in sums.items()])


def distinct_counts(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Number of different non-null values per column, as one row."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(*[count(c).alias(c) for c in columns])


def category_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The different values of each column as (feature, value) rows."""
    return _long(df, columns, "feature", "value").distinct()


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Nulls per column as (feature, nulls) rows, from one aggregate."""
    chosen = list(columns) if columns is not None else df.columns
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in chosen])
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("nulls")) for c in chosen])
    return counted.select(F.inline(pairs))


def late_rate_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows and the percentage late on each instalment, per key."""
    return df.groupBy(*keys).agg(
        _count().alias("n"),
        (F.sum("LatePmt1") * 100.0 / _count()).alias("late1_pct"),
        (F.sum("LatePmt2") * 100.0 / _count()).alias("late2_pct"),
    )


def late_rate_levels(df: DataFrame, levels: Sequence[Sequence[str]]) -> DataFrame:
    """``late_rate_by`` at several levels in one pass and one shuffle.

    Each level is a set of keys, the empty one the total.  Keys that are not
    part of a row's level are null; ``level`` numbers the levels from 0, so a
    null key of a level differs from a key left out.
    """
    keys = list(dict.fromkeys(k for level in levels for k in level))
    left_out = [sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in level) for level in levels]
    if len(set(left_out)) < len(left_out):
        raise ValueError("levels repeat")
    which = F.lit(None).cast("int")
    for number, mask in enumerate(left_out):
        which = F.when(F.col("_mask") == mask, number).otherwise(which)
    grouped = df.groupingSets([[F.col(k) for k in level] for level in levels], *keys)
    return grouped.agg(
        F.grouping_id().alias("_mask"), _count().alias("n"),
        (F.sum("LatePmt1") * 100.0 / _count()).alias("late1_pct"),
        (F.sum("LatePmt2") * 100.0 / _count()).alias("late2_pct"),
    ).select(which.alias("level"), *keys, "n", "late1_pct", "late2_pct")


# ------------------------------------------------------------------ audits


def filter_funnel(df: DataFrame, steps: Mapping[str, Column]) -> DataFrame:
    """Rows left after each filter, in order, from a single pass."""
    condition, counts = F.lit(True), [_count().alias("s0")]
    for i, predicate in enumerate(steps.values(), 1):
        condition = condition & predicate
        counts.append(F.count_if(condition).alias(f"s{i}"))
    names = ["all", *steps]
    rows = F.array(*[
        F.struct(F.lit(i).alias("step"), F.lit(name).alias("filter"), F.col(f"s{i}").alias("rows_left"))
        for i, name in enumerate(names)
    ])
    return df.agg(*counts).select(F.inline(rows))


def audit_counts(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """Rows meeting each condition, as one row."""
    return df.agg(*[F.count_if(c).alias(name) for name, c in checks.items()])


def audit_rates(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """Percentage of all rows meeting each condition; null does not meet it."""
    return df.agg(*[(F.count_if(c) * 100.0 / _count()).alias(name) for name, c in checks.items()])


# The consistency questions asked of the bills.
def bill_checks() -> dict[str, Column]:
    due, received = F.col("AdjustedAmountDue1"), F.col("LastPaymentReceivedAmount1")
    rate, second = F.col("TaxRate"), F.col("AdjustedTaxDue2")
    sold = F.col("PastTaxSaleStatus") == "Y"
    return {
        "charged_nothing_due": (due != 0) & (F.col("TotalAmountDue1") == 0),
        "odd_rate": (rate < 30) & (rate > 0) & (second > 0),
        "due_not_received": due != received,
        "past_sale": sold,
        "past_sale_and_sale": sold & (F.col("TaxSale") == 1),
        "past_sale_no_sale": sold & (F.col("TaxSale") == 0),
    }


def stage_sizes(stages: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and columns of each stage, all counted by one query.

    Steps shared by several stages are planned once where Spark can reuse
    their shuffles; a cached stage is only read.
    """
    counts = [
        df.agg(F.lit(i).alias("step"), F.lit(name).alias("stage"), _count().alias("rows"),
               F.lit(len(df.columns)).alias("columns"))
        for i, (name, df) in enumerate(stages.items(), 1)
    ]
    return reduce(lambda a, b: a.unionByName(b), counts)


def stage_counts(df: DataFrame, members: Mapping[str, Column], columns: Mapping[str, int] | None = None) -> DataFrame:
    """``stage_sizes`` of stages that are subsets of one frame, from a single pass.

    ``members`` says which rows each stage holds (null is no).  ``columns`` gives
    the number of columns of stages with another projection.
    """
    width = dict(columns or {})
    counted = df.agg(*[F.count_if(F.coalesce(m, F.lit(False))).alias(f"s{i}") for i, m in enumerate(members.values())])
    return counted.select(F.inline(F.array(*[
        F.struct(F.lit(i + 1).alias("step"), F.lit(name).alias("stage"), F.col(f"s{i}").alias("rows"),
                 F.lit(width.get(name, len(df.columns))).alias("columns"))
        for i, name in enumerate(members)])))


# -------------------------------------------------------------- histograms


def histogram_edges(df: DataFrame, column: str, edges: Sequence[float]) -> DataFrame:
    """Counts in ``[e0, e1), ... [e(k-1), ek]``; values outside are ignored, empty bins are 0.

    Rows at or above each edge are counted in one aggregate, and bins are the
    differences: no row is assigned to a bin, and only one row is shuffled.
    """
    value, last = F.col(column), len(edges) - 1
    counts = [F.count_if(value >= F.lit(e)).alias(f"a{i}") for i, e in enumerate(edges[:-1])]
    counts.append(F.count_if(value > F.lit(edges[-1])).alias(f"a{last}"))
    bins = F.array(*[
        F.struct(
            F.lit(i).alias("bin"), F.lit(float(edges[i])).alias("low"), F.lit(float(edges[i + 1])).alias("high"),
            (F.col(f"a{i}") - F.col(f"a{i + 1}")).alias("n"),
        )
        for i in range(last)
    ])
    return df.select(column).agg(*counts).select(F.inline(bins))


def histogram_bins(df: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """Counts in ``bins`` bins of equal width between the smallest and largest value."""
    low, high = df.agg(F.min(column).cast("double"), F.max(column).cast("double")).first()
    if low is None:
        return _count_bins(df.select(F.lit(None).cast("int").alias("bin")), [(0, 0.0, 0.0)])
    width = (high - low) / bins
    if width == 0:
        return _count_bins(df.select(F.when(F.col(column).isNotNull(), 0).alias("bin")), [(0, low, high)])
    raw = F.floor((F.col(column).cast("double") - F.lit(low)) / F.lit(width)).cast("int")
    which = F.when(F.col(column).isNotNull(), F.least(raw, F.lit(bins - 1)))
    spec = [(i, low + i * width, low + (i + 1) * width) for i in range(bins)]
    return _count_bins(df.select(which.alias("bin")), spec)


def _count_bins(binned: DataFrame, spec: list[tuple[int, float, float]]) -> DataFrame:
    counts = binned.where(F.col("bin").isNotNull()).groupBy("bin").agg(_count().alias("n"))
    schema = T.StructType([
        T.StructField("bin", T.IntegerType()), T.StructField("low", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
    ])
    frame = binned.sparkSession.createDataFrame(spec, schema)
    return frame.join(counts, "bin", "left").select(
        "bin", "low", "high", F.coalesce("n", F.lit(0)).alias("n")
    )


# ------------------------------------------------------------- correlation

CORRELATION_SCHEMA = "a string, b string, r double"


def correlation_matrix(
    df: DataFrame, columns: Sequence[str] | None = None, nulls: str = "pairwise", digits: int = 6,
) -> DataFrame:
    """Pearson correlations as (a, b, r) rows, both triangles and the diagonal.

    ``pairwise`` uses for each pair the rows where both are known, all pairs
    from one state of co-moments.  ``complete`` uses rows without any null and
    the matrix computation of Spark ML.
    """
    names = list(columns) if columns is not None else numeric_columns(df)
    if nulls == "complete":
        return _ml_correlation(df, names, digits)
    if nulls != "pairwise":
        raise ValueError("nulls must be 'pairwise' or 'complete'")
    return pairwise_correlations(df, names, digits)


def _ml_correlation(df: DataFrame, names: list[str], digits: int) -> DataFrame:
    known = df.select([F.col(c).cast("double").alias(c) for c in names]).na.drop("any")
    vectors = VectorAssembler(inputCols=names, outputCol="corr_features").transform(known)
    matrix = Correlation.corr(vectors.select("corr_features"), "corr_features").first()[0].toArray()
    rows = [
        (a, b, 1.0 if a == b else round(float(matrix[i][j]), digits))
        for i, a in enumerate(names) for j, b in enumerate(names)
    ]
    return df.sparkSession.createDataFrame(rows, CORRELATION_SCHEMA)


def prune_correlated(correlations: DataFrame, columns: Sequence[str], limit: float = 0.5) -> list[str]:
    """Columns to keep: in the given order, those not tied to an earlier kept one by ``|r| > limit``.

    Works on the columns x columns table, which is small whatever the data.
    """
    strong = correlations.where((F.col("a") != F.col("b")) & (F.abs("r") > limit)).select("a", "b")
    linked = {(r["a"], r["b"]) for r in strong.collect()}  # bounded by the schema: columns x columns
    kept: list[str] = []
    for name in columns:
        if not any((name, other) in linked for other in kept):
            kept.append(name)
    return kept
