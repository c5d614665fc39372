"""Training and test rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from billrisk.functions import as_int, row_hash
from billrisk.operators.ordering import row_numbers
from billrisk.operators.sizing import small_side

_HASH_BITS = 60
_BUCKET_BITS = 12


def is_test_year(test_year: int, year: str = "TaxYear") -> Column:
    return as_int(F.col(year)) == test_year


def year_members(test_year: int, n_years: int | None = None, year: str = "TaxYear") -> dict[str, Column]:
    """Which rows train and which test: the test year against all other years, or the ``n_years`` before it."""
    value = as_int(F.col(year))
    train = value != test_year
    if n_years is not None:
        train = (value < test_year) & (value >= test_year - n_years)
    return {"train": train, "test": value == test_year}


def split_by_year(
    df: DataFrame, test_year: int, n_years: int | None = None, year: str = "TaxYear",
) -> tuple[DataFrame, DataFrame]:
    """(train, test) by ``year_members``."""
    members = year_members(test_year, n_years, year)
    return df.where(members["train"]), df.where(members["test"])


def mark_random(df: DataFrame, key: str, train_share: float = 0.8, seed: int = 100, out: str = "is_train") -> DataFrame:
    """Flag about ``train_share`` of the rows, decided by a hash of the key alone."""
    limit = int(train_share * (1 << _HASH_BITS))
    return df.withColumn(out, (row_hash(F.col(key), seed) < F.lit(limit)).cast("int"))


def mark_stratified(
    df: DataFrame, label: str, key: str, train_share: float = 0.8, seed: int = 42, out: str = "is_train",
) -> DataFrame:
    """Flag exactly ``ceil(share * n)`` rows of each label as training rows.

    Rows of a label are ordered by the hash of their key.  Hash ranges are
    counted first; in each label only the one range that holds the cut needs
    its rows ranked, so the rest of the table is never shuffled.
    """
    if not 0 < train_share <= 1:
        raise ValueError("train_share must be above 0 and at most 1")
    shift = _HASH_BITS - _BUCKET_BITS
    hashed = df.withColumn("_h", row_hash(F.col(key), seed)).withColumn("_bucket", F.shiftright("_h", shift))
    cuts = _cut_buckets(hashed, label, train_share)
    match = F.col(label).eqNullSafe(F.col("_label"))
    placed = hashed.join(small_side(cuts), match, "left").drop("_label")
    sure = placed.where(F.col("_bucket") != F.col("_cut")).withColumn(
        out, (F.col("_bucket") < F.col("_cut")).cast("int")
    )
    order = [F.col("_h").asc(), F.col(key).asc_nulls_first()]
    ranked = row_numbers(placed.where(F.col("_bucket") == F.col("_cut")), order, "_rank", within=[label])
    cut = ranked.withColumn(out, (F.col("_rank") <= F.col("_left")).cast("int"))
    columns = [*df.columns, out]
    return sure.select(*columns).unionByName(cut.select(*columns))


def _cut_buckets(hashed: DataFrame, label: str, train_share: float) -> DataFrame:
    """Per label the bucket holding the last training row, and how many of its rows train."""
    counts = hashed.groupBy(label, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    by_label = Window.partitionBy(label)
    upto = by_label.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    totals = counts.select(
        F.col(label).alias("_label"), F.col("_bucket").alias("_cut"), "_n",
        F.sum("_n").over(upto).alias("_upto"),
        F.ceil(F.sum("_n").over(by_label) * F.lit(train_share)).alias("_train"),
    )
    before = F.col("_upto") - F.col("_n")
    return totals.where((before < F.col("_train")) & (F.col("_train") <= F.col("_upto"))).select(
        "_label", "_cut", (F.col("_train") - before).alias("_left")
    )


def parts(df: DataFrame, mark: str = "is_train") -> tuple[DataFrame, DataFrame]:
    """(train, test) of a flagged frame, without the flag."""
    return df.where(F.col(mark) == 1).drop(mark), df.where(F.col(mark) == 0).drop(mark)
