"""The most frequent values of columns with any number of different values, exactly.

A frequent-items sketch per column names candidates in one pass; a second pass
counts the candidates only, so that nothing but them is shuffled.  The sketch
bounds how often a value it does not name can occur.  Where that bound does not
rule all others out (a column without frequent values), the column is counted in
full.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

TRACKED = 10_000
_ERROR = 3.5  # a sketch of m items misses no value with more than this share of 1/m


def _code(name: str) -> Column:
    """The value as text, told apart from null, which is a value of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col(name).cast("string")), F.lit("null"))


def _value(code: Column) -> Column:
    return F.when(code != "null", F.substring(code, 2, 2_147_483_647))


def _stacked(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), _code(c).alias("code")) for c in columns])))


def top_values(df: DataFrame, columns: Sequence[str], k: int = 10, tracked: int = TRACKED) -> DataFrame:
    """(feature, rank, value, cnt, pct): the ``k`` most frequent values of each column, equal counts in value order.

    Null counts as a value and comes first among equals; pct is of all rows.
    """
    spark, names = df.sparkSession, list(columns)
    asked = min(tracked, 100 + 10 * k)
    coded = df.select([_code(c).alias(c) for c in names])
    sketch = coded.agg(F.count(F.lit(1)).alias("_rows"), *[
        F.expr(f"approx_top_k(`{c}`, {asked}, {tracked})").alias(c) for c in names]).first()
    rows = sketch["_rows"]
    candidates = [(c, item["item"], item["count"]) for c in names for item in sketch[c] or []]
    counts = []
    sure: set[str] = set()
    if candidates:
        table = F.broadcast(spark.createDataFrame([x[:2] for x in candidates], "f string, c string"))  # asked x columns
        hits = _stacked(df, names).join(table, (F.col("feature") == F.col("f")) & (F.col("code") == F.col("c")))
        counts = hits.groupBy("feature", "code").agg(F.count(F.lit(1)).alias("cnt")).collect()
    for c in names:
        exact = sorted((r.cnt for r in counts if r.feature == c), reverse=True)
        guesses = [x[2] for x in candidates if x[0] == c]
        others = max(min(guesses) if len(guesses) == asked else 0, _ERROR * rows / tracked)
        if sum(exact) == rows or (len(exact) >= k and exact[k - 1] > others):
            sure.add(c)
    parts = []
    if sure:
        listed = [(r.feature, r.code, r.cnt) for r in counts if r.feature in sure]
        parts.append(spark.createDataFrame(listed, "feature string, code string, cnt long") if listed else None)
    rest = [c for c in names if c not in sure]
    for c in rest:
        whole = df.groupBy(_code(c).alias("code")).agg(F.count(F.lit(1)).alias("cnt"))
        value = _value(F.col("code"))
        parts.append(whole.orderBy(F.desc("cnt"), value.asc_nulls_first()).limit(k).select(F.lit(c).alias("feature"), "code", "cnt"))
    parts = [p for p in parts if p is not None]
    if not parts:
        return spark.createDataFrame([], "feature string, rank int, value string, cnt long, pct double")
    all_ = reduce(DataFrame.unionByName, parts)  # at most (asked or k) x columns rows
    ordered = all_.groupBy("feature").agg(F.array_sort(F.collect_list(F.struct(
        (-F.col("cnt")).alias("less"), F.coalesce(_value(F.col("code")), F.lit("")).alias("text"),
        _value(F.col("code")).alias("value"), "cnt"))).alias("all"))
    return ordered.select("feature", F.posexplode(F.slice("all", 1, k)).alias("place", "v")).select(
        "feature", (F.col("place") + 1).alias("rank"), F.col("v.value").alias("value"), F.col("v.cnt").alias("cnt"),
        (F.col("v.cnt") * 100.0 / F.lit(float(rows or 1))).alias("pct"))
