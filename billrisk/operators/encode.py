"""Categories to numbers: weight of evidence and one-hot."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from billrisk.functions import flag, log_plus_one
from billrisk.operators.sizing import MAX_BROADCAST_ROWS, fetch_small
from billrisk.session import written

_SCHEMA = "feature string, value string, woe double"


def _woe(cnt: Column, late: Column) -> Column:
    """Log-odds of not late, two places; null when one of the classes is absent."""
    share_1 = F.try_divide(late, cnt)
    share_0 = F.try_divide(cnt - late, cnt)
    usable = (share_0 > 0) & (share_1 > 0)
    return F.when(usable, F.round(F.ln(share_0 / share_1), 2))


def _stacked(columns: Sequence[str]) -> Column:
    return F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in columns])


def fit_woe(df: DataFrame, columns: Sequence[str], label: str = "LatePmt2", strict: bool = False) -> DataFrame:
    """Weight of evidence of every category of every column, as (feature, value, woe, cnt).

    All columns are stacked and grouped in one pass; counts are combined
    before the shuffle.  Fit on training rows only to keep the label of the
    rows to be scored out of their features.  With ``strict`` null categories
    are left out, as they are by an inner join.
    """
    stacked = df.select(F.col(label).alias("_y"), F.inline(_stacked(columns)))
    if strict:
        stacked = stacked.where(F.col("value").isNotNull())
    return stacked.groupBy("feature", "value").agg(
        _woe(F.count(F.lit(1)), F.sum("_y")).alias("woe"), F.count(F.lit(1)).alias("cnt")
    )


def apply_woe(
    df: DataFrame, table: DataFrame, columns: Sequence[str], strict: bool = False, missing: float | None = 0.0,
    max_rows: int = MAX_BROADCAST_ROWS, salts: int = 16,
) -> DataFrame:
    """Add ``WOE_<column>`` for every column of the fitted table.

    A category without a usable value gets ``missing``.  ``strict`` keeps only
    rows whose categories are all in the table (an inner join).  A table of at
    most ``max_rows`` categories is sent to the rows.  Of a larger one only the
    most frequent categories are; the others meet the rows in one shuffle of
    all columns together, see ``_split_join``.
    """
    names = list(columns)
    # A table that proves too large is read again, and what it was counted from may be a join of large tables.
    held = None if table.is_cached else table.persist()
    try:
        rows = fetch_small(table.select("feature", "value", "woe"), max_rows)
        if rows is None:
            return _split_join(df, table, names, strict, missing, max_rows, salts)
    finally:
        if held is not None:
            held.unpersist()
    known = df.sparkSession.createDataFrame(rows, _SCHEMA)
    out = df
    for name in names:
        side = known.where(F.col("feature") == name).select(
            F.col("value").alias("_value"), F.col("woe").alias(f"WOE_{name}")
        )
        match = F.col(name).cast("string").eqNullSafe(F.col("_value"))
        out = out.join(F.broadcast(side), match, "inner" if strict else "left").drop("_value")
    if missing is not None:
        out = out.na.fill(missing, subset=[f"WOE_{name}" for name in names])
    return out


def _split_join(
    df: DataFrame, table: DataFrame, names: list[str], strict: bool, missing: float | None, max_rows: int, salts: int,
) -> DataFrame:
    """Weights from a table that is too large to be sent to the rows.

    The ``max_rows`` most frequent categories go to the rows, so what is left
    of the table holds no frequent one.  Each row stacks its categories that
    were not among them, for all columns; these meet the rest of the table by
    (column, category) and a salt, since a category that the table does not
    know at all may fill any share of the rows.  The weights come back by the
    number of the row.
    """
    table = written(table, "weights")
    top = table.orderBy(F.desc("cnt"), "feature", "value").limit(max_rows)
    frequent = written(top.select("feature", "value", "woe"), "frequent")
    rare = table.join(F.broadcast(frequent.select(F.col("feature").alias("f"), F.col("value").alias("v"))),
                      (F.col("feature") == F.col("f")) & F.col("value").eqNullSafe(F.col("v")), "left_anti")
    out = df.withColumn("_row", F.monotonically_increasing_id())
    for name in names:
        side = frequent.where(F.col("feature") == name).select(
            F.col("value").alias("_value"), F.struct("woe").alias(f"_w_{name}"))
        out = out.join(F.broadcast(side), F.col(name).cast("string").eqNullSafe(F.col("_value")), "left").drop("_value")
    out = written(out, "encoded")  # numbers of rows mean nothing if they are made anew
    open_ = F.filter(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value"), F.col(f"_w_{c}").isNull().alias("open"))
        for c in names]), lambda x: x["open"])
    asked = out.select("_row", F.inline(open_)).withColumn("_salt", F.pmod(F.xxhash64("_row"), F.lit(salts)).cast("int"))
    spread = rare.select(F.col("feature").alias("f"), F.col("value").alias("v"), "woe",
                         F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("s"))
    same = (F.col("feature") == F.col("f")) & F.col("value").eqNullSafe(F.col("v")) & (F.col("_salt") == F.col("s"))
    found = asked.join(spread, same).groupBy(F.col("_row").alias("_of")).agg(*[
        F.first(F.when(F.col("feature") == c, F.struct("woe")), ignorenulls=True).alias(f"_r_{c}") for c in names])
    joined = out.join(found, F.col("_row") == F.col("_of"), "left")
    weights = {c: F.coalesce(F.col(f"_w_{c}"), F.col(f"_r_{c}")) for c in names}
    if strict:
        for weight in weights.values():
            joined = joined.where(weight.isNotNull())
    values = [weight["woe"] if missing is None else F.coalesce(weight["woe"], F.lit(missing)) for weight in weights.values()]
    return joined.select(*df.columns, *[v.alias(f"WOE_{c}") for c, v in zip(names, values)])


def woe_encode(
    df: DataFrame, columns: Sequence[str], label: str = "LatePmt2", train: Column | None = None,
    strict: bool = False, keep: bool = False, missing: float | None = 0.0,
) -> DataFrame:
    """Fit (on the rows where ``train`` holds, by default on all) and apply; originals are dropped."""
    base = df if train is None else df.where(train)
    encoded = apply_woe(df, fit_woe(base, columns, label, strict), columns, strict, missing)
    return encoded if keep else encoded.drop(*columns)


def one_hot(
    df: DataFrame, values: Mapping[str, Sequence[str] | Mapping[str, str]], keep: bool = False,
) -> DataFrame:
    """``<column>_<value>`` is 1 on equality; null and unlisted values are 0 everywhere.

    A mapping in place of a list of values names the suffix of each value.
    All new columns come from one projection.
    """
    new = {}
    for name, listed in values.items():
        suffixes = listed if isinstance(listed, Mapping) else {v: v for v in listed}
        for value, suffix in suffixes.items():
            new[f"{name}_{suffix}"] = flag(F.col(name).cast("string") == F.lit(str(value)))
    out = df.select("*", *[expr.alias(name) for name, expr in new.items()])
    return out if keep else out.drop(*values)


def log_transform(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """log(x + 1) in place of each column, in one projection."""
    return df.withColumns({c: log_plus_one(F.col(c)) for c in columns})


def discover_values(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """The sorted categories of each column, for ``one_hot``.

    Each becomes a column name, so they are read to the driver as part of the
    schema.  For columns with many values use ``one_hot_vector``.
    """
    pairs = F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in columns
    ])
    found = df.select(F.inline(pairs)).where(F.col("value").isNotNull()).distinct()
    rows = found.collect()
    out: dict[str, list[str]] = {c: [] for c in columns}
    for row in sorted(rows):
        out[row["feature"]].append(row["value"])
    return out


def one_hot_vector(df: DataFrame, columns: Sequence[str], out: str = "encoded") -> DataFrame:
    """All categories of the columns in one sparse vector column each, ``<column>_<out>``; null is a category of its own."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StringIndexer

    indices = [f"_{c}_index" for c in columns]
    text = df.withColumns({f"_{c}_text": F.col(c).cast("string") for c in columns})
    index = StringIndexer(inputCols=[f"_{c}_text" for c in columns], outputCols=indices, handleInvalid="keep",
                          stringOrderType="alphabetAsc")
    encoder = OneHotEncoder(inputCols=indices, outputCols=[f"{c}_{out}" for c in columns], dropLast=False, handleInvalid="keep")
    made = Pipeline(stages=[index, encoder]).fit(text).transform(text)
    return made.drop(*indices, *[f"_{c}_text" for c in columns])
