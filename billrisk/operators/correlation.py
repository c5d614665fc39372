"""Pearson correlations of many columns from one mergeable state.

Every task reduces its rows to the co-moments of all pairs of columns: how many
rows know both, and the sums, squares and products over those.  States add up,
so the plan has the same few steps for five columns and for five hundred, and
what is shuffled depends on the columns alone.  Values are taken relative to the
column's mean, so that large amounts lose no digits.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

_STATE = ["n", "sx", "sy", "sxx", "syy", "sxy"]
_LEAST_SPREAD = 1e-10  # of the squares: below it a column is constant up to rounding


def _known(name: str) -> Column:
    """The value as double; null if it is unknown, NaN or infinite."""
    value = F.col(name).cast("double")
    return F.when(~F.isnan(value) & (F.abs(value) < float("inf")), value).alias(name)


def co_moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(i, j, n, sx, sy, sxx, syy, sxy) for each pair i < j of positions in ``columns``, over rows that know both."""
    names = list(columns)
    values = df.select([_known(c) for c in names])
    first = values.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(names)]).first()
    centre = np.array([x if x is not None else 0.0 for x in first])
    upper = np.triu_indices(len(names), 1)

    def state(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        n = np.zeros((len(names), len(names)))
        sums, squares, products = n.copy(), n.copy(), n.copy()
        for batch in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1) - centre
            there = ~np.isnan(x)
            x = np.where(there, x, 0.0)
            weight = there.astype(np.float64)
            n += weight.T @ weight
            sums += x.T @ weight  # of the row's column, where the other is known
            squares += (x * x).T @ weight
            products += x.T @ x
        parts = [n[upper].astype(np.int64), sums[upper], sums.T[upper], squares[upper], squares.T[upper], products[upper]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(upper[0].astype(np.int32)), pa.array(upper[1].astype(np.int32)), *map(pa.array, parts)], ["i", "j", *_STATE])

    states = values.mapInArrow(state, "i int, j int, n long, " + ", ".join(f"{s} double" for s in _STATE[1:]))
    return states.groupBy("i", "j").agg(*[F.sum(s).alias(s) for s in _STATE])


def pearson() -> Column:
    """The coefficient from the columns of ``co_moments``; null without spread or with fewer than two rows."""
    n, sx, sy, sxx, syy, sxy = map(F.col, _STATE)
    vx, vy = sxx - sx * sx / n, syy - sy * sy / n
    r = (sxy - sx * sy / n) / F.sqrt(vx) / F.sqrt(vy)
    usable = (n > 1) & (vx > _LEAST_SPREAD * sxx) & (vy > _LEAST_SPREAD * syy)
    return F.when(usable, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))


def pairwise_correlations(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """(a, b, r) for all pairs in both orders and the diagonal, each over the rows that know both values."""
    names, spark = list(columns), df.sparkSession
    same = [(c, c, 1.0) for c in names]
    if len(names) < 2:
        return spark.createDataFrame(same, "a string, b string, r double")
    pairs = spark.createDataFrame(
        [(i, j, names[i], names[j]) for i, j in combinations(range(len(names)), 2)], "pi int, pj int, a string, b string")
    found = co_moments(df, names).select("i", "j", F.round(pearson(), digits).alias("r"))
    cells = pairs.join(F.broadcast(found), (F.col("pi") == F.col("i")) & (F.col("pj") == F.col("j")), "left")
    both = cells.select(F.inline(F.array(F.struct("a", "b", "r"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"), "r"))))
    return both.unionByName(spark.createDataFrame(same, "a string, b string, r double"))
