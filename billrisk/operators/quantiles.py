"""Exact percentiles of many columns without gathering a column in one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import ceil, floor

from pyspark.sql import Column, DataFrame, functions as F

from billrisk.operators.ordering import running_sums
from billrisk.session import compiled_methods

_ITEMS = 4000  # of a KLL sketch
_SLACK = 0.003  # of the rank; several times the sketch's usual error

Brackets = Mapping[str, list[tuple[float, float]]]


def _known(name: str) -> Column:
    value = F.col(name).cast("double")
    return F.when(~F.isnan(value), value).alias(name)


def exact_percentiles_of(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float],
) -> dict[str, list[float | None]]:
    """Linear-interpolated percentiles of every column; nulls and NaN do not count.

    One scan sketches all columns, which brackets each wanted rank.  One more
    scan counts all columns together: a value between the brackets is only
    counted, one inside also keeps its value, and the few that are left are
    ranked.  A column whose brackets miss a rank is ranked in full, so the
    result is exact in any case.
    """
    compiled_methods(df.sparkSession)  # conditions on brackets of all columns in one projection
    names = list(columns)
    values = df.select([_known(c) for c in names])
    marks = F.array(*[F.lit(p) for q in probabilities for p in (max(q - _SLACK, 0.0), min(q + _SLACK, 1.0))])
    sketched = values.agg(*[e for i, c in enumerate(names) for e in (
        F.count(c).alias(f"n{i}"), F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}"),
        F.kll_sketch_agg_double(c, F.lit(_ITEMS)).alias(f"s{i}"))])
    row = sketched.select(*[f"{p}{i}" for i in range(len(names)) for p in ("n", "lo", "hi")], *[
        F.when(F.col(f"n{i}") > 0, F.kll_sketch_get_quantile_double(f"s{i}", marks)).alias(f"q{i}")
        for i in range(len(names))]).first()
    full = [i for i in range(len(names)) if row[f"n{i}"]]
    places = {names[i]: [q * (row[f"n{i}"] - 1) for q in probabilities] for i in full}
    brackets = {names[i]: _merged(list(zip(row[f"q{i}"][::2], row[f"q{i}"][1::2]))) for i in full}
    found = _ranked(values, brackets, places) if full else {}
    missed = {names[i]: [(row[f"lo{i}"], row[f"hi{i}"])] for i in full
              if any((names[i], r) not in found for p in places[names[i]] for r in (floor(p), ceil(p)))}
    if missed:
        found.update(_ranked(values, missed, {c: places[c] for c in missed}))

    def between(name: str, place: float) -> float:
        low, high = found[name, floor(place)], found[name, ceil(place)]
        return low + (high - low) * (place - floor(place))

    return {c: [between(c, p) for p in places[c]] if c in places else [None] * len(probabilities) for c in names}


def _merged(intervals: list[tuple[float, float]]) -> list[tuple[float, float]]:
    out: list[tuple[float, float]] = []
    for low, high in sorted(intervals):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out


def _ranked(values: DataFrame, brackets: Brackets, places: Mapping[str, list[float]]) -> dict[tuple[str, int], float]:
    """(column, rank) -> value for the ranks around ``places`` that lie inside a bracket."""
    def stretch(name: str) -> Column:
        """Odd inside a bracket, even between them, rising with the value."""
        steps = [F.when(F.col(name) >= low, 1).otherwise(0) + F.when(F.col(name) > high, 1).otherwise(0)
                 for low, high in brackets[name]]
        return sum(steps[1:], steps[0])

    long = values.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.when(F.col(c).isNotNull(), stretch(c)).alias("stretch"), F.col(c).alias("v"))
        for c in brackets]))).where("stretch is not null")
    counted = long.groupBy("feature", "stretch", F.when(F.col("stretch") % 2 == 1, F.col("v")).alias("v")).agg(
        F.count(F.lit(1)).alias("n"))
    upto = running_sums(counted, ["feature"], [F.col("stretch").asc(), F.col("v").asc_nulls_first()], {"upto": ("n", True)})
    wanted = sorted({(c, r) for c, ps in places.items() for p in ps for r in (floor(p), ceil(p))})
    asked = values.sparkSession.createDataFrame(wanted, "of string, rank long")  # two per column and percentile
    hits = upto.join(F.broadcast(asked), (F.col("feature") == F.col("of")) & (F.col("rank") < F.col("upto"))
                     & (F.col("rank") >= F.col("upto") - F.col("n")))
    return {(r.of, r.rank): r.v for r in hits.where("v is not null").select("of", "rank", "v").collect()}


def exact_percentiles(df: DataFrame, column: str, probabilities: Sequence[float]) -> list[float | None]:
    """``exact_percentiles_of`` one column."""
    return exact_percentiles_of(df, [column], probabilities)[column]


def winsorize(df: DataFrame, columns: str | Sequence[str], low: float = 0.01, high: float = 0.99) -> DataFrame:
    """Pull values outside the two percentiles of their column to them, all columns at once; null stays null."""
    names = [columns] if isinstance(columns, str) else list(columns)
    bounds = {c: b for c, b in exact_percentiles_of(df, names, [low, high]).items() if b[0] is not None}
    return df.withColumns({
        c: F.when(F.col(c) < lo, F.lit(lo)).when(F.col(c) > hi, F.lit(hi)).otherwise(F.col(c))
        for c, (lo, hi) in bounds.items()})
