"""Exact ranks and running sums over groups of any size.

A window over one huge group runs in a single task.  Here rows are sorted by
range partitioning instead, where a group may span many partitions, and each
partition gets the total of the ones before it.  The sorted rows are
checkpointed: positions are only meaningful while the placement stays fixed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from billrisk.operators.sizing import small_side
from billrisk.session import materialize

_CHUNK_BITS = 33
_CHUNK, _OFFSET, _TIE = "_chunk", "_offset", "_tie"


def _sorted_chunks(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Range partition and sort; ``_chunk`` is the partition, ``_offset`` the row in it.

    The arrival number breaks ties, so that rows equal in every order column
    spread over partitions too.
    """
    numbered = df.withColumn(_TIE, F.monotonically_increasing_id())
    keys = [*order, F.col(_TIE).asc()]
    place = F.monotonically_increasing_id()
    placed = (
        numbered.repartitionByRange(*keys).sortWithinPartitions(*keys).drop(_TIE)
        .withColumn("_place", place)
    )
    placed = placed.withColumns({
        _CHUNK: F.shiftright("_place", _CHUNK_BITS),
        _OFFSET: F.col("_place").bitwiseAND(F.lit((1 << _CHUNK_BITS) - 1)),
    }).drop("_place")
    return materialize(placed)


def row_numbers(
    df: DataFrame, order: Sequence[Column], out: str, within: Sequence[str] = (), total: str | None = None,
) -> DataFrame:
    """``row_number`` over the whole frame, or within each group of ``within``.

    ``total`` adds the row count of the frame or group.  Meant for few groups
    (labels, classes): the table of starts has at most one row per partition
    plus one per group, and is broadcast only if it proves small.
    """
    sizes = [f"_g_{name}" for name in within]
    keys = [F.col(name).asc_nulls_first() for name in within]
    placed = _sorted_chunks(df, [*keys, *order])
    per_chunk = placed.groupBy(_CHUNK, *within).agg(
        F.count(F.lit(1)).alias("_n"), F.min(_OFFSET).alias("_first"),
    )
    # One row per sorted partition and group, so these windows are small.
    group = Window.partitionBy(*within)
    before = group.orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    starts = per_chunk.select(
        F.col(_CHUNK).alias("_c"), *[F.col(n).alias(g) for n, g in zip(within, sizes)],
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(group).alias("_total"),
    )
    match = F.col(_CHUNK) == F.col("_c")
    for name, g in zip(within, sizes):
        match = match & F.col(name).eqNullSafe(F.col(g))
    ranked = placed.join(small_side(starts), match).withColumn(
        out, F.col(_OFFSET) + F.col("_shift") + 1
    )
    if total is not None:
        ranked = ranked.withColumn(total, F.col("_total"))
    return ranked.drop(_CHUNK, _OFFSET, "_c", "_shift", "_total", "_first", *sizes)


def running_sums(
    df: DataFrame, within: Sequence[str], order: Sequence[Column], sums: Mapping[str, tuple[str, bool]],
) -> DataFrame:
    """Running sums in row order within groups that may be larger than one task can hold.

    ``sums`` maps an output column to ``(input column, include current row)``;
    a sum over no rows is null, as in a window.
    """
    keys = [F.col(name).asc_nulls_first() for name in within]
    placed = _sorted_chunks(df, [*keys, *order])
    inputs = sorted({name for name, _ in sums.values()})
    per_chunk = placed.groupBy(*within, _CHUNK).agg(
        *[F.sum(name).alias(f"_s_{name}") for name in inputs]
    )
    earlier = Window.partitionBy(*within).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carried = per_chunk.select(
        F.col(_CHUNK).alias("_c"), *[F.col(n).alias(f"_g_{n}") for n in within],
        *[F.sum(f"_s_{name}").over(earlier).alias(f"_before_{name}") for name in inputs],
    )
    match = F.col(_CHUNK) == F.col("_c")
    for name in within:
        match = match & F.col(name).eqNullSafe(F.col(f"_g_{name}"))
    local = Window.partitionBy(*within, _CHUNK).orderBy(_OFFSET)
    frames = {
        True: local.rowsBetween(Window.unboundedPreceding, 0),
        False: local.rowsBetween(Window.unboundedPreceding, -1),
    }
    inside = placed.withColumns({
        f"_in_{out}": F.sum(name).over(frames[current]) for out, (name, current) in sums.items()
    })
    joined = inside.join(small_side(carried), match)
    results = {}
    for out, (name, _) in sums.items():
        here, before = F.col(f"_in_{out}"), F.col(f"_before_{name}")
        zero = F.lit(0)
        results[out] = F.when(here.isNull() & before.isNull(), F.lit(None)).otherwise(
            F.coalesce(here, zero) + F.coalesce(before, zero)
        )
    extra = [_CHUNK, _OFFSET, "_c", *[f"_g_{n}" for n in within],
             *[f"_in_{o}" for o in sums], *[f"_before_{n}" for n in inputs]]
    return joined.withColumns(results).drop(*extra)
