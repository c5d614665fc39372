"""Codes for vectors: each of several equal parts becomes the number of its nearest codebook entry.

All numbers are integers: a component x counts as floor(scale * x).  A codebook
per part starts as that part of the rows with the smallest ids and is refined
in rounds of assignment and integer means.  The nearest entry is found with
fixed pivots (LAESA): the distances of every part to a few pivot points are
computed once and written beside the vectors; in each round only the distances
between pivots and entries are new, and their differences bound every distance
from below, so that entries are tried in the order of the bound and most of them
are never measured.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from billrisk.llm.common import written

_EXACT = 1 << 24  # below it, a squared distance of up to 32 components is exact in a double
_BLOCK = 2048
_SLACK = 1e-12  # relative error allowed for roots of exact integers


def to_integers(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x): doubles if all are small, Python integers otherwise, exact in both cases."""
    out = np.floor(values * scale)
    if out.size == 0 or (np.isfinite(out).all() and np.abs(out).max() < _EXACT):
        return out
    return np.array([math.floor(x) * scale if abs(x) >= 2.0 ** 53 else math.floor(x * scale) for x in values.ravel().tolist()],
                    object).reshape(values.shape)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared Euclidean distance along the last axis."""
    return ((a - b) ** 2).sum(axis=-1)


def _root(d: int) -> float:
    if d < 1 << 1000:
        return math.sqrt(d)
    root = math.isqrt(d)
    return float(root) if root < 1 << 1023 else 2.0 ** 1023


def _alike(*arrays: np.ndarray) -> list[np.ndarray]:
    """All as Python integers if one of them is: a double next to a huge integer would not be exact."""
    if all(a.dtype != object for a in arrays):
        return list(arrays)
    return [a if a.dtype == object else np.array([int(x) for x in a.ravel()], object).reshape(a.shape) for a in arrays]


def _roots(d: np.ndarray) -> np.ndarray:
    if d.dtype != object:
        return np.sqrt(d)
    return np.array([_root(x) for x in d.ravel()], np.float64).reshape(d.shape)


def choose_pivots(entries: np.ndarray, number: int) -> np.ndarray:
    """Of the entries of one part, some that lie far apart: the first, then each time the one farthest from those chosen."""
    chosen = [0]
    nearest = squared(entries, entries[0])
    while len(chosen) < min(number, len(entries)):
        chosen.append(int(np.argmax(nearest)))
        nearest = np.minimum(nearest, squared(entries, entries[chosen[-1]]))
    return entries[chosen]


def nearest_entries(points: np.ndarray, pivot_roots: np.ndarray, entries: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(index, squared distance, number of distances measured) of the nearest entry of each point, ties to the lower index.

    ``pivot_roots`` holds the distances of the points to the pivots.  Each turn
    measures, for every point still open, the untried entry with the least lower
    bound; a point is closed when that bound exceeds its best distance.
    """
    entry_roots = _roots(squared(entries[:, None], pivots[None]))
    bound = np.zeros((len(points), len(entries)))
    for k in range(len(pivots)):
        a, b = pivot_roots[:, k, None], entry_roots[None, :, k]
        np.maximum(bound, np.abs(a - b) - _SLACK * (a + b), out=bound)
    every = np.arange(len(points))
    index = bound.argmin(axis=1)
    best = squared(points, entries[index])
    bound[every, index] = np.inf
    measured, rows = len(points), every
    while len(rows):
        left = bound[rows]
        tried = left.argmin(axis=1)
        open_ = left[every[:len(rows)], tried] <= _roots(best[rows]) * (1 + _SLACK)
        rows, tried = rows[open_], tried[open_]
        bound[rows, tried] = np.inf
        d = squared(points[rows], entries[tried])
        measured += len(rows)
        better = (d < best[rows]) | ((d == best[rows]) & (tried < index[rows]))
        index[rows[better]], best[rows[better]] = tried[better], d[better]
    return index, best, measured


def assign(values: np.ndarray, pivot_roots: np.ndarray, codebooks: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) per row and part; ``values`` is rows x parts x components."""
    values, codebooks, pivots = _alike(values, codebooks, pivots)
    index = np.empty(values.shape[:2], np.uint8 if codebooks.shape[1] <= 256 else np.int64)
    error = np.empty(values.shape[:2], values.dtype)
    for a in range(0, len(values), _BLOCK):
        for part in range(values.shape[1]):
            index[a:a + _BLOCK, part], error[a:a + _BLOCK, part], _ = nearest_entries(
                values[a:a + _BLOCK, part], pivot_roots[a:a + _BLOCK, part], codebooks[part], pivots[part])
    return index, error


def _sums(values: np.ndarray, index: np.ndarray, entries: int) -> tuple[np.ndarray, np.ndarray]:
    """Component sums and numbers of the rows of each (part, entry), as Python integers."""
    parts, width = values.shape[1:]
    cell = index.astype(np.int64) + np.arange(parts) * entries
    n = np.bincount(cell.ravel(), minlength=parts * entries)
    flat = values.reshape(-1, width)
    if values.dtype == object:
        total = np.zeros((parts * entries, width), object)
        np.add.at(total, cell.ravel(), flat)
    else:
        total = np.stack([np.bincount(cell.ravel(), flat[:, i], parts * entries) for i in range(width)], axis=1) \
            if width else np.zeros((parts * entries, 0))
        total = total.astype(np.int64).astype(object)
    return total.reshape(parts, entries, width), n.reshape(parts, entries)


def _moved(codebooks: np.ndarray, total: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Entries replaced by the floored mean of their parts; unused ones stay."""
    return np.where(n[..., None] > 0, total // np.maximum(n, 1)[..., None].astype(object), codebooks)


def _numbers(codebooks: np.ndarray) -> np.ndarray:
    """Doubles where these are exact, as in ``to_integers``."""
    return codebooks.astype(np.float64) if codebooks.size == 0 or max(abs(x) for x in codebooks.ravel()) < _EXACT else codebooks


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dimension)


@dataclass
class VectorCodes:
    """``rows``: (id, label, code, error); ``codebooks``: parts x entries x components."""

    rows: DataFrame
    codebooks: np.ndarray

    def digest(self) -> str:
        return hashlib.sha256(",".join(str(int(x)) for x in self.codebooks.ravel()).encode()).hexdigest()


def encode_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                   parts: int = 16, entries: int = 64, rounds: int = 2, pivots: int = 4, scale: int = 256) -> VectorCodes:
    """Codes of all rows whose vector is given and has finite components only; ``entries`` is at most 256.

    The first codebooks are the rows with the smallest ids (of equal ids the
    smaller vector comes first), null ids not counted; with fewer rows there are
    fewer entries.  The length of vectors is that of the first such row and has
    to be a multiple of ``parts``; a vector of another length stays as a row
    with null code and error.  Errors beyond a long are null.  Repeated and null
    ids keep their rows, extra columns are ignored, an empty table gives an
    empty result and empty codebooks.
    """
    if not 0 < entries <= 256:
        raise ValueError("codes hold two hex digits per part")
    value = F.col(vector_col)
    bad = F.exists(value, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = vectors.where(value.isNotNull() & ~bad).select(
        F.col(id_col).alias("id"), F.col(label_col).alias("label"), value.alias("vector"))
    first = kept.where("id is not null").orderBy("id", "vector").limit(entries).collect()  # at most ``entries`` rows
    dimension = len(first[0].vector) if first else 0
    if dimension % parts:
        raise ValueError(f"vectors of {dimension} components cannot be cut into {parts} equal parts")
    width = dimension // parts
    same = [r.vector for r in first if len(r.vector) == dimension]
    start = np.array(same, np.float64).reshape(len(same), parts, width)
    books = np.array([int(x) for x in to_integers(start, scale).ravel()], object).reshape(start.shape).transpose(1, 0, 2)
    fixed = np.array([choose_pivots(book, pivots) for book in books], object) if len(start) else books

    label_type, id_type, vector_type = (kept.schema[c].dataType.simpleString() for c in ("label", "id", "vector"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        near = _numbers(fixed)
        for batch in batches:
            values, points = _alike(to_integers(_matrix(batch.column("vector"), dimension), scale).reshape(len(batch), parts, width), near)
            roots = np.stack([_roots(squared(values[:, j, None], points[j][None])) for j in range(parts)], axis=1)
            flat = pa.array(roots.ravel())
            step = roots.shape[1] * roots.shape[2]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, step), pa.int32()), flat)],
                ["id", "label", "vector", "roots"])

    fitting = kept.where(F.size("vector") == dimension)
    shape = f"id {id_type}, label {label_type}, vector {vector_type}"
    if not len(start):
        none = kept.select("id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
        return VectorCodes(none, books)
    table = written(fitting.mapInArrow(measure, shape + ", roots array<double>"), "vectors")

    def places(batch: pa.RecordBatch, near: np.ndarray, now: np.ndarray):
        values = to_integers(_matrix(batch.column("vector"), dimension), scale).reshape(len(batch), parts, width)
        roots = batch.column("roots").flatten().to_numpy(zero_copy_only=False).reshape(len(batch), parts, -1)
        return values, *assign(values, roots, now, near)

    for _ in range(rounds):
        def add_up(batches: Iterator[pa.RecordBatch], books=books) -> Iterable[pa.RecordBatch]:
            near, now = _numbers(fixed), _numbers(books)
            total, n = np.zeros(books.shape, object), np.zeros(books.shape[:2], np.int64)
            for batch in batches:
                values, index, _ = places(batch, near, now)
                t, m = _sums(values, index, books.shape[1])
                total, n = total + t, n + m
            cell = np.flatnonzero(n)
            amounts = total.reshape(-1, width)[cell]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell, pa.int32()), pa.array(n.ravel()[cell], pa.int64()),
                 pa.array([",".join(map(str, row)) for row in amounts], pa.string())], ["cell", "n", "total"])

        def merged(x, y):
            return x[0] + y[0], x[1] + y[1]

        states = table.select("vector", "roots").mapInArrow(add_up, "cell int, n long, total string")
        cells = states.rdd.map(lambda r: (r.cell, (r.n, np.array([int(x) for x in r.total.split(",") if x], object)))).reduceByKey(merged)
        total, n = np.zeros(books.shape, object), np.zeros(books.shape[:2], np.int64)
        for cell, (m, amounts) in cells.collect():  # one row per part and entry
            n.ravel()[cell], total.reshape(-1, width)[cell] = m, amounts
        books = _moved(books, total, n)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        near, now = _numbers(fixed), _numbers(books)
        for batch in batches:
            _, index, error = places(batch, near, now)
            digits = index.astype(np.uint8).tobytes().hex()
            sums = [int(x) for x in error.sum(axis=1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"),
                 pa.array([digits[i:i + 2 * parts] for i in range(0, len(digits), 2 * parts)], pa.string()),
                 pa.array([x if x < 1 << 63 else None for x in sums], pa.int64())], ["id", "label", "code", "error"])

    coded = table.mapInArrow(code, f"id {id_type}, label {label_type}, code string, error long")
    others = kept.where(F.size("vector") != dimension).select(
        "id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    return VectorCodes(written(coded.unionByName(others), "codes"), books)


def with_label_error(rows: DataFrame, broadcast_rows: int = 100_000, salts: int = 64) -> DataFrame:
    """``rows`` with ``label_error``, the errors of equal labels (nulls together) added up; null beyond a long.

    Sums combine before the shuffle.  Up to ``broadcast_rows`` labels go to the
    rows, more meet them by a shuffle in which every label is spread over
    ``salts`` places, so that a hot label does not fill one task.
    """
    key = [F.col("label").isNull().alias("_none"), F.col("label").alias("_label")]
    totals = written(rows.groupBy(*key).agg(F.try_sum("error").alias("label_error")), "labels")
    same = (F.col("label").isNull() == F.col("_none")) & F.col("label").eqNullSafe(F.col("_label"))
    if totals.count() <= broadcast_rows:
        joined = rows.join(F.broadcast(totals), same, "left")
    else:
        spread = totals.withColumn("_there", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        here = rows.withColumn("_here", F.pmod(F.xxhash64("id", "code"), F.lit(salts)).cast("int"))
        joined = here.join(spread, same & (F.col("_here") == F.col("_there")), "left").drop("_here", "_there")
    return joined.drop("_none", "_label")
