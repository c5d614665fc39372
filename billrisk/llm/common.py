"""Helpers shared by the operators: tables, words, hashes, frequent-token sketch."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from billrisk.session import free, materialize, scratch, tidy, written

__all__ = ["FrequencyClasses", "WordHashes", "bind", "free", "frequency_classes", "hash_runs", "hash_words", "materialize", "mix", "only", "packed", "read_table", "scratch",
           "shingle_hashes", "slices", "split_words", "tidy", "unpacked", "unused", "without", "written"]

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, also where the optimizer merges projections."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def unused(name: str, *frames: DataFrame) -> str:
    """``name``, lengthened until none of the frames has a column of that name."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id", broadcast_rows: int = 500_000) -> DataFrame:
    """The rows of ``docs`` whose id is not in the one column of ``ids``; a null there stands for null ids.

    At most ``broadcast_rows`` ids (8 bytes each) are sent to the documents, more meet them by shuffle.
    """
    gone = unused("_gone", docs)
    ids = materialize(ids.toDF(gone).distinct())
    side = F.broadcast(ids) if ids.count() <= broadcast_rows else ids
    return docs.join(side, F.col(id_col).eqNullSafe(F.col(gone)), "left_anti")


def only(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id", broadcast_rows: int = 500_000) -> DataFrame:
    """The rows of ``docs`` whose id is in the one column of ``ids``, by the same choice as in ``without``."""
    wanted = unused("_wanted", docs)
    ids = materialize(ids.toDF(wanted).distinct())
    side = F.broadcast(ids) if ids.count() <= broadcast_rows else ids
    return docs.join(side, F.col(id_col) == F.col(wanted), "left_semi")


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most ``rows`` rows, so that a task holds few texts at once."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def split_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text as UTF-8, A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def packed(text: str | None) -> bytes:
    """A text for the way to its partner in a pair: a third of its size or less."""
    return zstandard.compress((text or "").encode("utf-8", "surrogatepass"), 3)


def unpacked(data: bytes) -> str:
    return zstandard.decompress(data).decode("utf-8", "surrogatepass")


class WordHashes(dict):
    """64-bit hash of a word, remembered while a task runs: at most ``limit`` words of at most 64 bytes."""

    def __init__(self, limit: int = 1 << 17):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(word) <= 64:
            if len(self) >= self.limit:
                self.clear()
            self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit scrambling of every element."""
    x = x + _GOLDEN
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_STEP, _RUN_STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_SPACES = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def hash_runs(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: np.uint64 = _RUN_STEP) -> np.ndarray:
    """64-bit polynomial hash of values[start:end], scrambled; all runs at once from one prefix sum."""
    inverse = np.uint64(pow(int(base), -1, 1 << 64))
    upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * _powers(base, len(values)))])
    return mix((upto[ends] - upto[starts]) * _powers(inverse, len(values) + 1)[starts] + (ends - starts).astype(np.uint64))


def hash_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, place of the first byte) of every word of some UTF-8 bytes."""
    edge = np.flatnonzero(np.diff(~_SPACES[data], prepend=False, append=False))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    return hash_runs(data.astype(np.uint64) + np.uint64(1), starts, ends, _STEP), starts


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k words, in text order; a shorter text is one run."""
    n = len(words)
    if n == 0:
        return words
    if n < k:
        return np.array([xxhash.xxh64_intdigest(words.tobytes(), seed=n)], np.uint64)
    out = np.zeros(n - k + 1, np.uint64)
    for j in range(k):
        out = mix(out ^ words[j:n - k + 1 + j])
    return out


class FrequencyClasses:
    """How common a hashed token is in the whole corpus, coarsely, from counts per cell of a fixed-size table.

    Tokens in cells that stand out from the mean load get class 1, 2, ... (the
    logarithm of the excess), all others class 0.  The class is a function of
    the token alone, so ordering tokens by (class, hash) is the same order in
    every document; what the counts decide is only how long the lists get.
    The table has ``1 << bits`` bytes whatever the size of the corpus.
    """

    BITS = 18

    def __init__(self, table: np.ndarray):
        self.table = table

    @classmethod
    def cells(cls, tokens: np.ndarray) -> np.ndarray:
        return (tokens >> np.uint64(64 - 58)) & np.uint64((1 << cls.BITS) - 1)

    def of(self, tokens: np.ndarray) -> np.ndarray:
        return self.table[self.cells(tokens)]


def frequency_classes(docs: DataFrame, column: str, tokens_of, block: int = 0) -> FrequencyClasses:
    """``tokens_of()`` makes, inside a task, a function from a text, or from ``block`` texts, to hashed tokens."""
    size = 1 << FrequencyClasses.BITS

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        tokens, counts = tokens_of(), np.zeros(size, np.int64)
        for batch in batches:
            for i in range(0, batch.num_rows, block) if block else ():
                counts += np.bincount(FrequencyClasses.cells(tokens(batch.column(0).slice(i, block).to_pylist())).astype(np.int64), minlength=size)
            for text in () if block else batch.column(0).to_pylist():
                if text:
                    np.add.at(counts, FrequencyClasses.cells(tokens(text)).astype(np.int64), 1)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(counts[used])], ["cell", "n"])

    cells = docs.select(column).mapInArrow(tally, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    cells = materialize(cells)
    total = cells.agg(F.sum("n")).first()[0] or 0
    mean = total / size
    floor = mean + 6 * mean ** 0.5 + 32
    table = np.zeros(size, np.uint8)
    for row in cells.where(F.col("n") > floor).collect():  # at most one row per cell of the fixed table
        table[row.cell] = 1 + int(np.log2(row.n / floor))
    return FrequencyClasses(table)

