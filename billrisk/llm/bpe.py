"""Byte-level BPE: encoding with a contiguous rank array per word, and decoding."""

from __future__ import annotations

import heapq
import json
import struct
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

from billrisk.llm.common import slices

# Fixed value of the byte-level tokenizer format: how a text is cut before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_NONE = 1 << 30
_BYTES = [bytes([b]) for b in range(256)]


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in vocabulary files."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Tokens, merge ranks and special tokens of a vocabulary file (a few MB whatever the corpus)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        byte_of = byte_symbols()
        def raw(token: str) -> bytes:
            return bytes(byte_of[c] for c in token)
        self.ids = {raw(t): i for t, i in spec["model"]["vocab"].items()}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        self.ranks = {(raw(a), raw(b)): rank for rank, (a, b) in enumerate(pairs)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of = {i: t for t, i in self.ids.items()} | {i: t.encode() for t, i in self.special.items()}


class Encoder(dict):
    """Word -> its token ids as little-endian 32-bit integers; up to ``limit`` words of at most ``SHORT`` bytes are remembered."""

    SHORT = 200

    def __init__(self, ids: dict, ranks: dict, special: dict, limit: int = 1 << 17):
        super().__init__()
        self.ids, self.ranks, self.special_ids, self.limit = ids, ranks, special, limit
        self.find = regex.compile(PATTERN).findall
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")") if special else None

    def __missing__(self, word: str) -> bytes:
        raw = word.encode("utf-8", "surrogatepass")
        parts = self._short(raw) if len(raw) <= self.SHORT else self._long(raw)
        value = struct.pack(f"<{len(parts)}I", *map(self.ids.__getitem__, parts))
        if len(raw) <= self.SHORT:
            if len(self) >= self.limit:
                self.clear()
            self[word] = value
        return value

    def _short(self, word: bytes) -> list[bytes]:
        """Scan the ranks between neighbouring parts for the least, join these two, refresh their neighbours."""
        rank, parts = self.ranks.get, list(map(_BYTES.__getitem__, word))
        adjacent = list(map(rank, zip(parts, parts[1:]), repeat(_NONE)))
        while adjacent and (least := min(adjacent)) < _NONE:
            i = adjacent.index(least)
            parts[i] += parts.pop(i + 1)
            del adjacent[i]
            if i < len(adjacent):
                adjacent[i] = rank((parts[i], parts[i + 1]), _NONE)
            if i:
                adjacent[i - 1] = rank((parts[i - 1], parts[i]), _NONE)
        return parts

    def _long(self, word: bytes) -> list[bytes]:
        """The same merges with a heap, as scanning a very long word again and again is quadratic."""
        ranks, n = self.ranks, len(word)
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # of the part that starts at a place
        heap: list[tuple[int, int, int, int]] = []

        def offer(a: int) -> None:
            if a >= 0 and (b := end[a]) < n:
                r = ranks.get((word[a:b], word[b:end[b]]))
                if r is not None:
                    heapq.heappush(heap, (r, a, b, end[b]))

        for i in range(n - 1):
            offer(i)
        alive = [True] * n
        while heap:
            _, a, b, c = heapq.heappop(heap)
            if not (alive[a] and alive[b] and end[a] == b and end[b] == c):
                continue
            alive[b], end[a] = False, c
            if c < n:
                before[c] = a
            offer(a)
            offer(before[a])
        out, a = [], 0
        while a < n:
            out.append(word[a:end[a]])
            a = end[a]
        return out

    def encode(self, text: str) -> bytes:
        if self.special is None or not self.special.search(text):
            return b"".join(map(self.__getitem__, self.find(text)))
        pieces = []
        for part in self.special.split(text):
            if part in self.special_ids:
                pieces.append(np.array([self.special_ids[part]], "<u4").tobytes())
            elif part:
                pieces.extend(map(self.__getitem__, self.find(part)))
        return b"".join(pieces)


def bpe_encode(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids): ids as little-endian unsigned 32-bit integers, for whole texts.

    Null or empty text has no token.  Special tokens written in a text become
    their id.  One row per row, repeated and null ids included; an empty table
    gives an empty result; extra columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary.ids, vocabulary.ranks, vocabulary.special))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        encoder = Encoder(*shared.value)
        for batch in slices(batches):
            ids = [encoder.encode(text) if text else b"" for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                ["doc_id", "n_tokens", "ids"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def bpe_decode(tokens: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) of the rows of ``bpe_encode``; broken UTF-8 becomes U+FFFD, special tokens stay."""
    shared = tokens.sparkSession.sparkContext.broadcast(vocabulary.bytes_of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        token = shared.value.__getitem__
        for batch in slices(batches):
            texts = [b"".join(map(token, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")
                     for ids in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], ["doc_id", "n_tokens", "ids", "decoded"])

    return tokens.select("doc_id", "n_tokens", "ids").mapInArrow(
        run, "doc_id long, n_tokens long, ids binary, decoded string")


def public_vocabulary(spark: SparkSession, name: str = "byte_bpe_50k.json") -> Vocabulary:
    import public_tokenizers

    return Vocabulary(public_tokenizers.path(name))
