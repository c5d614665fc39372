"""Alignment of two tokenizers over whole texts: groups of tokens that cover the same bytes, and how often ids meet.

Both tokenizers read a space and the text.  Where a token of one and a token of
the other end at the same byte, the text is cut; the tokens between two cuts are
a group, and every pair of its tokens is a link.  The cuts of many texts are
found at once: a state vector holds one pair of pointers per lane, each step
advances the pointer whose token ends first (both at a cut), and finished lanes
are taken out.  A lane is a text, or a run of tokens of a long one, entered at
the byte where the run begins, so that one long text does not hold up the rest.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from billrisk.llm.bpe import PATTERN, byte_symbols
from billrisk.llm.common import written

LANE = 128  # tokens per lane
_CHUNK = 1 << 20  # characters aligned at once
_WIDE = 1 << 14  # pairs of one group that are written out before equal ids are counted instead


@dataclass
class TokenizerFiles:
    """The contents of both vocabulary files, a few MB whatever the corpus; tasks build the tokenizers from them."""

    byte_level: bytes
    pieces: bytes

    @classmethod
    def public(cls, spark: SparkSession, byte_level: str = "byte_bpe_50k.json", pieces: str = "piece_bpe_32k.model") -> TokenizerFiles:
        import public_tokenizers

        def read(name: str) -> bytes:
            with open(public_tokenizers.path(name), "rb") as file:
                return file.read()
        return cls(read(byte_level), read(pieces))

    def sizes(self) -> tuple[int, int]:
        """Numbers above all ids of either side."""
        import sentencepiece

        spec = json.loads(self.byte_level)
        ids = [*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])]
        return max(ids) + 1, sentencepiece.SentencePieceProcessor(model_proto=self.pieces).get_piece_size()


class TokenPairs:
    """Both tokenizers, with the bytes of every token."""

    def __init__(self, byte_level: bytes, pieces: bytes):
        import sentencepiece
        import tiktoken

        spec, byte_of = json.loads(byte_level), byte_symbols()
        special = {t["content"] for t in spec["added_tokens"]}
        ranks = {bytes(byte_of[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        self.first = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.second = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        size = self.second.get_piece_size()
        self.second_bytes = [
            bytes([int(p[3:5], 16)]) if self.second.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(map(self.second.id_to_piece, range(size)))]
        self.second_length = np.array([len(b) for b in self.second_bytes], np.int64)
        self.first_length = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, i in ranks.items():
            self.first_length[i] = len(token)
        # the text of a token inside a group, and of the last one of its side
        self.shown = [f"{i}{end}" for n, ends in ((len(self.first_length), ",|"), (size, ",;")) for i in range(n) for end in ends]

    def encode(self, text: str | None) -> tuple[list[int], list[int]]:
        """Ids of both sides; none if the tokens of either do not spell out a space and the text."""
        if not text:
            return [], []
        raw = b" " + text.encode()
        first, second = self.first.encode_ordinary(" " + text), self.second.encode(text)
        if b"".join(map(self.second_bytes.__getitem__, second)) != raw or self.first.decode_bytes(first) != raw:
            return [], []
        return first, second


def lockstep(end_a: np.ndarray, end_b: np.ndarray, starts: np.ndarray, lane: int = LANE) -> tuple[np.ndarray, ...]:
    """(tokens of A and of B that end at the same byte, tokens of A and of B that overlap), as places in the arrays.

    ``end_a`` and ``end_b`` are rising byte offsets over all texts one after
    another, ``starts`` the places in ``end_a`` where texts begin.
    """
    total = len(end_a)
    if not total:
        return (np.zeros(0, np.int64),) * 4
    sizes = np.diff(starts, append=total)
    runs = -(-sizes // lane)
    first = np.repeat(starts, runs) + lane * (np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs))
    stop = np.minimum(first + lane, np.repeat(starts + sizes, runs))
    a = first
    b = np.searchsorted(end_b, np.where(a > 0, end_a[a - 1], 0), "right")
    cuts_a, cuts_b, links_a, links_b = [], [], [], []
    while len(a):
        links_a.append(a)
        links_b.append(b)
        here, there = end_a[a], end_b[b]
        cut = here == there
        cuts_a.append(a[cut])
        cuts_b.append(b[cut])
        a, b = a + (here <= there), b + (there <= here)
        open_ = a < stop
        a, b, stop = a[open_], b[open_], stop[open_]
    cut_a, cut_b = np.concatenate(cuts_a), np.concatenate(cuts_b)
    return np.sort(cut_a), np.sort(cut_b), np.concatenate(links_a), np.concatenate(links_b)


def _wide_links(ids_a: np.ndarray, ids_b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray, x: np.ndarray, y: np.ndarray,
                group: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(group, id of A, id of B, times) of groups with several tokens on both sides, where not all pairs overlap."""
    pairs = x * y
    many = pairs > _WIDE
    small = np.flatnonzero(~many)
    for block in np.array_split(small, max(1, int(pairs[small].sum() >> 21))):
        n = pairs[block]
        k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        width = np.repeat(y[block], n)
        yield (np.repeat(group[block], n), ids_a[np.repeat(at_a[block], n) + k // width],
               ids_b[np.repeat(at_b[block], n) + k % width], np.ones(len(k), np.int64))
    for i in np.flatnonzero(many):
        a, na = np.unique(ids_a[at_a[i]:at_a[i] + x[i]], return_counts=True)
        b, nb = np.unique(ids_b[at_b[i]:at_b[i] + y[i]], return_counts=True)
        for j in range(0, len(a), max(1, (1 << 21) // len(b))):
            part = slice(j, j + max(1, (1 << 21) // len(b)))
            size = len(a[part]) * len(b)
            yield (np.full(size, group[i]), np.repeat(a[part], len(b)), np.tile(b, len(a[part])), np.outer(na[part], nb).ravel())


def _counted(both: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Different values in rising order, with how often each stands there, or its ``times`` added up."""
    if times is None:
        both = np.sort(both)
    else:
        order = np.argsort(both, kind="stable")
        both, times = both[order], times[order]
    first = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]])) if len(both) else np.zeros(0, np.int64)
    if times is None:
        return both[first], np.diff(first, append=len(both))
    return both[first], np.add.reduceat(times, first) if len(first) else times[:0]


def align_texts(texts: list[str | None], tokens: TokenPairs) -> dict[str, pa.Array]:
    """Columns n_a, n_b, n_groups, n_links, groups, pairs, times for some texts."""
    coded = [tokens.encode(t) for t in texts]
    n_a, n_b = (np.array([len(c[side]) for c in coded], np.int64) for side in (0, 1))
    ids_a, ids_b = (np.fromiter(chain.from_iterable(c[side] for c in coded), np.int64, n.sum()) for side, n in ((0, n_a), (1, n_b)))
    end_a, end_b = np.cumsum(tokens.first_length[ids_a]), np.cumsum(tokens.second_length[ids_b])
    upto_a, upto_b = np.cumsum(n_a), np.cumsum(n_b)
    full = n_a > 0
    cut_a, cut_b, link_a, link_b = lockstep(end_a, end_b, (upto_a - n_a)[full])

    x, y = np.diff(cut_a, prepend=-1), np.diff(cut_b, prepend=-1)
    at_a, at_b = cut_a + 1 - x, cut_b + 1 - y
    text_of = np.searchsorted(upto_a, cut_a, "right")  # the text of each group
    n_groups = np.bincount(text_of, minlength=len(texts))
    n_links = np.bincount(text_of, x * y, len(texts)).astype(np.int64)

    group_a = np.repeat(np.arange(len(x)), x)
    wide = (x > 1) & (y > 1)
    span_b = len(tokens.second_length)
    span = len(tokens.first_length) * span_b
    group = group_a[link_a]
    plain = ~wide[group]
    both, times = _counted(text_of[group[plain]] * span + ids_a[link_a[plain]] * span_b + ids_b[link_b[plain]])
    w = np.flatnonzero(wide)
    for group, a, b, n in _wide_links(ids_a, ids_b, at_a[w], at_b[w], x[w], y[w], w):
        more = _counted(text_of[group] * span + a * span_b + b, n)
        both, times = _counted(*(np.concatenate(c) for c in zip((both, times), more)))
    owner, key = both // span, both % span
    bounds = pa.array(np.searchsorted(owner, np.arange(len(texts) + 1)), pa.int32())

    # groups as text: the tokens of A, then those of B, group after group
    shown = np.empty(len(ids_a) + len(ids_b), np.int64)
    group_b = np.repeat(np.arange(len(y)), y)
    last_a, last_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
    last_a[cut_a], last_b[cut_b] = 1, 1
    shown[np.arange(len(ids_a)) + at_b[group_a]] = 2 * ids_a + last_a
    shown[np.arange(len(ids_b)) + cut_a[group_b] + 1] = 2 * (len(tokens.first_length) + ids_b) + last_b
    name, groups, at = tokens.shown.__getitem__, [], 0
    for n in (n_a + n_b).tolist():
        groups.append("".join(map(name, shown[at:at + n].tolist()))[:-1])
        at += n
    return {
        "n_a": pa.array(n_a), "n_b": pa.array(n_b), "n_groups": pa.array(n_groups.astype(np.int64)), "n_links": pa.array(n_links),
        "groups": pa.array(groups, pa.large_string()).cast(pa.string()),
        "pairs": pa.ListArray.from_arrays(bounds, pa.array(key, pa.int64())),
        "times": pa.ListArray.from_arrays(bounds, pa.array(times, pa.int64())),
    }


def align_tokenizers(docs: DataFrame, files: TokenizerFiles, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, doc_id, n_a, n_b, n_groups, n_links, groups, pairs, times) of every whole text.

    ``groups`` reads ``a1,a2|b1;a3|b2,b3`` with decimal ids.  ``pairs`` holds the
    different linked id pairs as id of A * ``files.sizes()[1]`` + id of B, rising,
    ``times`` how many links of the text each stands for.  Strings of special
    tokens are plain text.  Null and empty texts, and those that the tokens of
    one side do not spell out byte by byte, have no tokens: zeros, an empty
    string and empty lists.  ``row`` is a number per input row; repeated and
    null ids keep their rows, extra columns are ignored, an empty table gives an
    empty result.  Long texts are aligned in lanes, whole.
    """
    shared = docs.sparkSession.sparkContext.broadcast((files.byte_level, files.pieces))
    size_a, size_b = files.sizes()
    kind, key = ("int", pa.int32()) if size_a * size_b < 1 << 31 else ("long", pa.int64())
    names = ["n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        tokens = TokenPairs(*shared.value)
        for batch in batches:
            texts = batch.column(2).to_pylist()
            size = np.cumsum([len(t) if t else 0 for t in texts])
            edges = np.flatnonzero(np.diff(size // _CHUNK, prepend=0)) if len(texts) else []
            for a, b in zip([0, *edges], [*edges, len(texts)]):
                if a < b:
                    columns = align_texts(texts[a:b], tokens)
                    columns["pairs"] = columns["pairs"].cast(pa.list_(key))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0)[a:b], batch.column(1)[a:b], *(columns[n] for n in names)], ["row", "doc_id", *names])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, "
                                f"pairs array<{kind}>, times array<long>")


def pair_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """(pair, n, best): in how many texts a pair is linked, and whether no pair of the same A id is in more."""
    pairs = written(aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")), "pairs")
    first = F.expr(f"pair div {size_b}")
    most = pairs.groupBy(first.alias("a")).agg(F.max("n").alias("most"))  # at most one row per id of A
    return pairs.join(F.broadcast(most), first == F.col("a")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def score_links(aligned: DataFrame, pairs: DataFrame, carry: int = 500_000) -> DataFrame:
    """``aligned`` (a written table) without its lists, with n_best and count_sum.

    ``n_best`` counts the links whose pair is ``best``, ``count_sum`` adds up the
    counts of all links.  The pairs in most texts, at most ``carry`` of them and
    16 bytes each, go to the texts as arrays; the rest, none of them frequent,
    meet the texts by a shuffle.
    """
    spark = aligned.sparkSession
    keep = [c for c in aligned.columns if c not in ("pairs", "times")]
    pairs = written(pairs, "counts")
    level = F.floor(F.log2("n")).cast("int")
    sizes = sorted(((r.level, r.m) for r in pairs.groupBy(level.alias("level")).agg(F.count("*").alias("m")).collect()), reverse=True)
    least, held = None, 0
    for at, m in sizes:
        held += m
        if held > carry:
            break
        least = at
    common = pairs.where(level >= least).toPandas().sort_values("pair") if least is not None else None
    table = (common.pair.to_numpy(np.int64), common.n.to_numpy(np.int64), common.best.to_numpy(bool)) if common is not None \
        else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))
    shared = spark.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        known, n, best = shared.value
        for batch in batches:
            size = pa.compute.list_value_length(batch.column("pairs")).to_numpy(zero_copy_only=False).astype(np.int64)
            owner = np.repeat(np.arange(len(batch)), size)
            pair, times = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("pairs", "times"))
            at = np.minimum(np.searchsorted(known, pair), max(0, len(known) - 1))
            hit = known[at] == pair if len(known) else np.zeros(len(pair), bool)
            sums = np.zeros((2, len(batch)), np.int64)
            np.add.at(sums[0], owner[hit], times[hit] * best[at[hit]])
            np.add.at(sums[1], owner[hit], times[hit] * n[at[hit]])
            left = pa.array(np.concatenate([[0], np.cumsum(np.bincount(owner[~hit], minlength=len(batch)))]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(sums[0]), pa.array(sums[1]),
                 pa.ListArray.from_arrays(left, pa.array(pair[~hit])), pa.ListArray.from_arrays(left, pa.array(times[~hit]))],
                [*keep, "n_best", "count_sum", "pairs", "times"])

    kind = aligned.schema["pairs"].dataType.simpleString()
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in aligned.schema.fields if f.name in keep)
    scored = aligned.mapInArrow(run, kept + f", n_best long, count_sum long, pairs {kind}, times array<long>")
    if least is not None and held <= carry:
        return scored.drop("pairs", "times")
    scored = written(scored, "scored")
    rare = pairs if least is None else pairs.where(level < least)
    links = scored.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("l")).select("row", F.col("l.pairs").alias("pair"), "l.times")
    more = links.join(rare, "pair").groupBy(F.col("row").alias("of")).agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum"))

    def plus(name: str, more: str) -> Column:
        return (F.col(name) + F.coalesce(F.col(more), F.lit(0))).cast("long").alias(name)

    return scored.join(more, F.col("row") == F.col("of"), "left").select(*keep, plus("n_best", "more_best"), plus("count_sum", "more_sum"))
