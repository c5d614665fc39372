"""Similarity self-join of documents on word n-grams by T-occurrence search (DivideSkip)."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from billrisk.llm.common import (
    FrequencyClasses, free, frequency_classes, hash_runs, hash_words, materialize, mix, packed, scratch, slices, tidy, unpacked, written,
)
from billrisk.llm.components import components, link_lists


def _all_grams(texts: list[str | None], k: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every run of k words of a block of texts; a shorter text is one run."""
    raw = [text.encode("utf-8", "surrogatepass").lower() if text else b"" for text in texts]
    words, starts = hash_words(np.frombuffer(b"\n".join(raw) + b"\n", np.uint8))
    ends = np.cumsum([len(r) + 1 for r in raw])
    owner = np.searchsorted(ends, starts, "right")
    n = np.bincount(owner, minlength=len(texts))
    last = np.cumsum(n)
    begin = np.arange(len(words))
    whole = begin + k <= last[owner]
    tiny = np.flatnonzero((n > 0) & (n < k))
    begin = np.concatenate([begin[whole], (last - n)[tiny]])
    upto = np.concatenate([begin[:len(begin) - len(tiny)] + k, last[tiny]])
    return (owner[begin], hash_runs(words, begin, upto)) if len(begin) else (np.zeros(0, np.int64), np.zeros(0, np.uint64))


def _grams_of(k: int):
    def make():
        return lambda text: np.unique(_all_grams([text], k)[1])
    return make


def _class_id(grams: np.ndarray) -> int:
    """Identity of a set of n-grams: 64 bits of its members in any order."""
    return int(_class_ids(grams, np.zeros(1, np.int64))[0])


def _class_ids(grams: np.ndarray, first: np.ndarray) -> np.ndarray:
    """``_class_id`` of sets that stand one after another and begin at ``first``."""
    n = np.diff(first, append=len(grams)).astype(np.uint64)
    return mix(np.add.reduceat(mix(grams), first) + n).view(np.int64)


def _needed(n: int | np.ndarray, percent: int):
    """Least overlap of a set of n members with any set as similar as asked: ceil(n * percent / 100)."""
    return -(-n * percent // 100)


EXTRA = 2  # short lists beyond the least number; so many more occurrences are asked for
_BLOCK = 128  # members of a component that are counted against each other at once
_MEET = 256  # members of a list of whom sketches are held against each other at once
_SKETCH = 8  # 64-bit words of parity bits of a small set


def _parity(grams: np.ndarray) -> np.ndarray:
    """Bits that each member flips: two sets differ in at least as many members as their sketches differ in bits.

    A sketch has a bit for two members or more, in a length that doubles, so
    that sets of any size tell apart; the longer of two is folded to the other.
    """
    words = _SKETCH
    while 128 * words < len(grams):
        words *= 2
    bits = np.bincount((grams >> np.uint64(20)).astype(np.int64) % (64 * words), minlength=64 * words) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def _flips(a: Column, b: Column) -> Column:
    """Bits in which two sketches differ, of which one may be twice as long."""
    def folded(s: Column, other: Column) -> Column:
        half = F.size(other)
        return F.when(F.size(s) > half, F.zip_with(
            F.slice(s, F.lit(1), half), F.slice(s, half + 1, half), lambda x, y: x.bitwiseXOR(y))).otherwise(s)

    each = F.zip_with(folded(a, b), folded(b, a), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(each, F.lit(0), lambda n, x: n + x)


def _alike(n: np.ndarray, comp: np.ndarray, mine: np.ndarray, aside: np.ndarray, sketches: list[np.ndarray],
           percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """(place of a member aside, places of those it may link with) that sizes, components and sketches do not rule out.

    ``mine`` tells the two blocks of a task apart; members of one block meet only if there is no other.
    """
    size = np.array([len(s) for s in sketches])
    at, across, rows = np.arange(len(n)), mine.min() != mine.max(), {}
    for length in np.unique(size):
        own = np.flatnonzero(size == length)
        rows[length] = own, np.stack([sketches[i] for i in own])
    for i in np.flatnonzero(aside):
        open_ = (comp != comp[i]) & (100 * np.minimum(n, n[i]) >= percent * np.maximum(n, n[i])) & (~aside | (at < i))
        if across:
            open_ &= mine != mine[i]
        for length in (size[i] // 2, size[i], 2 * size[i]):  # sizes as near as that have sketches of no other length
            if length not in rows:
                continue
            own, table = rows[length]
            there = np.flatnonzero(open_[own])
            if not len(there):
                continue
            x, y = sketches[i], table[there]
            if length < size[i]:
                x = x[:length] ^ x[length:]
            elif length > size[i]:
                y = y[:, :size[i]] ^ y[:, size[i]:]
            flips = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
            there = own[there[flips * (100 + percent) <= (n[own[there]] + n[i]) * (100 - percent)]]
            if len(there):
                yield i, there


def meet_in_blocks(members: DataFrame, classes: DataFrame, percent: int, block: int = _MEET) -> DataFrame:
    """(a, b), a < b: pairs of members of one list, in different components, that may link by size and sketch.

    ``members`` as ``link_lists`` gives them, ``classes`` (cid, n, sketch).
    Members of a list are dealt into blocks by a hash, and every two blocks of
    which one is aside meet in a task of their own, so that a list of any size
    is spread over tasks, and only pairs that may link become rows.
    """
    aside, others = (F.ceil(x / block).cast("int") for x in (F.col("rest"), F.col("all") - F.col("rest")))
    dealt = members.where(F.col("all") > block).select("key", "id", "comp", "aside", aside.alias("a"), others.alias("t"))
    place = F.when(F.col("aside"), F.pmod(F.xxhash64("id"), F.col("a"))).otherwise(F.col("a") + F.pmod(F.xxhash64("id"), F.col("t")))
    dealt = dealt.withColumn("mine", place.cast("int")).withColumn("other", F.explode(F.sequence(
        F.lit(0), F.when(F.col("aside"), F.col("a") + F.col("t")).otherwise(F.col("a")) - 1)))
    dealt = dealt.select("key", "id", "comp", "aside", "mine", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"))
    zero = F.lit(0)
    whole = members.where(F.col("all") <= block).select(
        "key", "id", "comp", "aside", zero.alias("mine"), zero.alias("low"), zero.alias("high"))
    met = whole.union(dealt).join(classes.select(F.col("cid").alias("id"), "n", "sketch"), "id")
    met = met.select("key", "low", "high", "mine", "id", "comp", "aside", "n", "sketch")
    met = met.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        def finish(rows):
            mine, ids, comp, aside, n = (np.array(c) for c in zip(*(r[3:8] for r in rows)))
            if len(rows) < 2 or not aside.any():
                return
            for i, there in _alike(n, comp, mine, aside, [np.array(r[8], np.int64).view(np.uint64) for r in rows], percent):
                yield np.minimum(ids[i], ids[there]), np.maximum(ids[i], ids[there])

        def packed_pairs(found):
            a, b = zip(*found) if found else ([np.zeros(0, np.int64)],) * 2
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])

        held, at, found, many = [], None, [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[:3] != at and held:
                    for pair in finish(held):
                        found.append(pair)
                        many += len(pair[0])
                        if many > 100_000:
                            yield packed_pairs(found)
                            found, many = [], 0
                    held = []
                at = row[:3]
                held.append(row)
        found.extend(finish(held) if held else ())
        yield packed_pairs(found)

    return met.mapInArrow(run, "a long, b long")


def gram_sets(docs: DataFrame, id_col: str, text_col: str, k: int, percent: int, classes: FrequencyClasses) -> DataFrame:
    """(doc_id, n, cid, short, sketch) per row: size, identity and parity bits of its set, the n-grams of its short lists.

    With T the overlap that any partner must reach, the T - 1 - EXTRA most
    frequent n-grams are the long lists; a partner must occur in 1 + EXTRA of the
    others, the short ones.  "Frequent" is the corpus-wide order of (frequency
    class, hash).
    """
    table = classes.table

    def build(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        known = FrequencyClasses(table)
        for batch in slices(batches, 100):
            owner, grams = _all_grams(batch.column(1).to_pylist(), k)
            often = known.of(grams)
            order = np.lexsort((grams, often, owner))
            owner, grams = owner[order], grams[order]
            fresh = np.ones(len(grams), bool)
            fresh[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
            owner, grams = owner[fresh], grams[fresh]
            n = np.bincount(owner, minlength=batch.num_rows)
            full = np.flatnonzero(n)
            first = (np.cumsum(n) - n)
            cids = np.zeros(batch.num_rows, np.int64)
            if len(full):
                cids[full] = _class_ids(grams, first[full])
            take = np.where(n > 0, n - _needed(n, percent) + 1 + EXTRA, 0)
            short = np.arange(len(grams)) - first[owner] < take[owner]
            bounds = np.concatenate([[0], np.cumsum(np.minimum(take, n))])
            sketch = [_parity(grams[a:a + m]) for a, m in zip(first.tolist(), n.tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n.astype(np.int64)), pa.array(cids, mask=n == 0),
                 pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(grams[short].view(np.int64))),
                 pa.array(sketch, pa.list_(pa.int64()))], ["doc_id", "n", "cid", "short", "sketch"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(build, "doc_id long, n long, cid long, short array<long>, sketch array<long>")


def _texts_of(rows: DataFrame, k: int) -> DataFrame:
    """(cid, text): a compressed text travels in less space than its hashed members."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        grams_of = _grams_of(k)()
        for batch in batches:
            cids = [_class_id(grams_of(text)) for text in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cids, pa.int64()), pa.array([packed(t) for t in batch.column(0).to_pylist()], pa.binary())], ["cid", "text"])

    return rows.select("text").mapInArrow(run, "cid long, text binary")


def _probe(k: int, percent: int, step: int = 128):
    def check(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        """Binary search of the smaller set's members in the larger set, until enough or too few can be shared."""
        plain = _grams_of(k)()
        grams_of = lru_cache(32)(lambda data: plain(unpacked(data)))  # rows of one text come one after another
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                a, b = grams_of(x), grams_of(y)
                if len(a) > len(b):
                    a, b = b, a
                need, shared = -(-percent * (len(a) + len(b)) // (100 + percent)), 0
                for i in range(0, len(a), step):
                    part = a[i:i + step]
                    at = np.searchsorted(b, part)
                    at[at == len(b)] = 0
                    shared += int((b[at] == part).sum())
                    if shared >= need or shared + len(a) - i - len(part) < need:
                        break
                keep.append(shared >= need)
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])

    return check


def _shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, from products of the incidence matrix, a slice of n-grams at a time."""
    grams, place = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    out = np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    edges = np.searchsorted(place, np.arange(0, len(grams) + 4096, 4096))
    for i, (a, b) in enumerate(zip(edges, edges[1:])):
        part = np.zeros((len(sets), 4096), np.float32)
        part[owner[a:b], place[a:b] - 4096 * i] = 1
        out += part @ part.T
    return out


def count_links(members: DataFrame, k: int, percent: int, block: int = _BLOCK) -> DataFrame:
    """(cid, links): how many rows of other classes each class links with, from (cid, comp, m, n, text).

    ``m`` is the number of rows of a class, ``text`` its compressed text.  The
    classes of a component are dealt into blocks by a hash, and every two blocks
    are compared in a task of their own, so a component of any size is spread
    over tasks and no pair becomes a row.
    """
    sizes = members.groupBy("comp").agg(F.count("*").alias("all"))
    blocks = F.ceil(F.col("all") / block).cast("int")
    dealt = members.join(sizes.where("all > 1"), "comp").select(
        "comp", "cid", "m", "text", blocks.alias("blocks"), F.pmod(F.xxhash64("cid"), blocks).cast("int").alias("mine"))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("comp", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"), "mine", "cid", "m", "text")
    met = met.repartition("comp", "low", "high").sortWithinPartitions("comp", "low", "high")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        grams_of = _grams_of(k)()

        def finish(rows):
            cid, m = np.array([r[4] for r in rows], np.int64), np.array([r[5] for r in rows], np.int64)
            mine, same = np.array([r[3] for r in rows]), rows[0][1] == rows[0][2]
            sets = [grams_of(unpacked(r[6])) for r in rows]
            n = np.array([len(s) for s in sets])
            shared = _shared_counts(sets)
            linked = 100 * shared >= percent * (n[:, None] + n[None, :] - shared)
            np.fill_diagonal(linked, False)
            if not same:
                linked &= mine[:, None] != mine[None, :]
            return pa.RecordBatch.from_arrays([pa.array(cid), pa.array(linked @ m)], ["cid", "links"])

        held, at = [], None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[:3] != at and held:
                    yield finish(held)
                    held = []
                at = row[:3]
                held.append(row)
        if held:
            yield finish(held)

    return met.mapInArrow(count, "cid long, links long").groupBy("cid").agg(F.sum("links").alias("links"))


def ngram_jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3,
                       percent: int = 90, broadcast_rows: int = 500_000) -> DataFrame:
    """(doc_id, n_shingles, component_id, class_id, n_links): one row per row of ``docs``.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case; a document's set
    holds its distinct runs of k words, or its whole sequence if it has fewer.
    Two rows link when 100 * |intersection| >= percent * |union|;
    ``component_id`` is the smallest id that links reach, ``n_links`` the number
    of other rows a row links with, ``class_id`` is shared by rows with equal
    sets, which are searched once.  Candidates come from merging the short
    inverted lists and counting occurrences; the long ones are never joined but
    probed by binary search for each candidate that parity bits of the sets do
    not rule out.  Links inside a component are counted block by block.  Hashes
    of 64 bits stand for n-grams.

    Null or wordless text: no shingle, linked with nothing, its own component.
    Null ids: the row is returned with its set size; it may connect others but
    has no id to give, so a component of null ids only has a null id.  Rows that
    repeat an id are returned as often.  Texts of any length are taken whole.
    An empty table gives an empty result.  Extra columns are ignored.
    """
    spark = docs.sparkSession
    with scratch(spark) as scope:
        texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
        counted = frequency_classes(texts, "text", lambda: lambda some: _all_grams(some, k)[1], 100)
        rows = written(gram_sets(texts, "doc_id", "text", k, percent, counted), "gram-sets", compression="zstd")
        classes = rows.where("cid is not null").groupBy("cid").agg(
            F.min("doc_id").alias("rep"), F.max("n").alias("n"), F.count("*").alias("m"), F.min("short").alias("short"),
            F.min("sketch").alias("sketch"), F.min(F.coalesce("doc_id", F.lit(-1))).alias("home"))
        classes = written(classes, "gram-classes", compression="zstd")
        ids = written(rows.select("doc_id", "n", "cid"), "gram-ids")
        free(rows)
        tidy(spark)

        lists = classes.select(F.explode("short").alias("key"), F.col("cid").alias("id"), "n")
        keyed = texts.withColumn("home", F.coalesce("doc_id", F.lit(-1)))

        def near(x, y) -> Column:
            return 100 * F.least(x("n"), y("n")) >= percent * F.greatest(x("n"), y("n"))

        def texts_of(cids: DataFrame) -> DataFrame:
            """(cid, text) of classes, from one row of each."""
            homes = materialize(classes.join(cids, "cid", "left_semi").select("home").distinct())
            side = F.broadcast(homes) if homes.count() <= broadcast_rows else homes
            return written(_texts_of(keyed.join(side, "home", "left_semi"), k).dropDuplicates(["cid"]), "gram-texts")

        def verify(pairs: DataFrame) -> DataFrame:
            # two sets as similar as asked differ in at most (n + m) * (100 - percent) / (100 + percent) members
            p, q = (classes.select(F.col("cid").alias(c), F.col("n").alias("n" + c), F.col("sketch").alias("s" + c)) for c in "ab")
            close = materialize(pairs.join(p, "a").join(q, "b").where(
                _flips(F.col("sa"), F.col("sb")) * (100 + percent) <= (F.col("na") + F.col("nb")) * (100 - percent)).select("a", "b"))
            found = texts_of(close.select(F.col("a").alias("cid")).union(close.select(F.col("b"))).distinct())
            p, q = found.select(F.col("cid").alias("a"), F.col("text").alias("p")), found.select(F.col("cid").alias("b"), F.col("text").alias("q"))
            return close.join(p, "a").join(q, "b").select("a", "b", "p", "q").mapInArrow(_probe(k, percent), "a long, b long")

        links = link_lists(lists, verify, near, short=3, least=lambda n, m: F.least(
            F.lit(1 + EXTRA), F.ceil((n + m) * percent / (100 + percent))), meet=lambda members: meet_in_blocks(members, classes, percent))
        comp = components(links)
        free(links)
        of = comp.withColumnRenamed("id", "cid")
        linked = classes.select("cid", "m").join(of, "cid")
        counts = written(count_links(linked.join(texts_of(of.select("cid")), "cid"), k, percent), "link-counts")
        members = classes.select("cid", "rep", "m").join(of, "cid", "left").select(
            "cid", "rep", "m", F.coalesce("comp", "cid").alias("comp"))
        least = members.groupBy("comp").agg(F.min("rep").alias("least"))
        of_class = written(members.join(least, "comp").join(counts, "cid", "left").select(
            "cid", "least", (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n_links")), "of-class")
        return scope.keep(written(ids.join(of_class, "cid", "left").select(
            "doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"),
            F.col("cid").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links")), "joined"))
