"""Benchmark decontamination by spaced seeds, in DataFrame functions only."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from billrisk.llm.common import bind, materialize, without

WINDOW, MATCHES = 13, 11
# Offsets a mask looks at; the other places of its span may differ.  Every window of 13 words with at most two
# substitutions holds one of the masks at some place (see ``lossless``).
MASKS = ((0, 1, 2, 4, 7), (0, 1, 3, 4, 5), (0, 2, 3, 6, 7))
SPAN = 8


def lossless(masks=MASKS, window: int = WINDOW, errors: int = WINDOW - MATCHES) -> bool:
    """Whether any ``errors`` substitutions in a window leave some mask untouched."""
    return all(
        any(not bad & {start + o for o in mask} for mask in masks for start in range(window - mask[-1]))
        for bad in map(set, combinations(range(window), errors)))


def word_hashes(text: Column) -> Column:
    """Hashes of the text's words: runs of letters and digits in lower case."""
    plain = F.btrim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    return F.when(plain == "", F.array().cast("array<bigint>")).otherwise(
        F.transform(F.split(plain, " "), lambda w: F.xxhash64(w)))


def _seeds(words: Column, at: Column) -> Column:
    """One hash per mask for the words from ``at`` (0-based) on."""
    return F.array(*[
        F.xxhash64(F.lit(m), *[F.get(words, at + o) for o in mask]) for m, mask in enumerate(MASKS)])


def find_overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", broadcast_rows: int = 1_000_000) -> DataFrame:
    """(doc_id, item_id) of documents that hold a passage of a benchmark item.

    A passage is 13 consecutive words of an item of which at least 11 stand at
    the same places in the document.  Spaced seeds of both sides are joined on
    their hash; each hit names an alignment of document and item, and the words
    of an alignment are compared place by place.  The masks together miss no
    such passage.  Seeds of the benchmark are broadcast if there are at most
    ``broadcast_rows`` of them (24 bytes each), else joined by shuffle; only
    seeds, not words, go through that join.

    Items of 8 to 12 words match if all their words stand in the document;
    shorter items are no evidence and match nothing, nor do null texts.
    """
    items = benchmark.select(F.col(item_col).alias("item_id"), word_hashes(F.col(item_text_col)).alias("_iw"))
    items = materialize(items.where((F.size("_iw") >= SPAN) & F.col("item_id").isNotNull()))
    seeds = materialize(_seed_rows(items, "item_id", "_iw", "_ip"))
    small = seeds.count() <= broadcast_rows
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    words = rows.select("doc_id", word_hashes(F.col("_text")).alias("_w")).where(F.size("_w") >= SPAN)
    hits = _seed_rows(words, "doc_id", "_w", "_p").join(F.broadcast(seeds) if small else seeds, "_seed")
    hits = materialize(hits.select("doc_id", "item_id", (F.col("_p") - F.col("_ip")).alias("_shift")).distinct())

    # the places that document and item share under the alignment, and how many of them agree in each window
    texts = rows.withColumnRenamed("doc_id", "_id")
    aligned = hits.join(texts, F.col("doc_id").eqNullSafe(F.col("_id"))).join(F.broadcast(items) if small else items, "item_id")
    aligned = aligned.select("doc_id", "item_id", bind(
        word_hashes(F.col("_text")), lambda w: _holds_passage(w, F.col("_iw"), F.col("_shift"))).alias("_found"))
    found = aligned.where("_found")
    return found.select("doc_id", "item_id").distinct()


def _holds_passage(words: Column, item: Column, shift: Column) -> Column:
    """Whether enough words of some window of the item stand at the places that ``shift`` gives them."""
    first = F.greatest(F.lit(0), -shift)
    shared = F.greatest(F.lit(0), F.least(F.size(item), F.size(words) - shift) - first)
    agree = F.zip_with(F.slice(item, first + 1, shared), F.slice(words, first + shift + 1, shared),
                       lambda x, y: F.when(x == y, 1).otherwise(0))
    width = F.least(F.size(item), F.lit(WINDOW))
    needed = F.when(width < WINDOW, width).otherwise(F.lit(MATCHES))
    best = bind(agree, lambda a: F.array_max(F.transform(
        F.sequence(F.lit(1), F.size(a) - width + 1), lambda i: F.aggregate(F.slice(a, i, width), F.lit(0), lambda n, x: n + x))))
    return F.when(shared >= width, best >= needed).otherwise(F.lit(False))


def _seed_rows(rows: DataFrame, key: str, words: str, place: str) -> DataFrame:
    """(key, place, _seed): the seeds of every mask at every place where a whole span fits."""
    spans = rows.select(key, words, F.explode(F.sequence(F.lit(0), F.size(words) - SPAN)).alias(place))
    return spans.select(key, place, F.explode(_seeds(F.col(words), F.col(place))).alias("_seed"))


def contaminated_documents(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, n_items, item_ids): one row per id with a verified overlap, items in ascending order.

    Rows that repeat an id count as one document; null ids are reported under
    null.  Empty tables give an empty result; extra columns are ignored.
    """
    pairs = find_overlaps(docs, benchmark, id_col, text_col, item_col, item_text_col)
    return pairs.groupBy("doc_id").agg(
        F.count("*").alias("n_items"), F.array_sort(F.collect_list("item_id")).alias("item_ids"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without those that overlap a benchmark item; rows with a null id are judged together."""
    return without(docs, find_overlaps(docs, benchmark, id_col, text_col).select("doc_id"), id_col)
