"""Line-first cleaning with whole-text rules, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from billrisk.llm.common import bind

SPACE = r"[\x20\x09-\x0D]+"
_BLANKS = " \t\n\x0b\x0c\r"
# Marks that close a sentence, and phrases of notices and licences.
_CLOSING = r"""[.!?…。！？:;]["'”’»)\]]*\s*$"""
_NOTICE = (r"(?i)\b(cookies?|javascript|lorem ipsum|terms of (use|service)|privacy policy|all rights reserved|copyright"
           r"|licensed under|subscribe|newsletter|sign (in|up)|log ?in|click here|read more)\b|[{}]")


def words_of(text: Column) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+``; empty for null."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(_BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))


def repeated_words(words: Column, window: int = 5) -> Column:
    """Number of words inside windows that stand twice or more in the text, first ones included.

    Window hashes are compared in sorted order, so the work is n log n for any
    length; a text without a repeat, the usual case, needs one hash set only.
    """
    n = F.size(words)

    def hashes(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), n - window + 1), lambda i: F.xxhash64(F.slice(w, i, window)))

    def covered(starts: Column) -> Column:
        gaps = F.transform(starts, lambda p, k: F.least(
            F.lit(window), F.coalesce(F.get(starts, k + 1) - p, F.lit(window))))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, g: a + g)

    def count(h: Column) -> Column:
        placed = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        starts = bind(placed, lambda s: F.array_sort(F.transform(
            F.filter(s, lambda x, k: (F.when(k > 0, F.get(s, k - 1)["h"]) == x["h"]).eqNullSafe(True)
                     | (F.get(s, k + 1)["h"] == x["h"]).eqNullSafe(True)),
            lambda x: x["i"])))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(bind(starts, covered))

    return F.when(n <= window, F.lit(0).cast("long")).otherwise(bind(hashes(words), count))


def base_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    # regexp_count keeps a regex scan in place of a character-by-character translation
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("_w", words_of(F.col("text")))
    lines = F.filter(F.split(F.coalesce(F.col("text"), F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return rows.select(
        "doc_id", "text", F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.coalesce(F.regexp_count("text", F.lit(r"[#*$%&|<>]")), F.lit(0)).cast("long").alias("n_symbols"),
        bind(lines, lambda a: F.size(a) - F.size(F.array_distinct(a))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("_w")).alias("n_repeat_words"))


def line_passes(line: Column, words: Column, max_punctuation: float = 0.3, max_upper: float = 0.6,
                max_symbols: float = 0.1) -> Column:
    """Whether a line looks like prose: closed by punctuation, and neither navigation nor boilerplate.

    ``words`` is its number of words.  Navigation: separators between entries.
    Punctuation: not one mark of exclamation or symbol for every third word.
    """
    marks = F.regexp_count(line, F.lit(r"[!?]+|[#*$%&<>]+"))
    bars = F.regexp_count(line, F.lit(r"[|»›•·>]"))
    upper = F.regexp_count(line, F.lit(r"\p{Lu}{2,}"))
    return (line.rlike(_CLOSING)
            & (marks <= F.greatest(F.lit(2.0), words * max_punctuation))
            & (bars <= F.greatest(F.lit(1.0), words * max_symbols))
            & (upper <= F.greatest(F.lit(2.0), words * max_upper))
            & ~line.rlike(_NOTICE))


def clean_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 10,
                max_repeat_percent: int = 20, max_lost_percent: int = 50) -> DataFrame:
    """(doc_id, base columns, base_failed, kept, clean_text, n_chars_clean): one row per row.

    Each \\n-line is judged by itself and failing lines are removed; a document
    whose removed lines hold more than ``max_lost_percent`` of its characters in
    lines with a word is rejected, as is one that fails the base rule
    (fewer than ``min_words`` words, or more than ``max_repeat_percent`` of
    them in repeated five-word windows).  ``clean_text`` keeps the passing
    lines whether or not the document is kept.

    Null or empty text: no word, so the base rule fails.  Repeated rows are
    judged alike; an empty table gives an empty result; extra columns are ignored.
    """
    rows = base_counts(docs, id_col, text_col)
    lines = F.transform(
        F.filter(F.split(F.coalesce(F.col("text"), F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
        lambda x: bind(F.regexp_count(x, F.lit(r"[^\x20\x09-\x0D]+")), lambda n: F.struct(x.alias("line"), line_passes(x, n).alias("ok"))))
    rows = rows.withColumn("_lines", lines)
    kept_lines = F.transform(F.filter("_lines", lambda x: x["ok"]), lambda x: x["line"])
    total = F.aggregate("_lines", F.lit(0).cast("long"), lambda a, x: a + F.length(x["line"]))
    rows = rows.withColumn("clean_text", F.array_join(kept_lines, "\n")).withColumn("_total", total)
    kept_chars = F.length(F.replace("clean_text", F.lit("\n"), F.lit("")))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & (100 * (F.col("_total") - kept_chars) <= max_lost_percent * F.col("_total"))).alias("kept"),
        F.length("clean_text").cast("long").alias("n_chars_clean"), "clean_text")
