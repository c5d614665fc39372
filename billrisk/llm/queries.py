"""One query per operator over its whole table, with the columns that are compared."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from billrisk.llm import alignment, bpe, decontamination, html_extraction, kneser_ney, language_id, line_dedup, masked_lm, ngram_join, quality_rules, substring_dedup, toxicity, vector_codes
from billrisk.llm.common import read_table, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(fn):
    """Register a query under its function's name; ``sql`` is its DuckDB twin, if SQL can express it."""
    QUERIES[fn.__name__] = fn
    return fn


def _sql(text: str):
    def add(fn):
        SQL[fn.__name__] = text
        return fn
    return add


@_query
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(read_table(spark, sf_dir, "documents"))


@_query
def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_jaccard_join(read_table(spark, sf_dir, "documents"))


# An alignment of a document and an item: the same shift between their places. Its matching places are counted
# in every window of 13 words of the item (of all its words if it has 8 to 12).
DECONTAMINATION_SQL = r"""
WITH doc_words AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p
  FROM (SELECT doc_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents)),
item_words AS (
  SELECT item_id, len(w) AS n, unnest(w) AS word, generate_subscripts(w, 1) AS ip
  FROM (SELECT item_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM benchmark)
  WHERE len(w) >= 8),
same AS (SELECT doc_id, item_id, n, p - ip AS shift, ip FROM doc_words JOIN item_words USING (word)),
likely AS (SELECT doc_id, item_id, shift FROM same GROUP BY ALL HAVING count(*) >= least(any_value(n), 11)),
runs AS (
  SELECT doc_id, item_id, n, count(*) OVER (
      PARTITION BY doc_id, item_id, shift ORDER BY ip RANGE BETWEEN CURRENT ROW AND 12 FOLLOWING) AS matches
  FROM same JOIN likely USING (doc_id, item_id, shift)),
pairs AS (
  SELECT DISTINCT doc_id, item_id FROM runs
  WHERE CASE WHEN n >= 13 THEN matches >= 11 ELSE matches >= n END)
"""


@_query
@_sql(DECONTAMINATION_SQL + "SELECT doc_id, count(*) AS n_items, array_to_string(list_sort(list(item_id)), ',') AS item_ids FROM pairs GROUP BY doc_id")
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contaminated_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.withColumn("item_ids", F.array_join(F.transform("item_ids", lambda i: i.cast("string")), ","))


@_query
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(read_table(spark, sf_dir, "documents"))


QUALITY_RULES_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM t),
windows AS (SELECT doc_id, unnest(list_transform(range(1, greatest(len(w) - 3, 1)), lambda i: array_to_string(w[i:i+4], ' '))) AS win,
                   unnest(range(1, greatest(len(w) - 3, 1))) AS i FROM w),
starts AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1),
gaps AS (SELECT doc_id, least(5, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 5)) AS g FROM starts),
repeats AS (SELECT doc_id, sum(g)::BIGINT AS n FROM gaps GROUP BY doc_id),
judged AS (
  SELECT doc_id, w, lines, list_transform(list_transform(lines, lambda x: {'line': x,
      'n': len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')),
      'marks': len(regexp_extract_all(x, '[!?]+|[#*$%&<>]+')), 'bars': len(regexp_extract_all(x, '[|»›•·>]')),
      'upper': len(regexp_extract_all(x, '\p{Lu}{2,}'))}), lambda y: {'line': y.line, 'ok':
        regexp_matches(y.line, '[.!?…。！？:;]["''”’»)\]]*\s*$')
        AND y.marks <= greatest(2.0, y.n * 0.3) AND y.bars <= greatest(1.0, y.n * 0.1)
        AND y.upper <= greatest(2.0, y.n * 0.6)
        AND NOT regexp_matches(y.line, '(?i)\b(cookies?|javascript|lorem ipsum|terms of (use|service)|privacy policy|all rights reserved|copyright|licensed under|subscribe|newsletter|sign (in|up)|log ?in|click here|read more)\b|[{}]')}) AS j,
      text FROM w),
counted AS (
  SELECT doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(list_sum(list_transform(lines, lambda x: length(x))), 0)::BIGINT AS total,
    coalesce(list_sum(list_transform(list_filter(j, lambda y: y.ok), lambda y: length(y.line))), 0)::BIGINT AS left_chars,
    array_to_string(list_transform(list_filter(j, lambda y: y.ok), lambda y: y.line), chr(10)) AS clean_text
  FROM judged)
SELECT c.doc_id, n_words, word_chars, n_symbols, n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
  n_words < 10 OR 100 * coalesce(r.n, 0) > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * coalesce(r.n, 0) > 20 * n_words) AND 100 * (total - left_chars) <= 50 * total AS kept,
  length(clean_text)::BIGINT AS n_chars_clean
FROM counted c LEFT JOIN repeats r USING (doc_id)
"""


@_query
@_sql(QUALITY_RULES_SQL)
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.clean_lines(read_table(spark, sf_dir, "documents")).drop("clean_text")


@_query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.fit_language_model(docs.where(~language_id.held_out()), language_id.public_pieces())
    return language_id.predict_language(docs, model).select(
        "doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score")


@_query
def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = bpe.public_vocabulary(spark)
    tokens = bpe.bpe_decode(bpe.bpe_encode(read_table(spark, sf_dir, "documents"), vocabulary), vocabulary)
    return tokens.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                         F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@_query
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.classify_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@_query
def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html_extraction.extract_main_text(read_table(spark, sf_dir, "pages"))
    return pages.withColumn("n_chars", F.length("text").cast("long"))


@_query
def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    scores = masked_lm.score_documents(docs, masked_lm.fit_masked_model(docs))
    mean = F.try_divide("log_likelihood", "n_tokens")  # null for a text without tokens
    return scores.withColumn("mean_log_probability", F.round(mean, 3)).withColumn("log_likelihood", F.round("log_likelihood", 1))


def _vector_codes_sql(rounds: int = 2) -> str:
    """Every distance is measured; a sum of squares and an index share one number, so that the least is the first of the nearest."""
    steps = ["""
WITH kept AS (
  SELECT vec_id, label, embedding, len(embedding) // 16 AS k, row_number() OVER (ORDER BY vec_id, embedding) AS r FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (SELECT r, p, list_transform(embedding[p * k + 1:(p + 1) * k], lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
          FROM kept, range(16) t(p)),
books0 AS (SELECT p, r - 1 AS e, v FROM parts WHERE r <= 64)"""]
    for turn in range(rounds + 1):
        steps.append(f"""
near{turn} AS (
  SELECT r, p, any_value(parts.v) AS v,
         min(list_sum(list_transform(list_zip(parts.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT * 64 + e) AS best
  FROM parts JOIN books{turn} b USING (p) GROUP BY r, p)""")
        if turn < rounds:
            steps.append(f"""
sums{turn} AS (SELECT p, best % 64 AS e, i, sum(x) AS s, count(*) AS n
               FROM (SELECT p, best, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM near{turn}) GROUP BY ALL),
means{turn} AS (SELECT p, e, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS v FROM sums{turn} GROUP BY p, e),
books{turn + 1} AS (SELECT p, e, coalesce(m.v, b.v) AS v FROM books{turn} b LEFT JOIN means{turn} m USING (p, e))""")
    return ",".join(steps) + f""",
coded AS (SELECT r, string_agg(printf('%02x', best % 64), '' ORDER BY p) AS code, sum(best // 64)::BIGINT AS error FROM near{rounds} GROUP BY r)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) FROM books{rounds}) AS codebooks_sha256
FROM coded JOIN kept USING (r)"""


@_query
@_sql(_vector_codes_sql())
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = vector_codes.encode_vectors(read_table(spark, sf_dir, "embeddings"))
    return vector_codes.with_label_error(codes.rows).select(
        F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(codes.digest()).alias("codebooks_sha256"))


@_query
def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = alignment.TokenizerFiles.public(spark)
    aligned = alignment.align_tokenizers(read_table(spark, sf_dir, "documents"), files).withColumn(
        "groups_sha256", F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("")).drop("groups")
    aligned = written(aligned, "aligned", compression="zstd")
    return alignment.score_links(aligned, alignment.pair_counts(aligned, files.sizes()[1])).drop("row")


@_query
def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    learn = ~toxicity.held_out()
    model = toxicity.fit_toxicity(docs.where(learn), read_table(spark, sf_dir, "labels").where(learn))
    return toxicity.tag_toxicity(docs, model).select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")
