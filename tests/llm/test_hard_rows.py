"""Every operator on nulls, empty and very long texts, repeated rows, an empty table and columns with clashing names."""

import random

import pytest
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402
from billrisk.llm import (  # noqa: E402
    bpe, decontamination, html_extraction, kneser_ney, language_id, line_dedup, masked_lm, ngram_join, quality_rules, substring_dedup,
)

RNG = random.Random(12)
WORDS = [f"{a}{b}{c}" for a in "bdfgklmnprst" for b in "aeiou" for c in ("n", "r", "st", "")]
CLASH = ["_gone", "_of", "_left", "_wanted", "cid", "key", "h", "id", "n", "t", "comp", "row", "gone", "line", "m", "place"]


def words(n):
    return " ".join(RNG.choice(WORDS) for _ in range(n))


LONG = words(20_000)
NEAR = LONG.split()
NEAR[777] = "changed"
TEXTS = [
    (1, words(60) + ".\nshort line\n" + words(30) + "."), (2, None), (3, ""), (4, " \n\t "), (5, LONG), (6, " ".join(NEAR)),
    (7, "one"), (7, "one"), (None, words(50)), (None, None), (8, "²³ 12 !?"), (9, "a" * 50_000), (10, "x\n" * 3000), (11, words(40)),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i != 11 else None, "s", None if t is None else len(t)) for i, t in TEXTS]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return frame.select("*", *[F.lit(7).alias(c) for c in CLASH])


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, 0, 1) for i in range(12)] + [(None, 1, None, 1), (1, None, 1, 1)],
                                 "doc_id long, quality int, toxic int, _of int")


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, words(20), 1), (2, None, 1), (None, words(15), 1), (3, "", 1)], "item_id long, text string, _gone int")


def test_substring_dedup(docs):
    got = {r.doc_id: r for r in substring_dedup.repeated_passages(docs).collect()}
    assert set(got) == {5, 6} and all(r.first_doc_id == 5 and r.n_repeated_words > 19_000 for r in got.values())
    assert substring_dedup.repeated_passages(docs.where("false")).collect() == []


def test_ngram_join(docs):
    got = ngram_join.ngram_jaccard_join(docs).collect()
    assert len(got) == len(TEXTS)
    links = {(r.doc_id, r.component_id, r.n_links) for r in got if r.n_links}
    assert links == {(5, 5, 1), (6, 5, 1), (7, 7, 1)}


def test_decontamination(docs, bench):
    assert decontamination.contaminated_documents(docs, bench).collect() == []
    left = decontamination.decontaminate(docs, bench)
    assert left.columns == docs.columns and left.count() == len(TEXTS)
    assert decontamination.decontaminate(docs.where("false"), bench).collect() == []


def test_lines(docs):
    got = {r.doc_id: r for r in line_dedup.line_report(docs).collect()}
    assert got[10].n_lines == 3000 and got[10].n_removed == 2999 and got[7].n_lines == 2 and got[7].n_removed == 0
    assert got[None].n_removed == 0 and got[2].n_lines == 0 and got[6].n_removed == 1
    left = line_dedup.drop_repeated_lines(docs)
    assert left.columns == docs.columns and left.count() == len(TEXTS) - 1
    assert line_dedup.drop_repeated_lines(docs.where("false")).collect() == []


def test_quality_rules(docs):
    got = quality_rules.clean_lines(docs).collect()
    assert len(got) == len(TEXTS) and {r.doc_id: r.n_words for r in got}[5] == 20_000
    assert quality_rules.clean_lines(docs.where("false")).collect() == []


def test_language(docs):
    model = language_id.fit_language_model(docs, language_id.public_pieces())
    got = {r.doc_id: r for r in language_id.predict_language(docs, model).collect()}
    assert got[8].lang_pred == got[2].lang_pred == got[4].lang_pred == "und" and got[5].lang_pred == "en"
    assert language_id.predict_language(docs, model).count() == len(TEXTS)
    assert language_id.predict_language(docs.where("false"), model).collect() == []
    nothing = language_id.fit_language_model(docs.where("false"), language_id.public_pieces())
    assert {r.lang_pred for r in language_id.predict_language(docs, nothing).collect()} == {"und"}


def test_marks_belong_to_their_letters():
    assert language_id._LETTERS.findall("हिन्दी ²³x1 naïve") == ["हिन्दी", "x", "naïve"]


def test_pages(spark):
    page = "<article><h1>T</h1><p>a</p><article class='comment'><p>c</p></article><div class='promotion-history'>b</div>" \
           "<div class='related-work'>d</div><p class='share-price'>e</p><div class='share-buttons'>x</div><div id='relatedPosts'>y</div>" \
           "<header><div><h2>z</h2></div></header><aside>s</aside></article>"
    deep = "<div>" * 20_000 + "deep" + "</div>" * 20_000
    rows = [(1, "http://a.b/1", page), (1, "http://a.b/1", page), (None, None, "<p>p &amp;  q</p>"), (2, "http://a.b/2", None),
            (3, "not a url", ""), (4, "http://a.b/3", deep), (5, "http://a.b/4", "<p>" + LONG + "</p>")]
    pages = spark.createDataFrame([(*r, 1, 1, 1) for r in rows], "page_id long, url string, html string, host int, page_key int, removed int")
    got = {r.page_id: r.text for r in html_extraction.extract_main_text(pages).collect()}
    assert got == {1: "T\n\na\n\nb\n\nd\n\ne\n\nz", None: "p & q", 2: "", 3: "", 4: "deep", 5: LONG}
    assert html_extraction.extract_main_text(pages).count() == len(rows)
    assert html_extraction.extract_main_text(pages.where("false")).collect() == []


def test_bpe(spark, docs):
    vocabulary = bpe.public_vocabulary(spark)
    got = bpe.bpe_decode(bpe.bpe_encode(docs, vocabulary), vocabulary).collect()
    assert sorted((r.doc_id or 0, r.decoded) for r in got) == sorted((i or 0, t or "") for i, t in TEXTS)
    assert bpe.bpe_encode(docs.where("false"), vocabulary).collect() == []


def test_quality_classifier(docs, labels):
    got = kneser_ney.classify_quality(docs, labels).collect()
    assert len(got) == len({(i, i != 11) for i, _ in TEXTS}) and all(r.kept for r in got if r.doc_id in (2, 3, 4))
    assert kneser_ney.classify_quality(docs.where("false"), labels).collect() == []
    assert all(r.kept for r in kneser_ney.classify_quality(docs, labels.where("false")).collect())


def test_language_model(docs):
    model = masked_lm.fit_masked_model(docs)
    got = masked_lm.score_documents(docs, model).collect()
    assert len(got) == len(TEXTS) and {r.doc_id: r.n_tokens for r in got}[5] == 20_000
    assert masked_lm.score_documents(docs.where("false"), masked_lm.fit_masked_model(docs.where("false"))).collect() == []


def test_pipeline_stages(spark, docs, labels, bench, tmp_path):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    plain = docs.drop(*CLASH)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, plain, str(tmp_path))
        none = stage(spark, plain.where("false"), str(tmp_path))
        assert none.collect() == [] and out.count() <= len(TEXTS)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == plain.columns == none.columns and out.schema == plain.schema
