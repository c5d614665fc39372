"""Operators against brute force on small fixtures, with nulls, empty and long texts, ties, repeats and empty tables."""

import hashlib
import os
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

from billrisk.llm import (  # noqa: E402
    bpe, decontamination, html_extraction, kneser_ney, language_id, line_dedup, masked_lm, ngram_join, quality_rules, queries,
    substring_dedup,
)
from billrisk.llm.components import components, link_lists  # noqa: E402
from suite.check import compare, connect  # noqa: E402

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, cid long, key string"
WORDS = [f"w{i}" for i in range(300)]


def text(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(n))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), 7, "x") for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    a, b = text(1, 400), text(2, 90)
    near = a.split()
    near[200] = "changed"
    passage = text(3, 60)
    return frame(spark, [
        (1, a), (2, " ".join(near)), (3, a), (3, a), (4, b), (5, None), (6, ""), (7, "  \n\t"), (8, "one"), (9, "ONE"),
        (10, text(4, 50) + "\n" + passage + ".\n" + text(5, 30)), (11, text(6, 20) + "\n" + passage + "!\n" + text(7, 70)),
        (12, text(8, 6000)), (None, b), (13, "x" * 5000), (14, "Line of five words here.\nLine of five words here!\nend"),
    ])


def test_components_of_chains_and_stars(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(20)] + [(100, i) for i in range(101, 140)], "a long, b long")
    got = dict(components(links).collect())
    assert all(got[i] == 0 for i in range(21)) and all(got[i] == 100 for i in range(100, 140))
    assert components(links.where("false")).count() == 0


def test_link_lists_connect_all_that_any_list_should(spark):
    rng = random.Random(5)
    rows = {(rng.randrange(6), i) for i in range(120) for _ in range(2)}
    lists = spark.createDataFrame([(k, i, i) for k, i in rows], "key int, id long, info long")
    good = lambda x, y: x % 7 == y % 7
    links = link_lists(lists, lambda pairs: pairs.where("a % 7 = b % 7"), star_rounds=3)
    got = dict(components(links).collect())
    links2 = [(a, b) for k, a in rows for m, b in rows if k == m and a < b and good(a, b)]
    want = dict(components(spark.createDataFrame(links2, "a long, b long")).collect())
    assert got == want


def test_ngram_join(spark, docs):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_jaccard_join(docs).collect()}
    assert got[1][1] == got[2][1] == got[3][1] == 1
    assert got[5] == (0, 5) and got[6] == (0, 6) and got[7] == (0, 7)
    assert got[8] == (1, 8) and got[9] == (1, 8)
    assert got[4][1] == 4 and got[None][1] == 4
    assert ngram_join.ngram_jaccard_join(docs).count() == docs.count()
    assert ngram_join.ngram_jaccard_join(docs.where("false")).count() == 0


def brute_links(rows, k=3, percent=90):
    """{id: (size, smallest id reached, links)} from all pairs."""
    sets = {}
    for i, t in rows:
        words = [] if t is None else re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
        sets[i] = {tuple(words[j:j + k]) for j in range(max(1, len(words) - k + 1))} if words else set()
    links = {i: [j for j in sets if j != i and sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])] for i in sets}
    least = {i: i for i in sets}
    for _ in sets:
        least = {i: min([least[i], *(least[j] for j in links[i])]) for i in sets}
    return {i: (len(sets[i]), least[i], len(links[i])) for i in sets}


def test_ngram_join_is_that_of_brute_force(spark):
    rng = random.Random(8)
    rows = []
    for g in range(12):
        base = text(100 + g, rng.choice([2, 3, 4, 12, 40, 200])).split()
        for _ in range(rng.randint(1, 9)):
            words = list(base)
            for _ in range(rng.randint(0, max(1, len(words) // 60))):
                words[rng.randrange(len(words))] = rng.choice(WORDS)
            rows.append((len(rows), " ".join(words).title() if rng.random() < 0.3 else "\n".join(words)))
    got = {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in ngram_join.ngram_jaccard_join(frame(spark, rows)).collect()}
    assert got == brute_links(rows)


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_ngram_query_is_that_of_brute_force(spark):
    got = {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in queries.QUERIES["op2_ngram_jaccard_join"](spark, SF).collect()}
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert got == brute_links(rows)


def test_links_are_counted_across_blocks(spark):
    """A component of several blocks, rows of equal sets counted as often as they are."""
    base = text(70, 200).split()
    rows = []
    for i in range(40):
        words = list(base)
        words[i * 4] = f"own{i // 2}"  # pairs of rows are equal in part
        rows.append((i, " ".join(words)))
    rows += [(100, rows[0][1]), (101, rows[0][1])]
    sets = ngram_join._grams_of(3)()
    made = [(int(ngram_join._class_id(sets(t))), 1, 3 if i == 0 else 1, len(sets(t)), ngram_join.packed(t)) for i, t in rows[:40]]
    members = spark.createDataFrame(made, "cid long, comp long, m long, n long, text binary")
    got = {r.cid: r.links for r in ngram_join.count_links(members, 3, 90, block=7).collect()}
    want = brute_links(rows)
    for i, row in enumerate(made):
        assert got[row[0]] + row[2] - 1 == want[i][2]


def test_ngram_join_of_one_large_group(spark):
    base = text(11, 300).split()
    rows = []
    for i in range(150):
        words = list(base)
        words[i] = f"new{i}"
        rows.append((i, " ".join(words)))
    got = {r.component_id for r in ngram_join.ngram_jaccard_join(frame(spark, rows)).collect()}
    assert got == {0}


def test_substring_dedup(spark, docs):
    got = {r.doc_id: r for r in substring_dedup.repeated_passages(docs).collect()}
    assert {1, 2, 3, 4, 10, 11} <= set(got) and not {5, 6, 7, 8, 9, 12, 13, 14} & set(got)
    start, end = map(int, got[10].passages.split("-"))
    assert start <= 50 + 1 and end >= 50 + 59 and got[10].first_doc_id == 10 and got[11].first_doc_id == 10
    assert substring_dedup.repeated_passages(docs.where("false")).count() == 0


def test_substring_dedup_finds_near_copies_of_a_frequent_passage(spark):
    passage = text(41, 60).split()
    rows = [(i, " ".join(["", text(1000 + i, 100), *passage, text(2000 + i, 100)])) for i in range(150)]
    for i in range(150, 160):  # one changed word, each another one, in other surroundings
        changed = list(passage)
        changed[27 + i % 7] = f"new{i}"
        rows.append((i, " ".join([text(1000 + i, 100), *changed, text(2000 + i, 100)])))
    got = {r.doc_id: r for r in substring_dedup.repeated_passages(frame(spark, rows)).collect()}
    assert set(got) == set(range(160)) and {r.first_doc_id for r in got.values()} == {0}


def test_substring_dedup_finds_changed_passages(spark):
    rng, rows = random.Random(51), []
    for i in range(60):
        passage = text(3000 + i, 60).split()
        other = list(passage)
        if i < 20:  # one word inserted in the middle, so that no diagonal holds 40 equal words of 50
            other.insert(30, "new")
        else:
            for k in rng.sample(range(60), 6 if i < 40 else 11):
                other[k] = f"new{k}"
        rows += [(2 * i, " ".join([text(4000 + i, 150), *passage, text(5000 + i, 150)])),
                 (2 * i + 1, " ".join([text(6000 + i, 150), *other, text(7000 + i, 150)]))]
    got = {r.doc_id: r.passages for r in substring_dedup.repeated_passages(frame(spark, rows)).collect()}
    found = [i for i in range(60) if 2 * i in got and 2 * i + 1 in got]
    assert set(range(40)) <= set(found) and len(found) >= 59
    for i in range(20):
        start, end = map(int, got[2 * i].split("-"))
        assert 138 <= start <= 152 and 208 <= end <= 223  # a fifth of 50 words at either end may differ


def test_substring_dedup_verifies_every_pair(spark):
    common, more = text(61, 60), text(62, 50)
    rows = [(i, " ".join([text(8000 + i, 100), common, more if i in (1, 4) else text(8100 + i, 50), text(8200 + i, 100)])) for i in range(1, 6)]
    got = {r.doc_id: r.n_repeated_words for r in substring_dedup.repeated_passages(frame(spark, rows)).collect()}
    assert got[1] >= 108 and got[4] >= 108 and all(58 <= got[i] <= 75 for i in (2, 3, 5))


def test_compact_windows_cover_each_run_once():
    ranks = np.array(random.Random(3).sample(range(1000), 60), np.uint64)
    windows = substring_dedup.compact_windows(ranks, 10)
    for i in range(60):
        for j in range(i + 10, 61):
            c = i + int(ranks[i:j].argmin())
            assert sum(low <= i and j <= high and m == c for low, m, high in windows) == 1


def test_decontamination_masks_and_substitutions(spark, docs):
    assert decontamination.lossless()
    item = text(21, 40).split()
    hit = item[:5] + ["other"] + item[6:]
    rows = [(1, text(22, 50) + " " + " ".join(hit).upper() + ". " + text(23, 9)), (2, text(24, 200)), (3, " ".join(item[:12])),
            (4, None), (5, ""), (6, " ".join(item[20:33])), (6, " ".join(item[20:33]))]
    bench = spark.createDataFrame([(1, " ".join(item)), (2, None), (3, "too short"), (4, "")], "item_id long, text string")
    data = frame(spark, rows)
    got = {r.doc_id: r.item_ids for r in decontamination.contaminated_documents(data, bench).collect()}
    assert got == {1: [1], 6: [1]}
    assert sorted(r.doc_id for r in decontamination.decontaminate(data, bench).collect()) == [2, 3, 4, 5]
    assert decontamination.contaminated_documents(data.where("false"), bench).count() == 0
    assert decontamination.contaminated_documents(data, bench.where("false")).count() == 0


def test_line_dedup(spark, docs):
    got = {r.doc_id: r for r in line_dedup.line_report(docs).collect()}
    assert got[14].removed_lines == "1" and got[14].n_lines == 3
    assert got[3].removed_lines == "0" and got[5].n_lines == 0 and got[1].n_removed == 0
    assert got[11].removed_lines == "1" and got[10].n_removed == 0
    left = {r.doc_id: r.text for r in line_dedup.drop_repeated_lines(docs).collect()}
    assert 3 not in left and left[5] is None and left[14] == "Line of five words here.\nend"
    assert line_dedup.line_report(docs.where("false")).count() == 0


def test_word_edits_match_the_table():
    def table(a, b):
        p = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            q = [i]
            for j, y in enumerate(b, 1):
                q.append(min(p[j] + 1, q[-1] + 1, p[j - 1] + (x != y)))
            p = q
        return p[-1]

    rng = random.Random(1)
    for _ in range(300):
        a, b = ([rng.choice("abc") for _ in range(rng.randint(0, 9))] for _ in range(2))
        assert line_dedup.word_edits(a, b) == table(a, b)


def edited(rng, words, edits):
    """Words with some of them replaced, left out or put in."""
    out = list(words)
    for _ in range(edits):
        kind, at = rng.randrange(3), rng.randrange(len(out))
        if kind == 0:
            out[at] = f"new{rng.randrange(10 ** 6)}"
        elif kind == 1 and len(out) > 5:
            del out[at]
        else:
            out.insert(at, rng.choice(WORDS))
    return out


def test_lines_with_edits_are_found(spark):
    """Lines of 5 to 60 words over common and rare words, one edit and as many as the similarity allows, against brute force."""
    rng = random.Random(2)
    rows, pairs = [], []
    for n in (5, 7, 10, 15, 20, 30, 50, 60):
        for i in range(24):
            words = [rng.choice(WORDS[:40]) if rng.random() < 0.5 else f"rare{rng.randrange(10 ** 5)}" for _ in range(n)]
            other = edited(rng, words, 1 if i % 2 else max(1, n // 6))
            a, b = len(rows), len(rows) + 1
            rows += [(a, " ".join(words).capitalize() + "."), (b, " ".join(other))]
            pairs.append((n, a, b, line_dedup.alike(words, other, 0.8)))
    _, removed = line_dedup.repeated_lines(frame(spark, rows))
    gone = {r.doc_id for r in removed.collect()}
    links = [(n, b in gone) for n, _, b, same in pairs if same]
    assert len(links) > 150 and sum(found for _, found in links) >= 0.97 * len(links)
    assert all(a not in gone for _, a, _, _ in pairs) and all(b not in gone for _, _, b, same in pairs if not same)


def test_lines_of_any_length_and_clashing_columns(spark):
    rows = [(1, "a b c d\nother words"), (2, "A b, c d!\nwhat else"), (3, "a b c d"), (None, "a b c d"), (4, None), (5, ""), (6, "one"), (7, "One")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "1 AS _gone", "2 AS _of", "3 AS _left", "4 AS h", "5 AS line_no", "6 AS id")
    left = [(r.doc_id, r.text) for r in line_dedup.drop_repeated_lines(docs).collect()]
    assert sorted(left, key=repr) == sorted([(1, rows[0][1]), (2, "what else"), (None, "a b c d"), (4, None), (5, ""), (6, "one")], key=repr)
    assert line_dedup.drop_repeated_lines(docs).columns == docs.columns


def test_groups_of_line_copies_larger_than_a_block(spark):
    """Copies with one word of their own each, cut into blocks, and two kinds that share their rare words only."""
    rng = random.Random(4)
    base = [f"base{i}" for i in range(20)]
    rows = [(i, " ".join(base[:i % 20] + [f"own{i}"] + base[i % 20 + 1:])) for i in range(60)]
    rows += [(100 + i, " ".join(base[:4] + [f"x{rng.randrange(10 ** 6)}" for _ in range(16)])) for i in range(12)]
    _, removed = line_dedup.repeated_lines(frame(spark, rows), block=8)
    assert {r.doc_id for r in removed.collect()} == set(range(1, 60))


def test_links_do_not_depend_on_the_order_of_lines():
    rng = random.Random(6)
    lines = [[rng.choice("abcdef") for _ in range(6)] for _ in range(60)]
    sims = np.array([line_dedup.hash_lines([" ".join(x)])[4][0] for x in lines])
    want = {(i, j) for i in range(60) for j in range(i) if line_dedup.alike(lines[i], lines[j], 0.8)
            and bin(int(sims[i]) ^ int(sims[j]) & (1 << 64) - 1).count("1") <= line_dedup.FAR}

    def parts(links):
        root = list(range(60))
        for _ in range(60):
            for i, j in links:
                root[i] = root[j] = min(root[i], root[j])
        return root

    assert parts(line_dedup.link_group(sims, lines, np.arange(60), 0.8)) == parts(want)


def test_quality_rules(spark, docs):
    good = " ".join(["Some plain words stand here."] * 1 + [text(31, 20) + "."])
    rows = [(1, good), (2, None), (3, ""), (4, "a b c d e " * 10), (5, "A | B | C | D | E | F | G | H | I | J | K | L"), (6, good)]
    got = {r.doc_id: r for r in quality_rules.clean_lines(frame(spark, rows)).collect()}
    assert got[1].kept and got[6].kept and not got[5].kept and not got[5].base_failed
    assert got[2].n_words == 0 and got[2].base_failed and got[3].base_failed
    assert got[4].n_repeat_words == 50 and got[4].base_failed
    assert quality_rules.clean_lines(docs.where("false")).count() == 0


def test_language_id(spark):
    rng = random.Random(9)
    kinds = {"xx": ["the", "and", "thing", "other", "with"], "yy": ["der", "und", "nicht", "schön", "über"]}
    rows = [(i, " ".join(rng.choice(kinds[lang]) for _ in range(12)), lang) for i in range(60) for lang in kinds]
    train = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit_language_model(train, language_id.public_pieces())
    ask = spark.createDataFrame([(1, "the other thing"), (2, "nicht über"), (3, None), (4, "12 !?"), (5, "und " * 3000)], "doc_id long, text string")
    got = {r.doc_id: r for r in language_id.predict_language(ask, model).collect()}
    assert [got[i].lang_pred for i in range(1, 6)] == ["xx", "yy", "und", "und", "yy"]
    assert all(0 <= r.score <= 1 for r in got.values())
    none = language_id.fit_language_model(train.where("false"), language_id.public_pieces())
    assert {r.lang_pred for r in language_id.predict_language(ask, none).collect()} == {"und"}


def test_forward_sums_all_segmentations():
    pieces = language_id.Pieces.build(["▁a", "▁", "a", "b", "ab", "▁ab"])
    prob = np.array([[0.01], [0.2], [0.1], [0.3], [0.15], [0.14], [0.1]])
    (_, codes), = language_id._by_length(["ab"])
    want = 0.2 * 0.15 + 0.1 * 0.3 * 0.15 + 0.1 * 0.14 + 0.1
    assert np.isclose(np.exp(language_id.forward(pieces.lattice(codes), prob)[0][0, 0]), want)


def test_html_extraction(spark):
    page = ("<html><head><title>t</title></head><body><header><h1>Site</h1></header><nav>menu</nav><div id='cookie-notice'>we</div>"
            "<article><h1>T &amp; U</h1><p>One  two<p>Three<br>four<div class='ad'>buy</div><form>q</form></article>"
            "<section class='comments'>c</section><footer>f</footer><script>var x='</p>'</script></body></html>")
    bare = "<div><div class='x'><div>Same on all</div></div><p>Own text number {}</p></div>"
    rows = [(1, "http://a.example/1", page), (2, None, None), (3, "http://a.example/2", "")] + [
        (10 + i, f"http://b.example/{i}", bare.format(i)) for i in range(6)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_extraction.extract_main_text(pages).collect()}
    assert got[1] == "T & U\n\nOne two\n\nThree four" and got[2] == "" and got[3] == ""
    assert got[12] == "Own text number 2"
    assert html_extraction.extract_main_text(pages.where("false")).count() == 0


def test_html_templates_do_not_depend_on_the_size_of_the_host(spark):
    section = "<div class='x'><div>Section menu</div></div>"
    rows = [(i, f"http://big.example/{i}", f"<div>{section if i < 6 else ''}<p>Own text {i}</p></div>") for i in range(60)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_extraction.extract_main_text(pages).collect()}
    assert all(got[i] == f"Own text {i}" for i in range(60))


def test_bpe_equals_the_library(spark, docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    extra = frame(spark, [(90, "日本語 ½ Ⅷ　 <|endoftext|>x  \n\n y's"), (91, "the" * 400 + " é" * 300)])
    vocabulary = bpe.public_vocabulary(spark)
    rows = docs.union(extra)
    got = bpe.bpe_decode(bpe.bpe_encode(rows, vocabulary), vocabulary).collect()
    texts = {r.doc_id: r.text or "" for r in rows.collect()}
    for r in got:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == ids and r.n_tokens == len(ids)
        assert r.decoded == library.decode(ids, skip_special_tokens=False)
    assert bpe.bpe_encode(docs.where("false"), vocabulary).count() == 0


def test_kneser_ney_probabilities_sum_to_one(spark):
    model = kneser_ney.fit_kneser_ney(frame(spark, [(i, text(i, 200)) for i in range(5)]))
    assert np.allclose(model.lower.sum(axis=1), 1.0)
    top = {t: p for r in model.shards.collect() for t, p in zip(r.t, r.part)}
    context = next(iter(top)) // kneser_ney.V
    share = sum(p for t, p in top.items() if t // kneser_ney.V == context)
    assert np.isclose(share + model.back[context], 1.0)


def test_quality_classifier(spark, docs):
    good = [(i, text(100 + i, 150) + ".") for i in range(60)]
    rows = frame(spark, good + [(200, "BUY!! ### NOW!! $$$ " * 40), (201, None), (202, ""), (203, "w1 w2.")])
    labels = spark.createDataFrame([(i, 1, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in kneser_ney.classify_quality(rows, labels, least=5).collect()}
    assert not got[200].kept and got[201].kept and got[202].kept and got[203].kept
    assert sum(not got[i].kept for i in range(60)) <= 1
    none = kneser_ney.classify_quality(rows, labels.where("false"))
    assert none.where("not kept").count() == 0
    assert kneser_ney.classify_quality(rows.where("false"), labels).count() == 0


def test_masked_lm_learns_and_is_repeatable(spark):
    rows = frame(spark, [(i, "a b c d e f " * 40) for i in range(30)] + [(99, "f a d b e c " * 40), (100, None), (101, "")])
    train = rows.where("doc_id < 99")
    model = masked_lm.fit_masked_model(train)
    got = {r.doc_id: r for r in masked_lm.score_documents(rows, model).collect()}
    assert got[1].log_likelihood > got[99].log_likelihood and got[100].n_tokens == 0 and got[101].log_likelihood == 0
    again = masked_lm.fit_masked_model(train)
    assert np.array_equal(model.net.flat(), again.net.flat())


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_queries_match_sql(spark, name):
    assert compare(queries.QUERIES[name](spark, SF), connect(SF), queries.SQL[name]) is None


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_pipeline_stages_keep_columns_and_take_effect(spark):
    import corpus_pipeline

    first = spark.read.parquet(f"{SF}/documents.parquet")
    rows, sizes = first, [first.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        rows = spark.createDataFrame(stage(spark, rows, SF).collect(), first.schema)
        assert rows.columns == first.columns
        sizes.append(rows.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] < sizes[0]
    final = corpus_pipeline.run(spark, SF).collect()
    texts = {r.doc_id: r.text for r in rows.collect()}
    assert {r.doc_id for r in final} == set(texts)
    assert all(r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() for r in final)
