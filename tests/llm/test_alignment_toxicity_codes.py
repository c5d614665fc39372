"""Tokenizer alignment, toxic spans and vector codes against brute force, with hard rows."""

import hashlib
import itertools
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

import pyarrow.parquet as pq  # noqa: E402
import sentencepiece  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from billrisk.llm import alignment, queries, toxicity, vector_codes  # noqa: E402
from billrisk.llm.bpe import byte_symbols  # noqa: E402
from suite.check import compare, connect  # noqa: E402

SF = "/root/testdata/sf0.001"
SIZE_B = 32000

# --------------------------------------------------------------- alignment

TEXTS = [
    None, "", " ", "▁", "a▁b", "one", "xq#" * 300, "中文日本語テキスト" * 20, "🙂👩‍👩‍👧" * 50, "<|endoftext|> <s> </s>", "\x00\n\n\t",
    "é" * 100, "ﷺ" * 40 + " z", "  two  spaces ", "the cat sat on the mat. " * 40, "the cat", "the cat", "a" * 3000,
    "word " * 20000, "'twas 3.14, don't\r\n",
]


@pytest.fixture(scope="module")
def sides():
    first = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def brute_groups(text, sides):
    """Groups of (ids of A, ids of B) by the sets of byte offsets where both have an end."""
    if not text:
        return []
    first, second = sides
    symbol = byte_symbols()
    a, b = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
    bytes_a = [bytes(symbol[c] for c in first.id_to_token(i)) for i in a]
    bytes_b = [bytes([int(second.id_to_piece(i)[3:5], 16)]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode() for i in b]
    if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
        return []
    ends = [list(itertools.accumulate(map(len, x))) for x in (bytes_a, bytes_b)]
    groups, at = [], [0, 0]
    for cut in sorted(set(ends[0]) & set(ends[1])):
        to = [ends[0].index(cut, at[0]) + 1, ends[1].index(cut, at[1]) + 1]
        groups.append((a[at[0]:to[0]], b[at[1]:to[1]]))
        at = to
    return groups


def brute_alignment(texts, sides):
    every = [brute_groups(t, sides) for t in texts]
    links = [Counter((x, y) for a, b in groups for x in a for y in b) for groups in every]
    counts = Counter(pair for found in links for pair in found)
    best = {}
    for (a, _), n in counts.items():
        best[a] = max(best.get(a, 0), n)
    out = []
    for groups, found in zip(every, links):
        shown = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), sum(found.values()),
                    sum(n for p, n in found.items() if counts[p] == best[p[0]]), sum(n * counts[p] for p, n in found.items()),
                    hashlib.sha256(shown.encode()).hexdigest() if groups else ""))
    return out


def align(df, carry=500_000):
    files = alignment.TokenizerFiles.public(df.sparkSession)
    aligned = alignment.written(alignment.align_tokenizers(df, files).withColumn(
        "groups_sha256", F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("")).drop("groups"), "aligned")
    return alignment.score_links(aligned, alignment.pair_counts(aligned, files.sizes()[1]), carry).drop("row")


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(i if i else None, t, i, "x", 1.5) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, row long, pairs string, n double")


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("carry", [500_000, 20, 0])
def test_alignment_is_that_of_brute_force(texts, sides, carry):
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in align(texts, carry).collect()}
    want = brute_alignment(TEXTS, sides)
    assert len(got) == len(TEXTS)
    for i, row in enumerate(want):
        assert got[i if i else None] == row, TEXTS[i] and TEXTS[i][:30]


def test_alignment_of_an_empty_table(texts):
    assert align(texts.where("false")).collect() == []


def test_alignment_query_on_the_small_table(spark, sides):
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in queries.QUERIES["op11_tokenizer_alignment"](spark, SF).collect()}
    table = pq.read_table(f"{SF}/documents.parquet").to_pydict()
    assert got == dict(zip(table["doc_id"], brute_alignment(table["text"], sides)))


def test_wide_groups_hold_all_pairs():
    """A group with many tokens on both sides, by the way that counts equal ids."""
    a, b = np.arange(300) % 7, np.arange(200) % 5
    one = np.array([0])
    found = Counter()
    for group, x, y, times in alignment._wide_links(a, b, one, one, np.array([300]), np.array([200]), one):
        for p, q, n in zip(x.tolist(), y.tolist(), times.tolist()):
            found[p, q] += n
    assert found == Counter((int(x), int(y)) for x in a for y in b)


@pytest.mark.parametrize("lane", [1, 3, 128])
def test_lockstep_meets_every_common_end(lane):
    rng = np.random.default_rng(3)
    ends, starts, base = ([], []), [], 0
    for size in (1, 40, 7, 300):
        starts.append(len(ends[0]))
        for side in (0, 1):
            inner = np.sort(rng.choice(np.arange(1, size), size // 3, replace=False)) if size > 3 else np.zeros(0, int)
            ends[side].extend((base + inner).tolist() + [base + size])
        base += size
    a, b = map(np.array, ends)
    cut_a, cut_b, link_a, link_b = alignment.lockstep(a, b, np.array(starts), lane)
    assert a[cut_a].tolist() == b[cut_b].tolist() == sorted(set(a) & set(b))
    begin = [np.concatenate([[0], x[:-1]]) for x in (a, b)]
    overlap = {(i, j) for i in range(len(a)) for j in range(len(b)) if max(begin[0][i], begin[1][j]) < min(a[i], b[j])}
    assert sorted(zip(link_a.tolist(), link_b.tolist())) == sorted(overlap)


# ---------------------------------------------------------------- toxicity


def enumerate_chain(votes, moves):
    """Marginals and move counts by summing over all taggings."""
    total, p, uses = 0.0, np.zeros(len(votes)), np.zeros(3)
    for tags in itertools.product((0, 1), repeat=len(votes)):
        score, last, used = 0.0, 0, np.zeros(3)
        for tag, vote in zip(tags, votes):
            score += tag * vote
            move = {(0, 1): 0, (1, 0): 1, (1, 1): 2}.get((last, tag))
            if move is not None:
                score += moves[move]
                used[move] += 1
            last = tag
        total += np.exp(score)
        p += np.exp(score) * np.array(tags)
        uses += np.exp(score) * used
    return p / total, uses / total


@pytest.mark.parametrize("block", [3, 64])
def test_marginals_are_those_of_enumeration(monkeypatch, block):
    monkeypatch.setattr(toxicity, "_BLOCK", block)
    rng = np.random.default_rng(block)
    for _ in range(10):
        moves, lengths = rng.normal(0, 1.5, 3), rng.integers(0, 11, 5)
        votes = rng.normal(0, 2, lengths.sum())
        p, uses = toxicity.Chain(moves).marginals(votes, lengths, pairs=True)
        at, expected = 0, np.zeros(3)
        for n in lengths:
            if n:
                want, used = enumerate_chain(votes[at:at + n], moves)
                assert np.allclose(p[at:at + n], want)
                expected += used
            at += n
        assert np.allclose(uses, expected)


def test_blocks_do_not_change_long_texts(monkeypatch):
    rng = np.random.default_rng(9)
    votes, lengths = rng.normal(-1, 3, 20_300), np.array([20_000, 0, 300])
    one = toxicity.Chain().marginals(votes, lengths)
    monkeypatch.setattr(toxicity, "_BLOCK", 7)
    assert np.allclose(one, toxicity.Chain().marginals(votes, lengths))


def sentence(rng, n):
    return " ".join("".join(rng.choice(list("aeioubcdfglmnprst"), rng.integers(2, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(2)
    rows, marks = [], []
    for i in range(400):
        words = sentence(rng, 60).split()
        if i % 4 == 0:
            for _ in range(3):
                words.insert(int(rng.integers(0, 60)), "zzqk" + sentence(rng, 1) if i % 8 else "wretch")
        rows.append((i, " ".join(words), "x", 0.0))
        marks.append((i, int(i % 4 == 0), 1))
    rows += [(1000, None, "x", 0.0), (1001, "", "x", 0.0), (1002, " \n 12 !?", "x", 0.0), (None, "one wretch here", "x", 0.0),
             (1003, sentence(rng, 20_000), "x", 0.0), (1004, rows[0][1], "x", 0.0), (1004, rows[0][1], "x", 0.0)]
    marks += [(1000, 1, 1), (None, 1, 1), (2000, None, 1), (3, 0, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, of string, y double")
    return docs, spark.createDataFrame(marks, "doc_id long, toxic int, y int")


def test_toxic_words_never_seen_are_tagged(labelled):
    docs, marks = labelled
    learn = F.coalesce(F.col("doc_id"), F.lit(0)) < 200
    model = toxicity.fit_toxicity(docs.where(learn), marks.where(learn))
    got = {r.doc_id: r for r in toxicity.tag_toxicity(docs, model).collect()}
    text = {r.doc_id: r.text for r in docs.collect()}
    wrong = [i for i in range(200, 400) if got[i].predicted != (i % 4 == 0)]
    assert len(wrong) <= 4
    for i in range(200, 400, 4):
        for span in got[i].spans:
            words = text[i][span.start:span.end].split()
            assert all(w.startswith("zzqk") or w == "wretch" for w in words)
    assert got[None].predicted == 1 and text[None][got[None].spans[0].start:got[None].spans[0].end] == "wretch"
    assert got[1000].score == got[1001].score == got[1002].score < 0.5 and got[1000].spans == []
    assert got[1003].predicted == 0 and got[1004].score == got[0].score
    assert toxicity.tag_toxicity(docs, model).count() == docs.count()
    assert toxicity.tag_toxicity(docs.where("false"), model).collect() == []


def test_toxicity_without_labels(labelled):
    docs, marks = labelled
    for few in (marks.where("false"), marks.where("toxic = 0")):
        model = toxicity.fit_toxicity(docs, few)
        got = toxicity.tag_toxicity(docs, model).collect()
        assert len(got) == docs.count() and all(r.predicted == 0 and 0 <= r.score < 0.5 for r in got)


def test_toxicity_query_on_rows_it_did_not_learn_from(spark):
    path = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries.QUERIES["op12_toxicity"](spark, path).collect()}
    marks = pq.read_table(f"{path}/labels.parquet").to_pydict()
    held = [(got[i].predicted, y) for i, y in zip(marks["doc_id"], marks["toxic"]) if got[i].held_out]
    assert len(held) > 50 and sum(p == y for p, y in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())


# ------------------------------------------------------------ vector codes


def brute_codes(rows, parts=16, entries=64, rounds=2):
    """(code, error) per row and the codebooks, with Python integers and every distance measured."""
    from fractions import Fraction
    from math import floor

    cut = [[tuple(floor(Fraction(x) * 256) for x in v[p * len(v) // parts:(p + 1) * len(v) // parts]) for p in range(parts)] for _, v in rows]
    first = sorted((r for r in zip(rows, cut) if r[0][0] is not None), key=lambda r: (r[0][0], r[0][1]))[:entries]
    books = [[c[p] for _, c in first] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            members = [[] for _ in books[p]]
            for c in cut:
                members[nearest(c[p], books[p])[1]].append(c[p])
            books[p] = [tuple(sum(x) // len(m) for x in zip(*m)) if m else e for m, e in zip(members, books[p])]
    found = [[nearest(c[p], books[p]) for p in range(parts)] for c in cut]
    return [("".join(f"{i:02x}" for _, i in f), sum(d for d, _ in f)) for f in found], books


def vectors(spark, rows):
    named = [(i, v, label, 7, "c", 0, None) for i, v, label in rows]
    return spark.createDataFrame(named, "vec_id long, embedding array<double>, label int, id int, code string, roots int, vector string")


@pytest.mark.parametrize("scale", [1.0, 1e-3, 1e40])
def test_codes_are_those_of_brute_force(spark, scale):
    rng = np.random.default_rng(4)
    values = (rng.normal(0, 0.3, (150, 32)) * scale).tolist()
    rows = [(i * 3 % 151, v, i % 5 or None) for i, v in enumerate(values)]
    rows += [(rows[0][0], values[0], 1), (rows[1][0], values[2], 1), (None, values[3], None), (200, [0.0] * 32, 2), (201, [0.0] * 32, 2)]
    codes = vector_codes.encode_vectors(vectors(spark, rows))
    want, books = brute_codes([(i, v) for i, v, _ in rows])
    got = codes.rows.collect()
    if scale < 1e20:
        assert Counter((r.id, r.code, r.error) for r in got) == Counter((r[0], *w) for r, w in zip(rows, want))
    else:  # errors beyond a long are null
        assert Counter((r.id, r.code) for r in got) == Counter((r[0], w[0]) for r, w in zip(rows, want))
        assert all(r.error == (w if w < 1 << 63 else None) for r in got for w in [dict(zip([x[0] for x in rows], [y[1] for y in want]))[r.id]] if r.id in (200, 201))
    assert codes.digest() == hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()


def test_rows_that_have_no_code(spark):
    bad = [(1, None, 1), (2, [0.1] * 31 + [None], 1), (3, [0.1] * 31 + [float("nan")], 1), (4, [float("-inf")] + [0.1] * 31, 1)]
    kept = [(5, [0.25] * 32, 1), (6, [0.5] * 32, None), (7, [0.5] * 16, 1)]
    got = {r.id: r for r in vector_codes.encode_vectors(vectors(spark, bad + kept)).rows.collect()}
    assert set(got) == {5, 6, 7} and got[7].code is None and got[7].error is None
    assert got[5].code == "00" * 16 and got[6].code == "01" * 16 and got[5].error == 0
    for few in (bad, []):
        codes = vector_codes.encode_vectors(vectors(spark, few))
        assert codes.rows.collect() == [] and codes.digest() == hashlib.sha256(b"").hexdigest()
        assert vector_codes.with_label_error(codes.rows).collect() == []


def test_label_errors_by_both_joins(spark):
    rows = spark.createDataFrame([(i, i % 4 or None, "c", i) for i in range(100)] + [(1, 9, None, None)], "id long, label int, code string, error long")
    want = Counter()
    for i in range(100):
        want[i % 4 or None] += i
    for limit in (100, 0):
        got = vector_codes.with_label_error(rows, broadcast_rows=limit, salts=5).collect()
        assert len(got) == 101 and all(r.label_error == (want[r.label] if r.label != 9 else None) for r in got)


def test_pivots_leave_most_distances_unmeasured():
    rng = np.random.default_rng(6)
    points, entries = np.floor(rng.normal(0, 40, (2000, 4))), np.floor(rng.normal(0, 40, (64, 4)))
    pivots = vector_codes.choose_pivots(entries, 4)
    roots = np.sqrt(vector_codes.squared(points[:, None], pivots[None]))
    index, best, measured = vector_codes.nearest_entries(points, roots, entries, pivots)
    every = vector_codes.squared(points[:, None], entries[None])
    assert (index == every.argmin(axis=1)).all() and (best == every.min(axis=1)).all()
    assert measured < 0.25 * every.size


def test_vector_query_matches_sql(spark):
    assert compare(queries.QUERIES["op13_vector_codes"](spark, SF), connect(SF), queries.SQL["op13_vector_codes"]) is None
