"""Members of long lists that meet in blocks, against every pair of them."""

import numpy as np
import pytest

from billrisk.llm import ngram_join


def _sets():
    """Sets of 20, 1,000 and 1,040 members (whose sketches differ in length) with some members changed."""
    rng = np.random.default_rng(8)
    out = []
    for size in (20, 1000, 1040):
        base = rng.integers(0, 1 << 63, size, dtype=np.uint64)
        for changed in (0, 1, 1, 2, size // 30, size // 5):
            grams = base.copy()
            grams[:changed] = rng.integers(0, 1 << 63, changed, dtype=np.uint64)
            out.append(np.unique(grams))
    out.append(np.unique(np.concatenate([out[6], rng.integers(0, 1 << 63, 40, dtype=np.uint64)])))
    return out


@pytest.mark.parametrize("block", [3, 5, 100])
def test_blocks_find_the_pairs_that_all_pairs_find(spark, block):
    sets, percent, rng = _sets(), 90, np.random.default_rng(2)
    classes = spark.createDataFrame([(i, len(s), ngram_join._parity(s).tolist()) for i, s in enumerate(sets)],
                                    "cid long, n long, sketch array<long>")
    comps = rng.integers(0, 4, len(sets)).tolist()
    members = []
    for key, ids in ((1, range(len(sets))), (2, range(6, len(sets))), (3, [0, 1])):
        of = [comps[i] for i in ids]
        top = max(set(of), key=of.count)
        rest = sum(c != top for c in of)
        members += [(key, i, comps[i], len(of), rest, comps[i] != top) for i in ids]
    members = spark.createDataFrame(members, "key long, id long, comp long, all long, rest long, aside boolean")
    found = [tuple(r) for r in ngram_join.meet_in_blocks(members, classes, percent, block).collect()]
    wanted = set()
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            shared = len(np.intersect1d(a, b))
            if comps[i] != comps[j] and 100 * shared >= percent * (len(a) + len(b) - shared):
                wanted.add((j, i))
    assert wanted and wanted <= set(found)  # none that links is ruled out
    assert all(a < b and comps[a] != comps[b] for a, b in found) and not any(abs(len(sets[a]) - len(sets[b])) > 200 for a, b in found)


def test_pairs_that_cannot_link_make_no_rows(spark, monkeypatch):
    """Texts that each change one word of the same text meet in its lists, but do not link with each other."""
    words = [f"w{i}" for i in range(30)]
    rows = [(d, " ".join(words[:d % 28] + [f"x{d}"] + words[d % 28 + 1:])) for d in range(120)]
    rows.append((120, rows[7][1] + " w30"))
    made, plain = [], ngram_join.meet_in_blocks

    def counted(*args, **kwargs):
        made.append(plain(*args, **kwargs))
        return made[-1]

    monkeypatch.setattr(ngram_join, "meet_in_blocks", counted)
    seen = []
    cut = ngram_join.link_lists

    def lists(table, verify, *args, **kwargs):
        def watched(pairs):
            seen.append(pairs.count())
            return verify(pairs)
        return cut(table, watched, *args, **kwargs)

    monkeypatch.setattr(ngram_join, "link_lists", lists)
    got = {r.doc_id: r for r in ngram_join.ngram_jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert made and max(seen) < 60 * len(rows) / 2
    grams = {d: {tuple(t.split()[i:i + 3]) for i in range(len(t.split()) - 2)} for d, t in rows}
    links = {d: sum(100 * len(g & h) >= 90 * len(g | h) for e, h in grams.items() if e != d) for d, g in grams.items()}
    assert {d: r.n_links for d, r in got.items()} == links and got[120].component_id == 7
