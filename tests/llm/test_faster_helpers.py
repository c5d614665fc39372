"""Faster helpers against the plain ways they replace."""

import numpy as np
import pytest

from billrisk.llm import bpe, language_id, masked_lm


def _plain_merges(word: bytes, ranks: dict) -> list[bytes]:
    parts = [word[i:i + 1] for i in range(len(word))]
    while len(parts) > 1:
        least = min(range(len(parts) - 1), key=lambda i: (ranks.get((parts[i], parts[i + 1]), 1 << 40), i))
        if (parts[least], parts[least + 1]) not in ranks:
            break
        parts[least:least + 2] = [parts[least] + parts[least + 1]]
    return parts


def test_words_merge_as_by_hand():
    pairs = [(b"a", b"b"), (b"ab", b"ab"), (b"b", b"a"), (b"a", b"a"), (b"aa", b"b"), (b"abab", b"a")]
    ranks = {p: i for i, p in enumerate(pairs)}
    tokens = [bytes([b]) for b in range(256)] + [a + b for a, b in pairs]
    ids = {t: i for i, t in reversed(list(enumerate(tokens)))}
    rng = np.random.default_rng(5)
    for _ in range(300):
        word = bytes(rng.choice([97, 97, 98, 99, 255], rng.integers(0, 20)).tolist())
        assert bpe.Encoder(ids, ranks, {})._short(word) == _plain_merges(word, ranks)
    assert bpe.Encoder(ids, ranks, {})["ab"] == np.array([ids[b"ab"]], "<u4").tobytes()


@pytest.mark.parametrize("least", [1e-3, 1e-60])
def test_word_sums_without_scale_are_those_with_it(least):
    pieces = language_id.Pieces.build(["▁a", "a", "b", "ab", "▁ab", "ba", "bab", "é"])
    prob = np.linspace(0.3, 0.02, pieces.size * 2).reshape(-1, 2)
    prob[0] = least
    for _, codes in language_id._by_length(["a", "abab", "xyz", "babé", "ababababx", "😀"]):
        lattice = pieces.lattice(codes)
        assert np.allclose(language_id.word_logs(lattice, prob), language_id.forward(lattice, prob)[0], rtol=1e-12)


def _plain_logs(net: masked_lm.Network, context: np.ndarray, target: np.ndarray) -> np.ndarray:
    h = net.hidden(context).astype(float)
    out = np.zeros(len(target))
    for i, t in enumerate(target):
        for z, k in ((h[i] @ net.group, t // masked_lm.SIZE), (h[i] @ net.word[t // masked_lm.SIZE], t % masked_lm.SIZE)):
            out[i] += z[k] - np.log(np.exp(z - z.max()).sum()) - z.max()
    return out


@pytest.mark.parametrize("n", [1, 7, 300])
def test_masked_words_by_group_are_those_one_by_one(n):
    rng = np.random.default_rng(n)
    size = masked_lm.GROUPS * masked_lm.SIZE
    net = masked_lm.Network.start()
    context, target = rng.integers(0, size + 1, (2 * masked_lm.WIDTH, n)).astype(np.int16), rng.integers(0, size, n).astype(np.int16)
    order, groups = masked_lm._by_group(target // masked_lm.SIZE)
    assert [g for g, a, b in groups for _ in range(a, b)] == (target[order] // masked_lm.SIZE).tolist()
    assert np.allclose(masked_lm.log_probabilities(net, context, target), _plain_logs(net, context, target), atol=1e-4)
    before = _plain_logs(net, context, target).mean()
    trainer = masked_lm._Trainer(net, 0.05)
    for _ in range(3):
        trainer.step(context, target)
    assert _plain_logs(net, context, target).mean() > before


def test_known_words_of_the_masked_model_outlast_the_memory_of_rare_ones():
    ids = masked_lm._Ids(["the", "of"], limit=3)
    whole = masked_lm._Ids(["the", "of"])
    texts = ["the cat of x", None, "", "of y z the \u00e9", "the cat"]
    for text in texts:
        for a, b in zip(ids.laid_out([text]), whole.laid_out([text])):
            assert a.tolist() == b.tolist()
    assert len(ids) < len(whole) and ids["of"] == 1
