"""Language identification by unigram piece models, summed over all segmentations of a word."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from billrisk.llm.common import written

_LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")  # a word holds the marks on its letters
_BASE = np.uint64(0x100000001B3)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
UNKNOWN = 0  # index of "a character that no piece covers"


def public_pieces(name: str = "piece_bpe_32k.model") -> list[str]:
    """Pieces of a public vocabulary, most frequent first; the mark U+2581 stands for a word's start."""
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
    plain = (i for i in range(model.vocab_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)))
    return [model.id_to_piece(i) for i in plain]


def _code(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


@dataclass
class Pieces:
    """Vocabulary as a sorted array of rolling hashes; ``index`` 0 is the unknown character."""

    hashes: np.ndarray
    index: np.ndarray
    longest: int
    size: int

    def __post_init__(self):
        self.seen = np.zeros(1 << 20, bool)  # cells that hold a piece; most runs of characters are in none of them
        self.seen[self._cells(self.hashes)] = True

    @staticmethod
    def _cells(hashes: np.ndarray) -> np.ndarray:
        return hashes * _SPREAD >> np.uint64(44)

    def plain(self) -> tuple:
        """Arrays and numbers only, to be sent to tasks that may not have this package."""
        return self.hashes, self.index, self.longest, self.size

    @classmethod
    def build(cls, pieces: list[str]) -> Pieces:
        keys = []
        for piece in pieces:
            h = np.uint64(0)
            with np.errstate(over="ignore"):
                for c in _code(piece):
                    h = h * _BASE + np.uint64(c) + np.uint64(1)
            keys.append(h)
        keys = np.array(keys, np.uint64)
        order = np.argsort(keys, kind="stable")
        return cls(keys[order], order.astype(np.int64) + 1, max(map(len, pieces)), len(pieces) + 1)

    def lattice(self, codes: np.ndarray) -> np.ndarray:
        """[word, start, length - 1] -> piece index, -1 where there is none; single characters always have one."""
        n, width = codes.shape
        deep = min(self.longest, width)
        out = np.full((n, width, deep), -1, np.int32)
        h = np.zeros((n, width), np.uint64)
        for k in range(deep):
            h = h[:, :width - k] * _BASE + codes[:, k:].astype(np.uint64) + np.uint64(1)
            row, start = np.nonzero(self.seen[self._cells(h)])
            wanted = h[row, start]
            at = np.searchsorted(self.hashes, wanted)
            at[at == len(self.hashes)] = 0
            out[row, start, k] = np.where(self.hashes[at] == wanted, self.index[at], -1)
        out[:, :, 0] = np.maximum(out[:, :, 0], UNKNOWN)
        return out


def _by_length(words: list[str], cells: int = 60_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, code matrix) of words of equal length, in blocks of bounded size."""
    if not words:
        return
    lengths = np.array([len(w) + 1 for w in words])
    order = np.argsort(lengths, kind="stable")
    edges = np.flatnonzero(np.diff(lengths[order])) + 1
    for group in np.split(order, edges):
        step = max(1, cells // lengths[group[0]])
        for i in range(0, len(group), step):
            block = group[i:i + step]
            yield block, _code("".join(["▁" + words[j] for j in block])).reshape(len(block), -1)


def forward(lattice: np.ndarray, prob: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sum over segmentations of the product of piece probabilities, for every language.

    ``prob`` is [piece, language].  Gives log sums [word, language], and the
    scaled prefix sums [place, word, language] with the logarithm of their scale.
    """
    n, width, deep = lattice.shape
    languages = prob.shape[1]
    alpha = np.zeros((width + 1, n, languages))
    scale = np.zeros((width + 1, n, 1))
    alpha[0] = 1.0
    for t in range(1, width + 1):
        for k in range(min(deep, t)):
            piece = lattice[:, t - 1 - k, k]
            rows = np.flatnonzero(piece >= 0)
            if len(rows):
                s = t - 1 - k
                shift = np.exp(scale[s, rows] - scale[t - 1, rows])
                alpha[t, rows] += alpha[s, rows] * prob[piece[rows]] * shift
        peak = alpha[t].max(axis=1, keepdims=True)
        alpha[t] /= peak
        scale[t] = scale[t - 1] + np.log(peak)
    with np.errstate(divide="ignore"):
        return np.log(np.maximum(alpha[width], 1e-300)) + scale[width], alpha, scale


def word_logs(lattice: np.ndarray, prob: np.ndarray) -> np.ndarray:
    """The log sums of ``forward``; words too short to leave the range of a double need no scale."""
    n, width, deep = lattice.shape
    if not prob.size or width * -np.log10(prob.min()) > 290:
        return forward(lattice, prob)[0]
    alpha = [np.ones((n, prob.shape[1]))]
    for t in range(1, width + 1):
        here = np.zeros_like(alpha[0])
        for k in range(min(deep, t)):
            piece = lattice[:, t - 1 - k, k]
            rows = np.flatnonzero(piece >= 0)
            if len(rows) == n:
                here += alpha[t - 1 - k] * prob[piece]
            elif len(rows):
                here[rows] += alpha[t - 1 - k][rows] * prob[piece[rows]]
        alpha.append(here)
    return np.log(alpha[width])


def expected_counts(lattice: np.ndarray, prob: np.ndarray, weight: np.ndarray, out: np.ndarray) -> None:
    """Add to ``out`` [piece] each word's expected piece uses times its weight, under one language's ``prob``."""
    total, alpha, scale = forward(lattice, prob)
    n, width, deep = lattice.shape
    beta, back = np.zeros((width + 1, n)), np.zeros((width + 1, n))
    beta[width] = 1.0
    for s in range(width - 1, -1, -1):
        for k in range(min(deep, width - s)):
            piece = lattice[:, s, k]
            rows = np.flatnonzero(piece >= 0)
            if not len(rows):
                continue
            t = s + 1 + k
            step = prob[piece[rows], 0] * beta[t, rows]
            beta[s, rows] += step * np.exp(back[t, rows] - back[s + 1, rows])
            use = alpha[s, rows, 0] * step * np.exp(scale[s, rows, 0] + back[t, rows] - total[rows, 0])
            np.add.at(out, piece[rows], use * weight[rows])
        peak = beta[s].copy()
        beta[s] /= peak
        back[s] = back[s + 1] + np.log(peak)


@dataclass
class LanguageModel:
    """Piece probabilities [piece, language]; its size is vocabulary times languages."""

    pieces: Pieces
    languages: list[str]
    prob: np.ndarray
    prior: np.ndarray = field(default_factory=lambda: np.zeros(0))


def _word_counts(docs: DataFrame, limit: int = 200_000) -> DataFrame:
    """(lang, word, n) over whole texts; counts of a task are combined before the shuffle."""
    def tally(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        counts: dict[str, Counter] = {}

        def flush():
            rows = [(lang, run, n) for lang, c in counts.items() for token, n in c.items()
                    for run in _LETTERS.findall(token)]
            counts.clear()
            for i in range(0, len(rows), 50_000):
                lang, word, n = zip(*rows[i:i + 50_000])
                yield pa.RecordBatch.from_arrays([pa.array(lang), pa.array(word), pa.array(n, pa.int64())], ["lang", "word", "n"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if text:
                    counts.setdefault(lang, Counter()).update(text.lower().split())
            if sum(map(len, counts.values())) > limit:
                yield from flush()
        yield from flush()

    parts = docs.select("lang", "text").mapInArrow(tally, "lang string, word string, n long")
    return parts.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def fit_language_model(docs: DataFrame, pieces: list[str], lang_col: str = "lang", text_col: str = "text",
                       rounds: int = 1, smoothing: float = 0.1) -> LanguageModel:
    """Expectation-maximisation of piece probabilities per language, from all texts whose language is known.

    Starts from frequencies that fall with the rank in the vocabulary.  Tasks
    return expected counts per (language, piece), so what reaches the driver is
    bounded by vocabulary times languages.
    """
    spark = docs.sparkSession
    known = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("lang is not null and text is not null")
    words = written(_word_counts(known), "language-words")
    table = Pieces.build(pieces)
    totals = {r.lang: r.n for r in words.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    languages = sorted(totals)
    start = 1.0 / (np.arange(table.size) + 50.0)
    start[UNKNOWN] = start[-1]
    prob = np.repeat((start / start.sum())[:, None], len(languages), axis=1)
    for _ in range(rounds if languages else 0):
        shared = spark.sparkContext.broadcast((table.plain(), languages, prob))

        def expect(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
            plain, languages, prob = shared.value
            table = Pieces(*plain)
            place = {lang: i for i, lang in enumerate(languages)}
            sums = np.zeros((len(languages), table.size))
            for batch in batches:
                lang = np.array([place[x] for x in batch.column(0).to_pylist()])
                word, n = batch.column(1).to_pylist(), np.array(batch.column(2).to_pylist(), float)
                for block, codes in _by_length(word):
                    lattice = table.lattice(codes)
                    for i in np.unique(lang[block]):
                        mine = lang[block] == i
                        expected_counts(lattice[mine], prob[:, i:i + 1], n[block][mine], sums[i])
            i, piece = np.nonzero(sums)
            yield pa.RecordBatch.from_arrays(
                [pa.array(i.astype(np.int32)), pa.array(piece.astype(np.int32)), pa.array(np.rint(sums[i, piece] * 1024).astype(np.int64))],
                ["i", "piece", "n"])

        counts = words.mapInArrow(expect, "i int, piece int, n long").groupBy("i", "piece").agg(F.sum("n").alias("n"))
        prob = np.full((table.size, len(languages)), smoothing)
        found = counts.toPandas()  # at most one row per piece and language
        np.add.at(prob, (found.piece.to_numpy(), found.i.to_numpy()), found.n.to_numpy() / 1024)
        prob /= prob.sum(axis=0)
    share = np.array([totals[x] for x in languages], float)
    return LanguageModel(table, languages, prob, np.log(share / share.sum()) if languages else share)


class _TokenScores(dict):
    """Text token -> row of a matrix of log sums per language; rows of new tokens are filled block by block."""

    def __init__(self, model: LanguageModel):
        super().__init__()
        self.model, self.fresh = model, []
        self.matrix = np.zeros((0, len(model.languages) + 1))

    def __missing__(self, token: str) -> int:
        row = self[token] = len(self)
        self.fresh.append(token)
        return row

    def fill(self) -> None:
        runs = [_LETTERS.findall(token) for token in self.fresh]
        owner = np.repeat(np.arange(len(runs)), [len(r) for r in runs])
        words = [w for r in runs for w in r]
        rows = np.zeros((len(runs), self.matrix.shape[1]))
        rows[:, -1] = [len(r) for r in runs]
        for block, codes in _by_length(words if self.model.languages else []):
            np.add.at(rows[:, :-1], owner[block], word_logs(self.model.pieces.lattice(codes), self.model.prob))
        self.matrix = np.concatenate([self.matrix, rows])
        self.fresh = []


def predict_language(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text",
                     remember: int = 200_000) -> DataFrame:
    """(doc_id, lang_pred, score) of every whole text; score is the language's posterior probability.

    ``und`` with score 0 if the text is null or has no letter (Unicode category
    L), or if the model knows no language.  Ties go to the first language in
    text order.  One row per row, repeated and null ids included; texts of any
    length are read whole; an empty table gives an empty result; extra columns
    are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.pieces.plain(), model.languages, model.prob, model.prior))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        plain, *rest = shared.value
        model = LanguageModel(Pieces(*plain), *rest)
        scores = _TokenScores(model)
        for batch in batches:
            ids, pred, post = batch.column(0), [], []
            texts = batch.column(1).to_pylist()
            for i in range(0, len(texts), 200):
                if len(scores) > remember:
                    scores = _TokenScores(model)
                rows = [[scores[token] for token in text.lower().split()] if text else [] for text in texts[i:i + 200]]
                scores.fill()
                for row in rows:
                    sums = scores.matrix[row].sum(axis=0)
                    if not sums[-1] or not model.languages:
                        pred.append("und")
                        post.append(0.0)
                        continue
                    logs = sums[:-1] + model.prior
                    best = int(logs.argmax())
                    pred.append(model.languages[best])
                    post.append(float(1.0 / np.exp(logs - logs[best]).sum()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(pred, pa.string()), pa.array(post, pa.float64())],
                                             ["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")


def held_out(id_col: str = "doc_id"):
    """crc32 of the id as text, modulo 5, is 0; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0
