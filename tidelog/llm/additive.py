"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature is cut into bins.  Shallow trees on one feature at a time, in turns, add up to a lookup
table per feature; then trees on two features do so for the pairs that explain most of what is left.
A score is the sum of table entries, so every decision can be read off the tables.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.common import appended, double, integer, labelled
from tidelog.llm.repetition import NGRAM_SHARES, measured

#: Bounds of the labelled sample: rows of each label, and bytes of a text that is learned from.
MAX_LOW, MAX_HIGH, MAX_TEXT = 3000, 6000, 1 << 18
BINS, PAIR_BINS, PAIRS = 32, 8, 12
ROUNDS, PAIR_ROUNDS, RATE = 300, 150, 0.1
UPPER = bytes(range(65, 91))
LETTERS = UPPER + bytes(range(97, 123)) + bytes(range(128, 256))
DIGITS = b"0123456789"
NAMES = ("words", "word_length", "symbols", "dup_lines", "dup_line_chars", "short_ngrams", "long_ngrams", "distinct",
         "upper", "letters", "digits", "marks", "bars", "line_words", "capitalised", "same_end")


def described(texts: list[str]) -> np.ndarray:
    """One row of features per text: sizes, and shares that do not depend on its length."""
    m = measured(texts)
    raw = [t.encode() for t in texts]

    def share(chars: bytes) -> np.ndarray:
        return np.array([(len(r) - len(r.translate(None, chars))) / max(1, len(r)) for r in raw])

    split = [r.split() for r in raw]
    words, lines, chars = (np.maximum(m[c], 1) for c in ("n_words", "n_lines", "word_chars"))
    first, last = min(NGRAM_SHARES), max(NGRAM_SHARES)
    ends = np.array([max((e.count(c) for c in b"!%&$#*"), default=0)
                     for e in (bytes([w[-1] for w in s]) for s in split)], float)
    return np.column_stack([
        np.log1p(m["n_words"]), m["word_chars"] / words, m["n_symbols"] / words, m["n_dup_lines"] / lines,
        m["dup_line_chars"] / np.maximum(m["line_chars"], 1), m[f"chars_{first}"] / chars, m[f"chars_{last}"] / chars,
        np.array([len(set(s)) for s in split]) / words, share(UPPER), share(LETTERS), share(DIGITS),
        share(b"!?"), share(b"|"), m["n_words"] / lines,
        np.array([sum(w[0] < 91 and w[0] > 64 for w in s) for s in split]) / words, ends / words])


@dataclass(frozen=True)
class Model:
    edges: list[np.ndarray]
    coarse: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]
    base: float

    def binned(self, x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(edges)])

    def margins(self, x: np.ndarray) -> np.ndarray:
        fine, rough = self.binned(x, self.edges), self.binned(x, self.coarse)
        out = np.full(len(x), self.base)
        for j, t in enumerate(self.tables):
            out += t[fine[:, j]]
        for (i, j), t in zip(self.pairs, self.pair_tables):
            out += t[rough[:, i], rough[:, j]]
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(x), -30, 30)))


def _gain(g, h):
    return g * g / (h + 1.0)


def _split(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Best gain of cutting a row of bins in two, and how many bins go left."""
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gains = _gain(left_g, left_h) + _gain(g.sum() - left_g, h.sum() - left_h) - _gain(g.sum(), h.sum())
    if not len(gains):
        return 0.0, len(g)
    best = int(np.argmax(gains))
    return float(gains[best]), best + 1


def tree(g: np.ndarray, h: np.ndarray, leaves: int = 3) -> np.ndarray:
    """Leaf values per bin of a tree with few leaves on one feature."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        found = [(*_split(g[a:b], h[a:b]), a, b) for a, b in parts]
        gain, cut, a, b = max(found)
        if gain <= 1e-9:
            break
        parts.remove((a, b))
        parts += [(a, a + cut), (a + cut, b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + 1.0)
    return out


def pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and leaf values of a tree that cuts the rows of a grid once, and each half by columns."""
    best, out = 0.0, np.zeros_like(g)
    whole = _gain(g.sum(), h.sum())
    for cut in range(1, g.shape[0]):
        halves = [(slice(0, cut), g[:cut].sum(0), h[:cut].sum(0)), (slice(cut, None), g[cut:].sum(0), h[cut:].sum(0))]
        found = [(_split(a, b), rows, a, b) for rows, a, b in halves]
        gain = sum(f[0][0] + _gain(f[2].sum(), f[3].sum()) for f in found) - whole
        if gain > best:
            best, out = gain, np.zeros_like(g)
            for (_, at), rows, a, b in found:
                for cols in (slice(0, at), slice(at, None)):
                    out[rows, cols] = a[cols].sum() / (b[cols].sum() + 1.0)
    return best, out


def train(x: np.ndarray, y: np.ndarray) -> Model:
    """Cyclic boosting of the log loss.  With rows of one label only, every score is that label's share."""
    def cuts(bins):
        return [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) if len(x) else np.zeros(0)
                for j in range(x.shape[1])]

    share = (y.sum() + 1) / (len(y) + 2)
    edges, coarse = cuts(BINS), cuts(PAIR_BINS)
    tables = [np.zeros(len(e) + 1) for e in edges]
    model = Model(edges, coarse, tables, [], [], float(np.log(share / (1 - share))))
    if len(set(y.tolist())) < 2:
        return model
    fine, rough = model.binned(x, edges), model.binned(x, coarse)
    margin = np.full(len(y), model.base)

    def slopes():
        p = 1 / (1 + np.exp(-margin))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j, t in enumerate(tables):
            g, h = slopes()
            step = RATE * tree(np.bincount(fine[:, j], g, len(t)), np.bincount(fine[:, j], h, len(t)))
            t += step
            margin += step[fine[:, j]]

    def grid(i, j):
        g, h = slopes()
        shape = len(coarse[i]) + 1, len(coarse[j]) + 1
        at = rough[:, i] * shape[1] + rough[:, j]
        return (np.bincount(at, g, shape[0] * shape[1]).reshape(shape),
                np.bincount(at, h, shape[0] * shape[1]).reshape(shape))

    ranked = sorted(combinations(range(x.shape[1]), 2), key=lambda p: -pair_tree(*grid(*p))[0])
    for i, j in ranked[:PAIRS]:
        model.pairs.append((i, j))
        model.pair_tables.append(np.zeros((len(coarse[i]) + 1, len(coarse[j]) + 1)))
    for _ in range(PAIR_ROUNDS):
        for (i, j), t in zip(model.pairs, model.pair_tables):
            step = RATE * pair_tree(*grid(i, j))[1]
            t += step
            margin += step[rough[:, i], rough[:, j]]
    return model


def held_out(doc_id):
    """The quarter of the rows that no model of this file learns from."""
    return F.crc32(doc_id.cast("string")) % 4 == 2


def _describe():
    return lambda texts: [described([t or "" for t in texts]).tolist()]


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Train on a bounded sample of the labelled rows (doc_id, quality) that are not held out."""
    sample = labelled(docs, labels, "quality", held_out, {0: MAX_LOW, 1: MAX_HIGH}, MAX_TEXT, id_col, text_col)
    rows = appended(sample, ["text"], ["label", "hash"], [T.StructField("x", T.ArrayType(T.DoubleType()))],
                    _describe).collect()
    rows.sort(key=lambda r: (r["hash"], r["x"]))
    x = np.array([r["x"] for r in rows]).reshape(-1, len(NAMES))
    return train(x, np.array([r["label"] for r in rows], float))


def _start(model: Model, threshold: float):
    def work(texts):
        scores = model.scores(described([t or "" for t in texts]))
        return [scores.tolist(), (scores >= threshold).astype(int).tolist()]

    return work


def scored(docs: DataFrame, model: Model, threshold: float = 0.7, text_col: str = "text",
           keep: list[str] | None = None) -> DataFrame:
    """``score`` and ``predicted`` of every whole text, with the ``keep`` columns (all by default).

    A null text counts as empty, and the empty text has a score too.  Equal texts get equal scores.  A
    kept column named like a result is replaced.
    """
    return appended(docs, [text_col], docs.columns if keep is None else keep,
                    [double("score"), integer("predicted")], partial(_start, model, threshold))
