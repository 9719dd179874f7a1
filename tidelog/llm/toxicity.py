"""Toxicity by compression distance: two zstandard dictionaries, one of toxic and one of ordinary text.

Both dictionaries end in the same body of ordinary text and differ in their own part: what covers most
toxic texts and hardly any ordinary ones, or ordinary text of the same length.  A window of a text that
comes out shorter with the toxic dictionary than with the ordinary one holds toxic matter; thresholds
on the saving and the weights of their counts are calibrated on the labelled sample.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from dataclasses import dataclass
from functools import partial

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import appended, double, integer, labelled

#: Bounds of the sample that trains the dictionaries and the calibration: labelled rows of each label,
#: those of the smallest hash, and bytes of a text (longer labelled texts are not learned from).
MAX_TOXIC, MAX_ORDINARY, MAX_TEXT = 1200, 2400, 1 << 16
#: Lengths of the segments that the toxic part of the dictionary is made of.
SEGMENTS = (5, 7, 9)
#: A segment must cover this share of the toxic sample, and be this many times as common in it.
LEAST_SHARE, LEAST_RATIO = 0.01, 20.0
#: How many segments of a toxic text the dictionary should hold.
COVERS = 4
BODY = 16384
WINDOW, OVERLAP = 64, 16
#: Savings, in bytes, from which a window counts.
SAVINGS = (2, 3, 4)


@dataclass(frozen=True)
class Model:
    toxic: bytes
    ordinary: bytes
    weights: tuple[float, ...]


def folded(text: str | None) -> bytes:
    return b" " + b" ".join((text or "").lower().encode().split()) + b" "


def segments_of(words: set[bytes]) -> set[bytes]:
    out = set()
    for w in words:
        w = b" " + w + b" "
        for n in SEGMENTS:
            out.update([w[i:i + n] for i in range(len(w) - n + 1)])
    return out


def toxic_part(toxic: list[bytes], ordinary: list[bytes]) -> bytes:
    """Segments that together cover the toxic texts, chosen one by one by how many texts still lack them."""
    held = Counter()
    for t in toxic:
        held.update(segments_of(set(t.split())))
    least = max(2, LEAST_SHARE * len(toxic))
    likely = {s for s, n in held.items() if n >= least}
    against = Counter()
    for t in ordinary:
        against.update(segments_of(set(t.split())) & likely)
    good = {s for s in likely
            if held[s] / len(toxic) >= LEAST_RATIO * (against[s] + 0.5) / (len(ordinary) + 1)}
    where = defaultdict(list)
    for i, t in enumerate(toxic):
        for s in segments_of(set(t.split())) & good:
            where[s].append(i)
    where = {s: np.array(v) for s, v in where.items()}
    lacking, chosen = np.full(len(toxic), COVERS), []
    while where:
        best = max(where, key=lambda s: ((lacking[where[s]] > 0).sum() - 4 * against[s] * len(toxic) / (len(ordinary) + 1), s))
        if (lacking[where[best]] > 0).sum() < least:
            break
        lacking[where[best]] -= 1
        chosen.append(best)
        where = {s: v for s, v in where.items() if s not in best and s[1:] not in best and s[:-1] not in best}
    # whole words around the chosen segments, the commonest first in reach
    words = Counter(w for t in toxic for w in set(t.split()))
    parts = []
    for s in reversed(chosen):
        around = [(n, w) for w, n in words.items() if s.strip() in w and s in b" " + w + b" "]
        parts.append(b" " + max(around)[1] + b" ")
    return b"".join(parts)


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    params = zstandard.ZstdCompressionParameters(
        window_log=17, chain_log=14, hash_log=14, search_log=4, min_match=4, strategy=zstandard.STRATEGY_LAZY,
        write_content_size=False, write_checksum=False, write_dict_id=False)
    book = zstandard.ZstdCompressionDict(content or b" " * 8, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(compression_params=params, dict_data=book)


def savings(text: bytes, toxic, ordinary) -> np.ndarray:
    """Bytes that the toxic dictionary saves over the ordinary one, window by window."""
    parts = [text[i:i + WINDOW + OVERLAP] for i in range(0, max(1, len(text) - OVERLAP), WINDOW)]
    return np.array([len(ordinary.compress(p)) - len(toxic.compress(p)) for p in parts])


def features(saved: np.ndarray) -> list[float]:
    n = len(saved)
    top = np.sort(saved)[-2:]
    counts = [float((saved >= s).sum()) for s in SAVINGS]
    return [*[c / n for c in counts], *[np.log1p(c) for c in counts], top[-1], top[0], np.log(n), saved.mean()]


def train(toxic: list[str], ordinary: list[str]) -> Model:
    """Dictionaries from two lists of texts, and weights of the window counts by logistic regression.

    Copies count once.  Without toxic or without ordinary texts every score is 0.
    """
    bad, good = sorted({folded(t) for t in toxic}), sorted({folded(t) for t in ordinary})
    if not bad or not good:
        return Model(b"", b"", ())
    # half of the ordinary texts make the dictionaries, so that the calibration sees the rest as new
    words = Counter(w for t in good[::2] for w in set(t.split()))
    common = [w for w, _ in sorted(words.items(), key=lambda x: (-x[1], x[0]))]
    special = toxic_part(bad, good)
    body = b" ".join(reversed(common[:BODY // 4]))[-BODY:]
    plain = b" ".join(reversed(common[BODY // 4:BODY // 2]))[-len(special) - 1:] if special else b""
    model = Model(special + body, plain.rjust(len(special)) + body, ())
    compressors = _compressor(model.toxic), _compressor(model.ordinary)
    x = np.array([features(savings(t, *compressors)) for t in [*bad, *good]])
    y = np.array([1.0] * len(bad) + [0.0] * len(good))
    middle, scale = x.mean(0), x.std(0) + 1e-9
    z = np.hstack([(x - middle) / scale, np.ones((len(x), 1))])
    w = np.zeros(z.shape[1])
    for _ in range(25):  # Newton steps
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = (z * (p * (1 - p))[:, None]).T @ z + np.diag([1.0] * (len(w) - 1) + [1e-6])
        w += np.linalg.solve(h, z.T @ (y - p) - np.append(w[:-1], 0))
    raw = w[:-1] / scale
    return Model(model.toxic, model.ordinary, (*raw, w[-1] - float(raw @ middle)))


def held_out(doc_id):
    """The fifth of the rows that no model of this file learns from."""
    return F.crc32(doc_id.cast("string")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Train on a bounded sample of the labelled rows (doc_id, toxic) that are not held out."""
    sample = labelled(docs, labels, "toxic", held_out, {1: MAX_TOXIC, 0: MAX_ORDINARY}, MAX_TEXT, id_col, text_col)
    rows = [(r["text"], r["label"]) for r in sample.collect()]
    return train([t for t, y in rows if y == 1], [t for t, y in rows if y == 0])


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        self.compressors = _compressor(model.toxic), _compressor(model.ordinary)
        self.weights = np.array(model.weights)

    def __call__(self, text: str | None) -> float:
        if not self.model.weights:
            return 0.0
        x = np.array(features(savings(folded(text), *self.compressors)))
        return float(1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -30, 30))))


def _start(model: Model, threshold: float):
    score = Scorer(model)

    def work(texts):
        scores = [score(t) for t in texts]
        return [scores, [int(s >= threshold) for s in scores]]

    return work


def _start_filter(model: Model, threshold: float):
    score = Scorer(model)
    return lambda texts: [[score(t) < threshold for t in texts]]


def scored(docs: DataFrame, model: Model, threshold: float = 0.5, text_col: str = "text",
           keep: list[str] | None = None) -> DataFrame:
    """``score`` and ``predicted`` of every whole text, with the ``keep`` columns (all by default).

    A null text counts as empty; the empty text gets the score of a window without savings.  Equal texts
    get equal scores.  A kept column named like a result is replaced.
    """
    return appended(docs, [text_col], docs.columns if keep is None else keep,
                    [double("score"), integer("predicted")], partial(_start, model, threshold))


def accepted(docs: DataFrame, model: Model, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, whose text is not predicted to be toxic."""
    return appended(docs, [text_col], docs.columns, [], partial(_start_filter, model, threshold), filtered=True)
