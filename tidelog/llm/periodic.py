"""Periodic runs of words: stretches in which a phrase comes four times or more in a row.

A word of such a run occurs in it at least once per period.  So words that a segment holds too rarely
belong to no run inside it and split it; the parts are counted again, down to segments that no word
splits.  Only these are scanned: for equal words at short lags, all segments at once, and for long lags
where a block of words comes again.
"""

from __future__ import annotations

import zlib
from collections import Counter
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.common import column
from tidelog.llm.wordtable import Words, in_slices, joined, mixed, others, words_of

#: Words and periods a run has at least.
LEAST, POWER = 6, 4
#: Lags up to here are compared word by word; longer ones where a block of words comes again.
SHORT = 31
#: Rounds in numpy before segments that still split go on one by one.
ROUNDS = 12
#: Comparisons of blocks made at a time.
AT_ONCE = 1 << 20

RUN = T.StructType([T.StructField(c, T.LongType(), False) for c in ("start", "length", "period")])
RUNS = T.ArrayType(RUN, False)
_ARROW_RUNS = pa.list_(pa.struct([pa.field(c, pa.int64(), False) for c in ("start", "length", "period")]))


def stable_segments(codes: np.ndarray, texts: np.ndarray, least: int, power: int) -> list[tuple[int, int]]:
    """The segments in which every word occurs ``power`` times or more, shorter ones than ``least`` left out."""
    found: list[tuple[int, int]] = []
    at, segment = np.arange(len(codes)), texts.astype(np.int64)
    for _ in range(ROUNDS):
        if not len(at):
            return found
        _, inverse, counts = np.unique(segment * (int(codes.max()) + 1) + codes[at], return_inverse=True, return_counts=True)
        often = counts[inverse] >= power
        first = np.append(True, segment[1:] != segment[:-1])
        begins = np.flatnonzero(first)
        whole = np.logical_and.reduceat(often, begins)
        sizes = np.diff(np.append(begins, len(at)))
        found += [(int(a), int(a + n)) for a, n in zip(at[begins[whole & (sizes >= least)]], sizes[whole & (sizes >= least)])]
        going = often & ~np.repeat(whole, sizes)
        at, old = at[going], segment[going]
        parted = np.append(True, (np.diff(at) != 1) | (np.diff(old) != 0))[:len(at)]
        segment = np.cumsum(parted)
        long_enough = np.bincount(segment)[segment] >= least if len(segment) else np.zeros(0, bool)
        at, segment = at[long_enough], segment[long_enough]
    for part in np.split(at, np.flatnonzero(np.diff(segment)) + 1) if len(at) else []:
        start = int(part[0])
        found += [(start + a, start + b) for a, b in settled(codes[part].tolist(), least, power)]
    return found


def settled(words: list[int], least: int, power: int) -> list[tuple[int, int]]:
    """The same for one segment.  A rare word is looked for from both ends and only the smaller part is
    counted anew, so that n words cost n log n steps however they split."""
    found, open_parts = [], [(0, len(words), Counter(words))]
    while open_parts:
        low, high, counts = open_parts.pop()
        if high - low < least:
            continue
        cut = next((k for i in range((high - low + 1) // 2) for k in (low + i, high - 1 - i)
                    if counts[words[k]] < power), None)
        if cut is None:
            found.append((low, high))
            continue
        left, right = (low, cut), (cut + 1, high)
        small, large = (left, right) if cut - low < high - cut else (right, left)
        few = Counter(words[slice(*small)])
        counts.subtract(few)
        counts[words[cut]] -= 1
        open_parts += [(*small, few), (*large, counts)]
    return found


class _Found:
    """Runs of the scanned words, and how far the runs that begin at or before a place reach."""

    def __init__(self, size: int):
        self.rows: list[np.ndarray] = []
        self.reach = np.zeros(size, np.int64)

    def add(self, starts: np.ndarray, ends: np.ndarray, period: int) -> None:
        # a run inside one of a smaller period has that period
        own = self.reach[starts] < ends
        starts, ends = starts[own], ends[own]
        if len(starts):
            self.rows.append(np.column_stack([starts, ends - starts, np.full(len(starts), period)]))
            np.maximum.at(self.reach, starts, ends)
            self.reach = np.maximum.accumulate(self.reach)


def runs_in(codes: np.ndarray, segments: list[tuple[int, int]], least: int, power: int) -> np.ndarray:
    """Rows of start, length and period of all runs inside the segments, in no order."""
    if not segments:
        return np.zeros((0, 3), np.int64)
    spans = np.array(sorted(segments), np.int64)
    sizes = spans[:, 1] - spans[:, 0]
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(ends[-1]) + np.repeat(spans[:, 0] - (ends - sizes), sizes)
    words, longest = codes[place], int(sizes.max())
    found = _Found(len(words))
    for lag in range(1, min(SHORT, longest // power) + 1):
        same = np.zeros(len(words) - lag + 2, bool)
        same[1:-1] = (words[lag:] == words[:-lag]) & (owner[lag:] == owner[:-lag])
        begins, stops = np.flatnonzero(np.diff(same)).reshape(-1, 2).T
        enough = stops - begins >= max(least, power * lag) - lag
        found.add(begins[enough], stops[enough] + lag, lag)
    _long_lags(words, ends - sizes, ends, longest, least, power, found)
    rows = np.concatenate(found.rows) if found.rows else np.zeros((0, 3), np.int64)
    rows[:, 0] = place[rows[:, 0]]
    return rows


def _long_lags(words, begins, ends, longest: int, least: int, power: int, found: _Found) -> None:
    """Runs of periods over SHORT, by levels of periods from ``block`` to twice that.

    A run of four periods p >= block holds a block that starts at a multiple of ``block`` within its
    first period and comes again p and 2p words on.  Each such block is compared with the
    next ``block`` places only, and what agrees is followed word by word to both sides.
    """
    block, hashes = 1, mixed(words)
    while block <= SHORT or power * block <= longest:
        if block > SHORT:
            _one_level(words, hashes, begins, ends, block, least, power, found)
        if len(hashes) <= block:
            break
        hashes = hashes[:-block] * np.uint64(0x5851F42D4C957F2D) + mixed(hashes[block:])
        block *= 2


def _one_level(words, hashes, begins, ends, block: int, least: int, power: int, found: _Found) -> None:
    big = np.flatnonzero(ends - begins >= power * block)
    counts = (ends[big] - begins[big]) // block
    first = np.repeat(begins[big], counts)
    number = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    anchors, stops = first + number * block, np.repeat(ends[big], counts)
    lows = np.repeat(begins[big], counts)
    lags = np.arange(block, 2 * block)
    runs: dict[int, tuple[int, int]] = {}
    made: list[tuple[int, int, int]] = []
    rows = max(1, AT_ONCE // block)
    for i in range(0, len(anchors), rows):
        at, stop, low = anchors[i:i + rows, None], stops[i:i + rows, None], lows[i:i + rows]
        fits = at + 2 * lags + block <= stop
        twice = np.minimum(at + 2 * lags, len(hashes) - 1)
        same = fits & (hashes[at] == hashes[np.minimum(at + lags, len(hashes) - 1)]) & (hashes[at] == hashes[twice])
        which, lag = np.nonzero(same)
        lag += block
        at, stop, low = at[which, 0], stop[which, 0], low[which]
        more = np.minimum(at + block, len(hashes) - 1)
        own = (hashes[more] == hashes[np.minimum(more + lag, len(hashes) - 1)]) & (found.reach[at] < at + 2 * lag + block)
        for a, p, lo, hi in zip(at[own].tolist(), lag[own].tolist(), low[own].tolist(), stop[own].tolist()):
            if runs.get(p, (0, 0))[1] >= a + 2 * p + block:
                continue  # a later block of the run found last at this lag
            start, end = _followed(words, a, p, lo, hi)
            runs[p] = (start, end)
            if end - start >= max(least, power * p):
                made.append((start, end, p))
    for start, end, p in sorted(set(made)):
        found.add(np.array([start]), np.array([end]), p)


def _followed(words: np.ndarray, at: int, lag: int, low: int, high: int) -> tuple[int, int]:
    """The longest stretch of period ``lag`` around ``at`` between ``low`` and ``high``."""
    end, step = at, 256
    while end + lag < high:
        n = min(step, high - lag - end)
        differs = np.flatnonzero(words[end:end + n] != words[end + lag:end + lag + n])
        if len(differs):
            end += int(differs[0])
            break
        end, step = end + n, step * 2
    start, step = at, 256
    while start > low:
        n = min(step, start - low)
        differs = np.flatnonzero(words[start - n:start] != words[start - n + lag:start + lag])
        if len(differs):
            start += int(differs[-1]) + 1 - n
            break
        start, step = start - n, step * 2
    return start, end + lag


def detected(words: Words, least: int = LEAST, power: int = POWER) -> tuple[np.ndarray, np.ndarray]:
    """All runs (text, start, length, period; by text, start, period), and which words come before or in
    the first period of every run that holds them."""
    texts = words.texts
    rows = runs_in(words.codes, stable_segments(words.codes, texts, least, power), least, power)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 0]))]
    edge = np.zeros(len(words.codes) + 1, np.int64)
    np.add.at(edge, rows[:, 0] + rows[:, 2], 1)
    np.add.at(edge, rows[:, 0] + rows[:, 1], -1)
    owner = texts[rows[:, 0]] if len(rows) else np.zeros(0, np.int64)
    own = np.column_stack([owner, rows[:, 0] - words.bounds[owner], rows[:, 1], rows[:, 2]])
    return own, np.cumsum(edge)[:-1] == 0


def with_planted_runs(words: Words, ids: list) -> Words:
    """The words of texts in which every tenth id, by its checksum, repeats a stretch to the end.

    For h the checksum of the decimal id and g = h div 10, the words of a text with h mod 10 = 0 repeat,
    from word a = g mod n on, their first 1 + (n - a) div (3 + g mod 8).  A null id plants nothing.
    """
    codes = words.codes.copy()
    for i, (key, n) in enumerate(zip(ids, words.counts.tolist())):
        g, rest = divmod(zlib.crc32(str(key).encode()), 10)
        if key is None or rest or not n:
            continue
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        begin = int(words.bounds[i]) + a
        codes[begin:begin + n - a] = words.codes[begin + np.arange(n - a) % p]
    return Words(codes, words.spellings, words.bounds)


def _work(kept: list[int], planted: bool, least: int, power: int, names: list[str], part: pa.RecordBatch) -> pa.RecordBatch:
    words = words_of(part.column(0))
    if planted:
        words = with_planted_runs(words, part.column(1).to_pylist())
    rows, stay = detected(words, least, power)
    lists = pa.ListArray.from_arrays(
        pa.array(np.searchsorted(rows[:, 0], np.arange(len(words.bounds))), pa.int32()),
        pa.StructArray.from_arrays([pa.array(rows[:, k]) for k in (1, 2, 3)], fields=list(_ARROW_RUNS.value_type)))
    collapsed = joined(words, np.flatnonzero(stay)).cast(pa.large_string()).cast(pa.string())
    return pa.RecordBatch.from_arrays(
        [part.column(i) for i in kept] + [pa.array(words.counts.astype(np.int64)), lists, collapsed],
        names=names)


def runs(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", keep: list[str] | None = None, *,
         least: int = LEAST, power: int = POWER, planted: bool = False) -> DataFrame:
    """Per row: ``n_words``, the periodic ``runs`` of its whole text, and the ``collapsed`` text.

    A run is a stretch of consecutive words with smallest period q, at least ``least`` words and
    ``power`` (4 or more) times q long, that no neighbouring word extends with that period; runs come by
    start, then period.  The collapsed text has, joined by one space, all words but those that lie in a
    run behind its first q words.

    A null text has no words, no runs and an empty collapsed text, like an empty one.  A text of any
    length is one slice and takes some 150 bytes of memory a word.  Equal rows give equal rows, no rows
    give none.  ``keep`` names the columns that come along (all by default); one named like a result, in
    any case, is replaced.  ``planted`` first repeats stretches of some texts (``with_planted_runs``), for
    which the id counts; otherwise ``id_col`` is not read.
    """
    if power < 4:
        raise ValueError("a run has four periods at least")
    results = [T.StructField("n_words", T.LongType()), T.StructField("runs", RUNS), T.StructField("collapsed", T.StringType())]
    keep = [c for c in others(docs, [f.name for f in results]) if keep is None or c in keep]
    used = [text_col, *([id_col] if planted else [])]
    inputs = docs.select(*[column(c).alias(f"__in{i}") for i, c in enumerate(used)], *[column(c) for c in keep])
    fields = inputs.schema.fields[len(used):]
    names = [f.name for f in [*fields, *results]]
    at = list(range(len(used), len(inputs.columns)))
    return in_slices(inputs, 0, T.StructType([*fields, *results]), partial(_work, at, planted, least, power, names))


def digests(docs: DataFrame, planted: bool = True) -> DataFrame:
    """Per document: the number of runs, the one with most periods, and digests of all runs and of the
    collapsed text."""
    found = runs(docs, keep=["doc_id"], planted=planted)
    best = "aggregate(runs, get(runs, 0), (b, r) -> CASE WHEN r.length * b.period > b.length * r.period THEN r ELSE b END)"
    lines = "array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')"
    return found.withColumn("best", F.expr(best)).selectExpr(
        "doc_id", "cast(size(runs) AS BIGINT) AS n_runs", "best.start AS start", "best.length AS length",
        "best.period AS period", "(1000 * best.length) div best.period AS exponent_milli",
        f"sha2({lines}, 256) AS runs_sha256", "sha2(collapsed, 256) AS collapsed_sha256")
