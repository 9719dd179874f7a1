"""Benchmark decontamination by latent semantic retrieval.

Benchmark items are cut into passages, whose TF-IDF rows a randomised SVD projects to a latent space.  A
space is made for every part of no more passages than it has dimensions, so that no passage loses in it
however many items there are, and all parts are searched in one pass.  Windows of all documents are
searched against the passages by cosine, and for each passage's rarest run of words, which an exact copy
holds whatever stands around it; what comes near is checked word by word: the longest common subsequence
with the whole item, and whether its answer is there.

Weights come from counts over all documents.  A window's cosine with a passage adds up what its words
give, and each word has a most that it gives to any of a group of passages: windows whose words cannot
reach the threshold together need no projection.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.common import column, slices

#: Words of a passage, and of the step from one to the next.
STEP = 16
WINDOW = 2 * STEP
#: Hashed counters of words over all documents.
COUNTERS = 1 << 16
#: Latent dimensions, so the most passages of a part, and the extra ones of the random range finder.
RANK, EXTRA = 192, 16
#: Groups of a part's passages that bound a window's cosine, and windows that are projected at a time.
GROUPS, AT_ONCE = 16, 256
#: Items, and passages, whose index is searched in one pass over the documents; more take more passes.
BLOCK_ITEMS, BLOCK_PASSAGES = 2000, 4096
#: Words of a run that makes a candidate; shorter items are found by their cosine alone.
RUN = 5
_RUN_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63,
                         0x27D4EB2F165667C5], np.uint64)
#: Least cosine of a candidate; shares of an item in the common subsequence that tell a leak, alone or
#: with this share of the weight of its answer.
COSINE, LCS, LCS_WITH_ANSWER, ANSWER = 0.40, 0.80, 0.50, 0.60
#: Without an answer column, this last part of an item's words is taken for its answer.
ANSWER_PART = 3
EDGES = b"\x09\x0a\x0b\x0c\x0d !\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True


def tokenized(texts: list[str]) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Word numbers of all texts in a row, the words they stand for, and where each text begins.

    Words are parted by the six ASCII spaces, lower-cased, and stripped of ASCII marks at their edges;
    numbers of words that are equal after that differ only if their spelling did.
    """
    parts = [t.lower().encode() + b" " for t in texts]
    data = np.frombuffer(b"".join(parts), np.uint8)
    begins = np.cumsum([0, *map(len, parts)])
    space = _SPACE[data]
    first = ~space
    first[1:] &= space[:-1]
    starts = np.flatnonzero(first)
    offsets = np.append(starts, len(data)).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    coded = words.dictionary_encode()
    return (coded.indices.to_numpy(), [w.strip(EDGES) or w.strip() for w in coded.dictionary.to_pylist()],
            np.searchsorted(starts, begins))


def word_key(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(COUNTERS, np.int64)
    for batch in batches:
        for part in slices(batch, 0):
            codes, words, _ = tokenized([t or "" for t in part.column(0).to_pylist()])
            slots = np.array([word_key(w) % COUNTERS for w in words], np.int64)
            counts += np.bincount(slots, np.bincount(codes, minlength=len(words)), COUNTERS).astype(np.int64)
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["slot", "n"])


def word_weights(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Inverse frequency of the words of each counter, over all documents."""
    rows = (docs.select(column(text_col).alias("text")).mapInArrow(_count_words, "slot long, n long")
            .groupBy("slot").agg(F.sum("n").alias("n")).collect())  # COUNTERS rows at most
    counts = np.zeros(COUNTERS)
    counts[[r["slot"] for r in rows]] = [r["n"] for r in rows]
    return np.log(1 + counts.sum() / (1 + counts)).astype(np.float32)


def passages_of(n: int) -> list[tuple[int, int]]:
    """Spans of the passages of a text of n words; the last one may be shorter."""
    return [(a, min(a + WINDOW, n)) for a in range(0, max(1, n - STEP), STEP)] if n else []


def _passage_rows(weights: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        items, terms, values = [], [], []
        for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            codes, words, _ = tokenized([text or ""])
            keys = np.array([word_key(w) for w in words], np.uint64)[codes] if len(codes) else np.zeros(0, np.uint64)
            for a, b in passages_of(len(codes)):
                own = np.unique(keys[a:b])
                w = weights[(own % np.uint64(COUNTERS)).astype(np.int64)].astype(float)
                items.append(item)
                terms.append(own.view(np.int64).tolist())
                values.append((w / np.linalg.norm(w)).tolist())
        yield pa.RecordBatch.from_arrays(
            [pa.array(items, pa.int64()), pa.array(terms, pa.list_(pa.int64())), pa.array(values, pa.list_(pa.float64()))],
            names=["item", "terms", "values"])


def _random_row(term: int, width: int) -> np.ndarray:
    return np.random.default_rng(term & (2 ** 64 - 1)).standard_normal(width)


def randomized_svd(matrix: np.ndarray, terms: list[int], rank: int = RANK) -> np.ndarray:
    """Right singular vectors of a part's passages, as a latent row for every term.

    The range finder's random rows are decided by the terms themselves.
    """
    z = matrix.T @ (matrix @ np.array([_random_row(t, rank + EXTRA) for t in terms]))
    size, turn = np.linalg.eigh(z.T @ z)
    keep = size > size[-1] * 1e-10
    q = z @ (turn[:, keep] / np.sqrt(size[keep]))
    b = matrix @ q
    _, turn = np.linalg.eigh(b.T @ b)
    return (q @ turn[:, ::-1][:, :rank]).astype(np.float32)


def _latent_rows(rank: int, part: pa.Table) -> pa.Table:
    """The latent rows of a part's terms."""
    lists, values = part.column("terms").to_pylist(), part.column("values").to_pylist()
    terms = sorted({t for own in lists for t in own})
    at = {t: i for i, t in enumerate(terms)}
    matrix = np.zeros((len(lists), len(terms)))
    for i, (own, w) in enumerate(zip(lists, values)):
        matrix[i, [at[t] for t in own]] = w
    rows = randomized_svd(matrix, terms, rank)
    return pa.table({"part": pa.array([part.column("part")[0].as_py()] * len(terms), pa.int32()),
                     "term": pa.array(terms, pa.int64()), "v": pa.array(list(rows), pa.list_(pa.float32()))})


@dataclass(frozen=True)
class Part:
    """Latent rows of the words, and of at most RANK passages, with the items of these.

    ``rows`` gives the latent row of a word's number in the index, -1 without one.  ``latent`` rows carry
    their word's weight.
    """

    rows: np.ndarray
    latent: np.ndarray
    passages: np.ndarray
    item_of: np.ndarray


@dataclass(frozen=True)
class Index:
    """Parts of the benchmark's passages, and what the word checks need of its items.

    ``reach`` is the most that a word adds to the product with any passage of each group, GROUPS a part.
    ``runs`` has the places in ``items`` of each run of words that makes a candidate, by its hash.
    """

    weights: np.ndarray
    terms: dict[int, int]
    reach: np.ndarray
    parts: list[Part]
    runs: dict[int, list[int]]
    run_starts: frozenset[int]
    items: list[tuple[int, list[int], list[int]]]


def run_hashes(keys: np.ndarray) -> np.ndarray:
    """A hash of the RUN words that begin at every word but the last ones."""
    n = len(keys) - RUN + 1
    out = np.zeros(max(0, n), np.uint64)
    if n > 0:
        for j, factor in enumerate(_RUN_FACTORS):
            out += keys[j:j + n] * factor
    return out


def rarest_runs(keys: np.ndarray, weights: np.ndarray) -> dict[int, int]:
    """Hash and first word of the heaviest run of every passage of an item."""
    w = weights[(keys % np.uint64(COUNTERS)).astype(np.int64)].astype(float)
    hashes = run_hashes(keys)
    weight = np.convolve(w, np.ones(RUN), "valid") if len(hashes) else w[:0]
    out = {}
    for a, b in passages_of(len(keys)):
        if b - a >= RUN:
            best = a + int(weight[a:b - RUN + 1].argmax())
            out[int(hashes[best])] = int(keys[best])
    return out


def build(benchmark: DataFrame, weights: np.ndarray, rank: int = RANK, id_col: str = "item_id",
          text_col: str = "text", answer_col: str | None = None) -> list[Index]:
    """Index one block of items (about BLOCK_ITEMS), so that each index may be sent to every task.

    The passages of a block of long items make several indexes; an item is in one of them.  Items are
    known by their place in the block, so ids may be null or repeat.
    """
    items = []
    answers = column(answer_col) if answer_col else F.lit(None).cast("string")
    rows = benchmark.select(column(id_col).cast("long"), column(text_col), answers).collect()
    numbered = benchmark.sparkSession.createDataFrame([(i, r[1]) for i, r in enumerate(rows)], "item long, text string")
    passages = numbered.mapInArrow(partial(_passage_rows, weights), "item long, terms array<long>, values array<double>")
    for item, text, answer in rows:
        codes, words, _ = tokenized([text or ""])
        keys = [word_key(words[c]) for c in codes]
        codes, words, _ = tokenized([answer or ""])
        tail = [word_key(words[c]) for c in codes] or keys[-max(1, len(keys) // ANSWER_PART):]
        items.append((item, keys, tail))
    found = sorted(((r["item"], r["terms"], r["values"]) for r in passages.collect()), key=lambda p: p[0])
    groups, start = [], 0
    for i in range(1, len(found) + 1):
        if i == len(found) or found[i][0] != found[i - 1][0]:  # behind the last passage of an item
            if groups and i - groups[-1][0] <= BLOCK_PASSAGES:
                groups[-1] = (groups[-1][0], i)
            else:
                groups.append((start, i))
            start = i
    return [_index(benchmark.sparkSession, found[a:b], items, weights, rank) for a, b in groups]


def _index(spark, found: list[tuple[int, list[int], list[float]]], items, weights: np.ndarray, rank: int) -> Index:
    of = [i for i, *_ in found]
    held = sorted(set(of))
    renumbered = {i: k for k, i in enumerate(held)}
    rows = pa.table({"part": pa.array([k // rank for k in range(len(found))], pa.int32()),
                     "terms": pa.array([t for _, t, _ in found], pa.list_(pa.int64())),
                     "values": pa.array([v for *_, v in found], pa.list_(pa.float64()))})
    made = (spark.createDataFrame(rows).groupBy("part")
            .applyInArrow(lambda part: _latent_rows(rank, part), "part int, term long, v array<float>").toArrow())
    part_of = made.column("part").to_numpy()
    keys = made.column("term").to_numpy().view(np.uint64)
    distinct, number = np.unique(keys, return_inverse=True)
    vectors = made.column("v").combine_chunks()
    widths = np.diff(vectors.offsets.to_numpy())
    begins, flat = vectors.offsets.to_numpy(), vectors.values.to_numpy()
    weight = weights[(distinct % np.uint64(COUNTERS)).astype(np.int64)]
    at = {int(k): i for i, k in enumerate(distinct)}
    parts, reach = [], []
    for k in range(-(-len(found) // rank)):
        own = np.flatnonzero(part_of == k)
        width = widths[own[0]]
        latent = np.array([flat[begins[i]:begins[i] + width] for i in own], np.float32)
        to = np.full(len(distinct), -1, np.int32)
        to[number[own]] = np.arange(len(own))
        mine = found[k * rank:(k + 1) * rank]
        projected = np.array([np.array(v, np.float32) @ latent[to[[at[t & (2 ** 64 - 1)] for t in terms]]]
                              for _, terms, v in mine])
        projected /= np.maximum(np.linalg.norm(projected, axis=1, keepdims=True), 1e-9)
        latent *= weight[number[own]][:, None]
        given = latent @ projected.T
        most = np.zeros((len(distinct), GROUPS), np.float32)
        most[number[own]] = np.column_stack([given[:, p].max(axis=1, initial=0)
                                             for p in np.array_split(np.arange(len(mine)), GROUPS)])
        reach.append(most)
        parts.append(Part(to, latent, projected.astype(np.float32), np.array([renumbered[i] for i, *_ in mine], np.int64)))
    runs: dict[int, list[int]] = {}
    starts = set()
    for i in held:
        for run, first in rarest_runs(np.array(items[i][1], np.uint64), weights).items():
            runs.setdefault(run, []).append(renumbered[i])
            starts.add(first)
    return Index(weights, at, np.hstack(reach), parts, runs, frozenset(starts), [items[i] for i in held])


def lcs_length(masks: dict[int, int], length: int, words: list[int]) -> int:
    """Longest common subsequence with a pattern given as the bits of the places of each word."""
    full = (1 << length) - 1
    row = full
    for w in words:
        hit = row & masks.get(w, 0)
        row = ((row + hit) | (row - hit)) & full
    return length - row.bit_count()


def _occurrence_before(codes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Place of the last equal word of the same text, -1 without one."""
    order = np.argsort(doc * np.int64(codes.max() + 1) + codes, kind="stable")
    before = np.full(len(codes), -1)
    same = (codes[order][1:] == codes[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    before[order[1:][same]] = order[:-1][same]
    return before


#: What rounding may take from a bound.
SLACK = 1 - 1e-4


def _summed(rows: np.ndarray, which: np.ndarray, group: np.ndarray, n: int) -> np.ndarray:
    """Sums of table rows by group; groups come in order."""
    out = np.zeros((n, rows.shape[1]), np.float32)
    if len(which):
        cut = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        out[group[cut]] = np.add.reduceat(rows[which], cut, axis=0)
    return out


class Searcher:
    def __init__(self, index: Index):
        self.index = index
        self.masks = []
        for _, keys, _ in index.items:
            masks: dict[int, int] = {}
            for i, k in enumerate(keys):
                masks[k] = masks.get(k, 0) | (1 << i)
            self.masks.append(masks)
        self.weight_of = lambda k: float(index.weights[k % COUNTERS])

    def candidates(self, texts: list[str]):
        """(text, start, end, item) of every window near a passage and every rare run, and the words' keys."""
        index = self.index
        codes, words, begins = tokenized(texts)
        key_list = [word_key(w) for w in words]
        # words that became equal by stripping get one number, so that they count once in a window
        number: dict[int, int] = {}
        to = np.array([number.setdefault(k, len(number)) for k in key_list], np.int64)
        keys = np.array(list(number), np.uint64)
        codes = to[codes] if len(codes) else np.zeros(0, np.int64)
        if not len(codes) or not index.parts:
            return keys, codes, begins, []
        squares = index.weights[(keys % np.uint64(COUNTERS)).astype(np.int64)].astype(np.float64) ** 2
        known = np.array([index.terms.get(int(k), -1) for k in keys], np.int64)
        sizes = np.diff(begins)
        doc = np.repeat(np.arange(len(texts)), sizes)
        place = np.arange(len(codes)) - begins[:-1][doc]
        blocks = np.maximum(1, -(-sizes // STEP)) * (sizes > 0)
        first_block = np.append(0, np.cumsum(blocks))
        block = first_block[:-1][doc] + place // STEP
        start = begins[:-1][doc] + place // STEP * STEP  # of the word's own block
        before = _occurrence_before(codes, doc)
        new_here = before < start  # first in its block, so in a window that begins with it
        new_after = before < np.maximum(start - STEP, begins[:-1][doc])  # first in the window begun one block before
        n = first_block[-1]
        square, inside = squares[codes], known[codes] >= 0
        gives = np.where(known >= 0, np.append(index.reach.max(axis=1, initial=0), 0)[known], 0)[codes]

        def per_window(flags_here, flags_after, values):
            here = np.bincount(block[flags_here], values[flags_here], n)
            after = np.bincount(block[flags_after], values[flags_after], n)
            last = np.zeros(n, bool)
            last[first_block[1:][blocks > 0] - 1] = True
            return here + np.where(last, 0, np.append(after[1:], 0))

        whole = per_window(new_here, new_after, square)
        most = per_window(new_here & inside, new_after & inside, gives)
        near = np.flatnonzero(most >= COSINE * np.sqrt(whole) * SLACK)
        block_doc = np.repeat(np.arange(len(texts)), blocks)
        out = self.runs(keys, codes, doc)
        for at in range(0, len(near), AT_ONCE):
            chunk = near[at:at + AT_ONCE]
            lo = begins[:-1][block_doc[chunk]] + (chunk - first_block[:-1][block_doc[chunk]]) * STEP
            hi = np.minimum(lo + WINDOW, begins[1:][block_doc[chunk]])
            least = COSINE * np.sqrt(whole[chunk])
            # the words of each window, in a row, that the index knows and that are new in it
            row = np.repeat(np.arange(len(chunk)), hi - lo)
            word = np.arange(len(row)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + np.repeat(lo, hi - lo)
            use = inside[word] & (before[word] < lo[row])
            row, term = row[use], known[codes[word[use]]]
            may = _summed(index.reach, term, row, len(chunk)) >= least[:, None] * SLACK
            may = may.reshape(len(chunk), -1, GROUPS).any(axis=2)
            for k in np.flatnonzero(may.any(axis=0)):
                part = index.parts[k]
                local = part.rows[term]
                use = may[row, k] & (local >= 0)
                x = _summed(part.latent, local[use], row[use], len(chunk))
                product = x @ part.passages.T
                for w, p in zip(*np.nonzero(product >= least[:, None])):
                    out.append((int(block_doc[chunk[w]]), int(lo[w]), int(hi[w]), int(part.item_of[p])))
        return keys, codes, begins, out

    def runs(self, keys: np.ndarray, codes: np.ndarray, doc: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(text, start, end, item) of every rare run of an item."""
        index = self.index
        begins = np.array([int(k) in index.run_starts for k in keys], bool)[codes]
        at = np.flatnonzero(begins[:max(0, len(codes) - RUN + 1)])
        at = at[doc[at] == doc[at + RUN - 1]]
        hashes = np.zeros(len(at), np.uint64)
        for j, factor in enumerate(_RUN_FACTORS):
            hashes += keys[codes[at + j]] * factor
        return [(int(doc[w]), int(w), int(w) + RUN, i) for w, h in zip(at, hashes.tolist()) for i in index.runs.get(h, ())]

    def leaks(self, texts: list[str]) -> list[dict[int, tuple[float, float]]]:
        """Per text: items that it holds, with their shares of common subsequence and answer."""
        keys, codes, begins, found = self.candidates(texts)
        out: list[dict[int, tuple[float, float]]] = [{} for _ in texts]
        for d, lo, hi, i in sorted(set(found)):
            item, own, answer = self.index.items[i]
            if out[d].get(item, (0, 0))[0] == 1.0:
                continue
            a, b = max(int(begins[d]), lo - len(own)), min(int(begins[d + 1]), hi + len(own))
            words = keys[codes[a:b]].tolist()
            share = lcs_length(self.masks[i], len(own), words) / len(own)
            if share < LCS_WITH_ANSWER:
                continue
            there = set(words)
            weights = [(self.weight_of(k), k in there) for k in set(answer)]
            held = sum(w for w, ok in weights if ok) / sum(w for w, _ in weights)
            if share >= LCS or held >= ANSWER:
                out[d][item] = max(out[d].get(item, (0.0, 0.0)), (share, held))
        return out


def _leak_rows(index: Index, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    search = Searcher(index)
    for batch in batches:
        for part in slices(batch, 1):
            found = search.leaks([t or "" for t in part.column(1).to_pylist()])
            rows = [(d, i, *s) for d, own in zip(part.column(0).to_pylist(), found)
                    for i, s in sorted(own.items(), key=lambda x: (x[0] is None, x[0] or 0))]
            ids, items, shares, answers = zip(*rows) if rows else ([], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, part.column(0).type), pa.array(items, pa.int64()), pa.array(shares, pa.float64()),
                 pa.array(answers, pa.float64())], names=["doc_id", "item_id", "lcs_share", "answer_share"])


def _clean_rows(index: Index, at: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    search = Searcher(index)
    for batch in batches:
        for part in slices(batch, at):
            found = search.leaks([t or "" for t in part.column(at).to_pylist()])
            yield part.filter(pa.array([not own for own in found], pa.bool_()))


def indexes(docs: DataFrame, benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text",
            answer_col: str | None = None) -> list[Index]:
    """The index of every block of items; items without a word, and null texts, match nothing.

    Items may have no id, or share one: each is searched for.  Equal items are one.  An empty table gives no
    index.
    """
    weights = word_weights(docs, text_col)
    wanted = [column(item_col), column(text_col), *([column(answer_col)] if answer_col else [])]
    items = benchmark.where(column(text_col).isNotNull()).select(*wanted).distinct()
    count = math.ceil(items.count() / BLOCK_ITEMS)
    blocks = [items.where(F.pmod(F.xxhash64(*wanted), F.lit(count)) == k) for k in range(count)]
    return [i for b in blocks for i in build(b, weights, id_col=item_col, text_col=text_col, answer_col=answer_col)]


def leaked(docs: DataFrame, found: list[Index], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, item_id, lcs_share and answer_share of every benchmark item in every whole text.

    Documents without a leak have no row; null and empty texts have none.  A repeated row gives its rows
    again.  Without items the result is empty.  Items that share an id give one row a document, that of the
    larger shares; those without one give a row with a null item_id.  Texts of any length are searched whole.
    Other columns are not read.
    """
    narrow = docs.select(column(id_col).alias("doc_id"), column(text_col).alias("text"))
    schema = T.StructType([narrow.schema["doc_id"], T.StructField("item_id", T.LongType()),
                           T.StructField("lcs_share", T.DoubleType()), T.StructField("answer_share", T.DoubleType())])
    out = None
    for index in found:
        part = narrow.mapInArrow(partial(_leak_rows, index), schema)
        out = part if out is None else out.unionAll(part)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def clean(docs: DataFrame, found: list[Index], text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, whose text holds no item of the benchmark, whatever the item's id.

    Null and empty texts hold none and stay; equal rows stay or go together; texts of any length are
    searched whole; without items all rows stay.
    """
    for index in found:
        docs = docs.mapInArrow(partial(_clean_rows, index, docs.columns.index(text_col)), docs.schema)
    return docs
