"""Near copies: texts whose sets of word shingles are similar, found by SimHash fingerprints in BK-trees.

A SimHash of similar sets differs in some ten of its 64 bits, too many for shards of equal blocks.  So
shards are texts that share two of their six smallest shingle hashes, as texts of similarity 0.8 do but
for one pair in 600.  Each shard grows a BK-tree of its fingerprints and follows the edges within a wide
radius; what comes near is linked, nearest first, and every link is confirmed by the exact similarity of
the whole texts.  Equal texts are one node from the start.

That leaves out pairs: those of no common shard, beyond the radius or not the nearest.  So pairs of texts
that are not in one group yet are searched exactly: in one order of all shingles, rare ones first, similar
sets share one of their first ones, and counts of shingles by bucket refute most other pairs before texts
are compared.  First each text meets the one text of another group that looks nearest, and groups are joined
by what that links: only pairs that are of two groups even then are compared one and all, so a large group
of near copies is not taken pair by pair.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions.bounds import broadcast_if_small
from tidelog.llm.common import checkpointed, column, give_back, slices
from tidelog.llm.components import components
from tidelog.llm.wordtable import Words, fresh, in_slices, mixed, words_of

#: Words of a shingle, least similarity of a link, and smallest hashes that make shards.
SHINGLE, SIMILARITY, SMALLEST = 5, 0.8, 6
#: Differing bits that are followed; at similarity 0.8 they are 10 with a deviation of 3.
RADIUS = 17
#: Texts of a tree; a shard with more is cut into parts that have some PIVOTS texts in common.
TREE_ROWS, PIVOTS = 1 << 15, 256
#: Pairs that a tree compares at a time at most; bytes of texts that are compared at a time.
PAIRS, TEXT_BYTES = 1 << 18, 3 << 20
#: Rows of the sample that shows which shingles more than CELL_ROWS texts have, how many of them are dealt to
#: several cells, texts that meet in a cell, and counts in a text's sketch.
SAMPLE_ROWS, LAST, CELL_ROWS, BUCKETS = 1 << 13, 1 << 18, 1 << 12, 128
#: Counts of all shingles, by hash, that settle the order of all; counts that a row carries.
SLOTS, BLOCK = 1 << 22, 1 << 16
#: Rounds in which only the nearest ones are compared.
ROUNDS = 2
_FACTOR = np.uint64(0x5851F42D4C957F2D)
NODE = T.StructType([T.StructField(c, T.LongType(), False) for c in ("h1", "h2")])


class Tree:
    """A BK-tree in arrays: every value lies below its parent under their Hamming distance."""

    def __init__(self, values: np.ndarray):
        self.values, n = values, len(values)
        parent, edge = np.full(n, -1), np.zeros(n, np.int64)
        left, at = np.arange(1, n), np.zeros(max(0, n - 1), np.int64)
        while len(left):
            slot = at * 65 + np.bitwise_count(values[left] ^ values[at])
            slots, first, back = np.unique(slot, return_index=True, return_inverse=True)
            parent[left[first]], edge[left[first]] = slots // 65, slots % 65
            rest = np.ones(len(left), bool)
            rest[first] = False
            left, at = left[rest], left[first][back][rest]
        child = np.arange(1, n)
        keys = parent[1:] * 65 + edge[1:]
        order = np.argsort(keys, kind="stable")
        self.keys, self.children, self.compared = keys[order], child[order], 0

    def within(self, radius: int, queries: np.ndarray):
        """Pairs of a query (a place of ``values``) and an earlier value at the radius or less, with their
        distance, level by level."""
        query, node = queries, np.zeros(len(queries), np.int64)
        while len(query):
            self.compared += len(query)
            distance = np.bitwise_count(self.values[query] ^ self.values[node]).astype(np.int64)
            near = (distance <= radius) & (node < query)
            yield query[near], node[near], distance[near]
            low = np.searchsorted(self.keys, node * 65 + np.maximum(distance - radius, 0))
            high = np.searchsorted(self.keys, node * 65 + np.minimum(distance + radius, 64), side="right")
            count = high - low
            query = np.repeat(query, count)
            node = self.children[np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)]

def _blocks(start: int, n: int):
    """The places from ``start`` on, as many at a time as meet at most PAIRS of ``n`` values."""
    step = max(1, PAIRS // n)
    for i in range(start, n, step):
        yield np.arange(i, min(i + step, n))


def nearest_links(prints: np.ndarray, before: np.ndarray, radius: int) -> np.ndarray:
    """Pairs of places: each text with its nearest one within the radius.

    Texts of one ``before`` (not 0) meet in an earlier shard too, so those of the largest such group only
    serve as neighbours here.
    """
    kinds, which, sizes = np.unique(before, return_inverse=True, return_counts=True)
    sizes[kinds == 0] = 0
    most = int(np.argmax(sizes))
    there = (which == most) & (sizes[most] > 0)
    order = np.append(np.flatnonzero(there), np.flatnonzero(~there))
    tree, n = Tree(prints[order]), len(order)
    best = np.full(n, 65 * n)
    for block in _blocks(int(there.sum()), n):
        for query, node, distance in tree.within(radius, block):
            np.minimum.at(best, query, distance * n + node)
    linked = np.flatnonzero(best < 65 * n)
    return np.column_stack([order[linked], order[best[linked] % n]])


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Text and hash of every distinct shingle, by text and hash.

    A text of fewer words is one shingle, and one without a word has the shingle 0.
    """
    spelled = np.array([xxhash.xxh3_64_intdigest(w) for w in words.spellings.to_pylist()], np.uint64)
    codes = spelled[words.codes] if len(words.codes) else np.zeros(0, np.uint64)
    counts = words.counts
    per_text = np.where(counts == 0, 1, np.maximum(1, counts - size + 1))
    text = np.repeat(np.arange(len(counts), dtype=np.int32), per_text)
    offset = np.arange(per_text.sum()) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    start, length = words.bounds[text] + offset, np.minimum(counts[text], size)
    value = np.zeros(len(text), np.uint64)
    for k in range(size):
        inside = length > k
        value[inside] = value[inside] * _FACTOR + codes[start[inside] + k]
    value = np.where(length > 0, mixed(value ^ length.astype(np.uint64)), np.uint64(0))
    order = np.lexsort((value, text))
    text, value = text[order], value[order]
    new = np.append(True, (text[1:] != text[:-1]) | (value[1:] != value[:-1]))[:len(text)]
    return text[new], value[new]


def simhashes(text: np.ndarray, value: np.ndarray, texts: int) -> np.ndarray:
    """Bit i of a text's fingerprint is 1 if it is set in over half of its shingles."""
    begins, out = np.searchsorted(text, np.arange(texts)), np.zeros(texts, np.uint64)
    half = np.diff(np.append(begins, len(text)))
    for bit in range(64):
        ones = np.add.reduceat((value >> np.uint64(bit)) & np.uint64(1), begins).astype(np.int64)
        out |= (2 * ones > half).astype(np.uint64) << np.uint64(bit)
    return out


def _prints(size: int, smallest: int, part: pa.RecordBatch) -> pa.RecordBatch:
    text, value = shingles(words_of(part.column(0), lower=True), size)
    begins = np.searchsorted(text, np.arange(part.num_rows + 1))
    place = np.arange(len(text)) - begins[text]
    kept = place < smallest
    lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(text[kept], np.arange(part.num_rows + 1)), pa.int32()),
                                     pa.array(value[kept].view(np.int64)))
    prints = simhashes(text, value, part.num_rows) if part.num_rows else np.zeros(0, np.uint64)
    sketches = [row.tobytes() for row in _sketches(text, value, part.num_rows)]
    return pa.RecordBatch.from_arrays([part.column(1), part.column(2), pa.array(prints.view(np.int64)), lists,
                                       pa.array(np.diff(begins), pa.int32()), pa.array(sketches, pa.binary())],
                                      names=["id", "node", "fp", "smallest", "size", "sketch"])


def _sketches(text: np.ndarray, value: np.ndarray, texts: int) -> np.ndarray:
    """Shingles per text and bucket, 255 at most: two sets differ by as much as their sketches or more."""
    slot = text.astype(np.int64) * BUCKETS + (value >> np.uint64(20)).astype(np.int64) % BUCKETS
    return np.minimum(np.bincount(slot, minlength=texts * BUCKETS), 255).astype(np.uint8).reshape(texts, BUCKETS)


def _prefixes(size: int, least: float, levels: np.ndarray, crowded: np.ndarray, cells: np.ndarray,
              part: pa.RecordBatch) -> pa.RecordBatch:
    """Per text its number of shingles and, as (shingle, place, cells), the first ones in the order of all, of
    which similar texts share one: by the level of their slot, then by hash.  The hashes in ``crowded``
    (ascending) are dealt to ``cells``."""
    text, value = shingles(words_of(part.column(0), lower=True), size)
    signed = value.view(np.int64)
    order = np.lexsort((signed, levels[_slots(value)], text))
    sizes = np.bincount(text, minlength=part.num_rows)
    begins = np.append(0, np.cumsum(sizes))
    place = np.arange(len(text)) - begins[text]
    kept = place < (sizes - np.ceil(least * sizes - 1e-9).astype(np.int64) + 1)[text]
    chosen, of = signed[order[kept]], np.ones(int(kept.sum()), np.int64)
    if len(crowded):
        at = np.minimum(np.searchsorted(crowded, chosen), len(crowded) - 1)
        of = np.where(crowded[at] == chosen, cells[at], 1)
    first = pa.StructArray.from_arrays([pa.array(chosen), pa.array(place[kept], pa.int32()), pa.array(of, pa.int32())],
                                       names=["shingle", "place", "cells"])
    lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(text[kept], np.arange(part.num_rows + 1)), pa.int32()), first)
    return pa.RecordBatch.from_arrays([part.column(1), pa.array(sizes, pa.int32()), lists], names=["node", "size", "first"])


def _counted(size: int, part: pa.RecordBatch) -> pa.RecordBatch:
    value = shingles(words_of(part.column(0), lower=True), size)[1]
    value, n = np.unique(value, return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(n, pa.int64())], names=["shingle", "n"])


def _slots(value: np.ndarray) -> np.ndarray:
    return (value >> np.uint64(27)).astype(np.int64) % SLOTS


def _tallies(size: int, batches):
    """How many shingles of a task's texts fall into each slot, a row per block of slots."""
    counts = np.zeros(SLOTS, np.uint32)
    for batch in batches:
        for part in slices(batch, 0):
            np.add.at(counts, _slots(shingles(words_of(part.column(0), lower=True), size)[1]), 1)
    for block in range(0, SLOTS, BLOCK):
        own = counts[block:block + BLOCK]
        if own.any():
            own = own.astype(np.min_scalar_type(own.max()))
            packed = pa.compress(own.tobytes(), codec="zstd", asbytes=True)
            yield pa.RecordBatch.from_arrays([pa.array([block // BLOCK], pa.int32()), pa.array([own.itemsize], pa.int32()),
                                              pa.array([packed], pa.binary())], names=["block", "width", "packed"])
    give_back()


def _levels(batches):
    """Sums of all tasks for the blocks of one, as a byte per slot: eight levels from a number to twice as much."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, width, packed in zip(*(c.to_pylist() for c in batch.columns)):
            own = np.frombuffer(pa.decompress(packed, BLOCK * width, codec="zstd", asbytes=True), f"u{width}")
            sums.setdefault(block, np.zeros(BLOCK, np.int64))
            sums[block] += own
    for block, own in sums.items():
        level = np.minimum(np.round(8 * np.log2(1 + own)), 255).astype(np.uint8).tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([level], pa.binary())], names=["block", "level"])


def _by_cell(work, batches):
    """``work`` on whole cells in which different groups meet, from rows sorted by shingle and cell (the first two
    columns; the third is the group): on the columns and the numbers of the cells."""
    rest = None
    for batch in batches:
        rows = [_as_array(c) for c in batch.columns]
        rows = rows if rest is None else [np.concatenate(two) for two in zip(rest, rows)]
        new = np.flatnonzero((np.diff(rows[0]) != 0) | (np.diff(rows[1]) != 0)) + 1
        cut = new[-1] if len(new) else 0
        yield from _whole(work, [c[:cut] for c in rows])
        rest = [c[cut:] for c in rows]
    if rest is not None:
        yield from _whole(work, rest)
    del rest
    give_back()


def _as_array(column: pa.Array) -> np.ndarray:
    if not pa.types.is_binary(column.type):
        return column.to_numpy()
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, BUCKETS)


def _whole(work, rows: list[np.ndarray]):
    if not len(rows[0]):
        return
    new = np.append(True, (np.diff(rows[0]) != 0) | (np.diff(rows[1]) != 0))
    begins = np.flatnonzero(new)
    mixed_groups = np.minimum.reduceat(rows[2], begins) != np.maximum.reduceat(rows[2], begins)
    number = np.cumsum(new) - 1
    kept = mixed_groups[number]
    if kept.any():
        yield from work([c[kept] for c in rows], number[kept])


def _near_ones(least: float, rows: list[np.ndarray], number: np.ndarray):
    """Places of two texts of different groups that share a shingle among their first ones, but for those that
    cannot be similar if it is the first they share, or by their sketches where the rows have them; and how far
    their sketches are apart.  The rows of a cell are in the order of sizes."""
    _, cell, group, block, _, size, place, *more = rows
    size, n, one, distance = size.astype(np.int64), len(number), np.arange(len(number)), 0
    while len(one):
        distance += 1
        one = one[one + distance < n]
        # those that come behind one too large are larger still
        one = one[(number[one] == number[one + distance]) & (size[one] >= least * size[one + distance] - 1e-6)]
        two = one + distance
        within = np.minimum(size[one] - place[one], size[two] - place[two])
        # cells of two blocks pair these alone; each block has one cell of its own (negative)
        near = ((group[one] != group[two]) & ((cell[one] < 0) | (block[one] != block[two]))
                & (within >= least / (1 + least) * (size[one] + size[two]) - 1e-6))
        a, b = one[near], two[near]
        apart = np.zeros(len(a), np.int64)
        if more:
            apart = np.abs(more[1][a].astype(np.int16) - more[1][b]).sum(axis=1, dtype=np.int64)
            possible = apart <= (1 - least) / (1 + least) * (size[a] + size[b]) + 1e-6
            a, b, apart = a[possible], b[possible], apart[possible]
        if len(a):
            yield a, b, apart


def _partnered(least: float, rows: list[np.ndarray], number: np.ndarray):
    """The rows, but for their group, that may have a similar text in their cell."""
    found = np.zeros(len(number), bool)
    for a, b, _ in _near_ones(least, rows, number):
        found[a] = found[b] = True
    columns = [pa.array(c[found]) for c in rows[:8]]
    if len(rows) > 8:
        columns.append(pa.array([r.tobytes() for r in rows[8][found]], pa.binary()))
    names = ["shingle", "cell", "group", "block", "h1", "size", "place", "h2", "sketch"][:len(columns)]
    yield pa.RecordBatch.from_arrays(columns, names=names).select([n for n in names if n != "group"])


def _met(least: float, nearest: bool, rows: list[np.ndarray], number: np.ndarray):
    """Pairs of texts that may be similar.  With ``nearest`` a text is paired with that one alone whose sketch is
    nearest."""
    size, n, made, held = rows[5].astype(np.int64), len(number), [], 0
    best = np.full(n, n << 13)
    for a, b, apart in _near_ones(least, rows, number):
        if nearest:
            share = (apart << 12) // (size[a] + size[b])
            best[a] = np.minimum(best[a], share * n + b)
            best[b] = np.minimum(best[b], share * n + a)
            continue
        made.append(np.stack([a, b]))
        held += len(a)
        if held >= PAIRS:
            yield _pairs(np.concatenate(made, axis=1), rows[4], rows[7])
            made, held = [], 0
    if nearest:
        linked = np.flatnonzero(best < n << 13)
        made, held = [np.stack([linked, best[linked] % n])], len(linked)
    if held:
        yield _pairs(np.concatenate(made, axis=1), rows[4], rows[7])


def _pairs(at: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> pa.RecordBatch:
    """The distinct pairs of nodes at pairs of places."""
    ends = np.stack([h1[at], h2[at]])
    ends = np.where((ends[0, 0] > ends[0, 1]) | ((ends[0, 0] == ends[0, 1]) & (ends[1, 0] > ends[1, 1])), ends, ends[:, ::-1])
    found = np.unique(ends.reshape(4, -1), axis=1)
    return pa.RecordBatch.from_arrays([pa.array(c) for c in found], names=["a1", "b1", "a2", "b2"])


def _links(find, radius: int, batches):
    """Links of every shard in a run of rows sorted by shard; a shard is held at a time."""
    current, nodes, values = None, [], []

    def made():
        if sum(map(len, nodes)) < 2:
            return
        own = pa.concat_arrays(nodes)
        prints, marks = np.concatenate(values, axis=1)
        pairs = find(prints.view(np.uint64), marks, radius)
        if len(pairs):
            yield pa.RecordBatch.from_arrays([own.take(pa.array(pairs[:, i])) for i in (0, 1)], names=["a", "b"])

    for batch in batches:
        shard, part, fp, mark = (batch.column(i).to_numpy() for i in (0, 1, 3, 4))
        cuts = np.flatnonzero((np.diff(shard) != 0) | (np.diff(part) != 0)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(shard)]):
            if a == b:
                continue
            if current is not None and current != (shard[a], part[a]):
                yield from made()
                nodes, values = [], []
            current = (shard[a], part[a])
            nodes.append(batch.column(2).slice(a, b - a))
            values.append(np.stack([fp[a:b], mark[a:b]]))
    yield from made()
    nodes, values = [], []
    give_back()


def _similar(size: int, least: float, batches):
    for batch in batches:
        values = [shingles(words_of(batch.column(i), lower=True), size) for i in (0, 1)]
        rows = [np.column_stack([t.astype(np.uint64), v]) for t, v in values]
        n = batch.num_rows
        sizes = [np.bincount(t, minlength=n) for t, _ in values]
        both = np.concatenate(rows)
        both = both[np.lexsort((both[:, 1], both[:, 0]))]
        twice = (both[1:] == both[:-1]).all(axis=1)
        common = np.bincount(both[1:][twice][:, 0].astype(np.int64), minlength=n)
        yield batch.filter(pa.array(common >= least * (sizes[0] + sizes[1] - common))).select(["a", "b"])
    give_back()


def node_of(text):
    """Two hashes that stand for a text, nulls as empty texts."""
    text = F.coalesce(text, F.lit(""))
    return F.struct(F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2"))


def grouped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle: int = SHINGLE,
            similarity: float = SIMILARITY, radius: int = RADIUS, tree_rows: int = TREE_ROWS) -> DataFrame:
    """Per distinct text: its ``node``, the smallest id that has it (``least``), and the ``root`` of its group.

    Texts are linked if their sets of ``shingle``-word shingles (A-Z lower-cased) have a Jaccard similarity of
    ``similarity`` or more; groups are what links reach.  A text of fewer words is one shingle; texts without a
    word, and null texts, are equal to each other.  A null id is the least only of a text that has no other.
    Very long texts are compared whole.  No link between different texts is lost: what the trees do not find
    (fewer than two shared smallest hashes, over ``radius`` bits, not the nearest) is searched exactly.  A shard
    of more than ``tree_rows`` texts is cut into parts by hash, which some PIVOTS of its texts all have in common.
    """
    rows = docs.select(column(text_col).alias("text"), column(id_col).alias("id"), node_of(column(text_col)).alias("node"))
    kind = rows.schema["id"].dataType
    schema = T.StructType([T.StructField("id", kind), T.StructField("node", NODE), T.StructField("fp", T.LongType()),
                           T.StructField("smallest", T.ArrayType(T.LongType())), T.StructField("size", T.IntegerType()),
                           T.StructField("sketch", T.BinaryType())])
    prints = in_slices(rows, 0, schema, partial(_prints, shingle, SMALLEST))
    texts = checkpointed(prints.groupBy("node").agg(
        F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"),
        *[F.first(c).alias(c) for c in ("fp", "smallest", "size", "sketch")]))
    roots = components(_confirmed(rows, texts, _near(texts, radius, tree_rows), shingle, similarity))
    cells = _cells(rows, texts, roots, shingle, similarity)
    for nearest in [True] * ROUNDS + [False]:
        found = _confirmed(rows, texts, _meetings(cells, roots, similarity, nearest), shingle, similarity)
        if found.isEmpty():
            continue
        roots = components(found.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))))
    return texts.join(roots, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root"))


def _order(rows: DataFrame, shingle: int) -> np.ndarray:
    """The level of every slot, by all shingles of all rows: only the order in which shingles are searched."""
    tallies = rows.select("text").mapInArrow(partial(_tallies, shingle), "block INT, width INT, packed BINARY")
    summed = tallies.repartition("block").mapInArrow(_levels, "block INT, level BINARY").collect()  # a byte per slot in all
    levels = np.zeros(SLOTS, np.uint8)
    for r in summed:
        levels[r["block"] * BLOCK:(r["block"] + 1) * BLOCK] = np.frombuffer(r["level"], np.uint8)
    return levels


def _crowded(rows: DataFrame, n: int, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that by a sample of the ``n`` rows more than CELL_ROWS have, ascending, and into how many blocks
    their texts are dealt.  They only settle where shingles are searched."""
    every = max(1, n // SAMPLE_ROWS)
    sample = rows.where(F.pmod(F.xxhash64("id", "node"), F.lit(every)) == 0).limit(4 * SAMPLE_ROWS).select("text")
    counts = (in_slices(sample, 0, "shingle BIGINT, n BIGINT", partial(_counted, shingle)).groupBy("shingle")
              .agg(F.sum("n").alias("n")).where(f"n > 2 AND n * {every} >= {CELL_ROWS}")
              .orderBy(F.desc("n"), "shingle").limit(LAST))
    found = np.array(sorted((r["shingle"], r["n"]) for r in counts.collect()), np.int64).reshape(-1, 2)
    return found[:, 0], np.minimum(1 + found[:, 1] * every // CELL_ROWS, 1 << 7)


def _cells(rows: DataFrame, texts: DataFrame, roots: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """The first shingles of all texts, dealt to cells; only those with which a text of another group may be
    similar, so that what later rounds deal again is small."""
    n = texts.agg(F.sum("copies")).first()[0] or 0
    crowded, cells = _crowded(rows, n, shingle)
    schema = T.StructType([T.StructField("node", NODE), T.StructField("size", T.IntegerType()), T.StructField(
        "first", T.ArrayType(T.StructType([T.StructField("shingle", T.LongType()), T.StructField("place", T.IntegerType()),
                                           T.StructField("cells", T.IntegerType())])))])
    firsts = in_slices(rows.select("text", "node"), 0, schema,
                       partial(_prefixes, shingle, similarity, _order(rows, shingle), crowded, cells))
    own = roots.select("node", F.col("root.h1").alias("group"))
    dealt = firsts.join(broadcast_if_small(own), "node", "left").select(
        F.col("node.h1").alias("h1"), F.coalesce("group", "node.h1").alias("group"), "size", F.explode("first").alias("f"))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("h1"), F.col("f.cells")).cast("int"))
    # block i meets block j in the cell of both, and itself in a cell of its own
    of = F.transform(F.sequence(F.lit(0), F.col("f.cells") - 1), lambda j: F.when(j == F.col("block"), -1 - j).otherwise(
        F.least(j, "block") * F.col("f.cells") + F.greatest(j, "block")))
    dealt = dealt.select(F.col("f.shingle").alias("shingle"), F.explode(F.when(F.col("f.cells") == 1, F.array(F.lit(-1)))
                         .otherwise(of)).alias("cell"), "group", "block", "h1", "size", F.col("f.place").alias("place"))
    narrow = "shingle BIGINT, cell INT, block INT, h1 BIGINT, size INT, place INT"
    facts = texts.select(F.col("node.h1").alias("h1"), F.col("node.h2").alias("h2"), "sketch")
    rest = _by_cells(dealt, partial(_partnered, similarity), narrow).join(facts, "h1")
    return checkpointed(_by_cells(_grouped(rest, roots), partial(_partnered, similarity), narrow + ", h2 BIGINT, sketch BINARY"))


def _grouped(cells: DataFrame, roots: DataFrame) -> DataFrame:
    own = broadcast_if_small(roots.select(F.col("node.h1").alias("h1"), F.col("node.h2").alias("h2"), F.col("root.h1").alias("group")))
    return cells.join(own, ["h1", "h2"], "left").select("shingle", "cell", F.coalesce("group", "h1").alias("group"), "block",
                                                        "h1", "size", "place", "h2", "sketch")


def _by_cells(rows: DataFrame, work, schema: str) -> DataFrame:
    return (rows.repartition("shingle", "cell").sortWithinPartitions("shingle", "cell", "size", "h1")
            .mapInArrow(partial(_by_cell, work), schema))


def _meetings(cells: DataFrame, roots: DataFrame, similarity: float, nearest: bool) -> DataFrame:
    """Pairs of texts of different groups that may be similar: all of them, or each text's ``nearest`` in a cell."""
    met = _by_cells(_grouped(cells, roots), partial(_met, similarity, nearest), "a1 BIGINT, b1 BIGINT, a2 BIGINT, b2 BIGINT")
    return checkpointed(met.distinct().select(*[F.struct(F.col(f"{e}1").alias("h1"), F.col(f"{e}2").alias("h2")).alias(e) for e in "ab"]))


def _near(texts: DataFrame, radius: int, tree_rows: int) -> DataFrame:
    """Links of texts that share two of their smallest hashes and have near fingerprints."""
    at = F.transform(F.slice("smallest", 2, SMALLEST), lambda b: F.struct(
        F.xxhash64(F.col("smallest")[0], b).alias("shard"), F.lit(0).cast("long").alias("before")))
    later = F.flatten(F.transform(F.slice("smallest", 2, SMALLEST), lambda a, i: F.transform(
        F.slice("smallest", i + 3, SMALLEST), lambda b: F.struct(
            F.xxhash64(a, b).alias("shard"), F.col("smallest")[0].alias("before")))))
    alone = F.array(F.struct(F.xxhash64(F.col("smallest")[0]).alias("shard"), F.lit(0).cast("long").alias("before")))
    pairs = F.when(F.size("smallest") == 1, alone).otherwise(F.concat(at, later))
    dealt = texts.withColumn("p", F.explode(pairs)).select("node", "fp", F.col("p.shard").alias("shard"),
                                                              F.col("p.before").alias("mark"))
    # fewer than a tree_rows-th of all rows
    crowded = checkpointed(dealt.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > tree_rows))
    spread = dealt.join(F.broadcast(crowded), "shard", "left")
    of = F.coalesce(F.ceil(F.col("n") / tree_rows), F.lit(1)).cast("int")
    pivot = F.col("n").isNotNull() & (F.pmod(F.xxhash64("node.h2", "node.h1"), F.coalesce("n", F.lit(1))) < PIVOTS)
    parts = F.when(pivot, F.sequence(F.lit(0), of - 1)).otherwise(F.array(F.pmod(F.xxhash64("node.h1"), of).cast("int")))
    spread = spread.select("shard", F.explode(parts).alias("part"), "node", "fp", "mark")
    links = (spread.repartition("shard", "part").sortWithinPartitions("shard", "part", "node")
             .mapInArrow(partial(_links, nearest_links, radius), T.StructType([T.StructField("a", NODE), T.StructField("b", NODE)])))
    return checkpointed(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())


def _ends(links: DataFrame) -> DataFrame:
    return links.select(F.col("a").alias("node")).union(links.select("b")).distinct()


def _confirmed(rows: DataFrame, texts: DataFrame, links: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """The links whose whole texts are as similar as asked."""
    wanted = broadcast_if_small(checkpointed(texts.join(_ends(links), "node").select("node", "least")))
    # one row of each linked text: by its id too, so that its copies do not meet in one task
    found = (rows.join(wanted, (rows["node"] == wanted["node"]) & rows["id"].eqNullSafe(wanted["least"]))
             .select(rows["node"], "text").dropDuplicates(["node"]))
    pairs = (links.join(found.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
             .join(found.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b").select("text_a", "text_b", "a", "b"))
    return checkpointed(pairs.mapInArrow(_bounded(partial(_similar, shingle, similarity)), links.schema))


def _bounded(work):
    """``work`` on parts of batches with a bounded amount of both texts."""
    def parts(batch):
        if batch.num_rows < 2 or batch.nbytes <= TEXT_BYTES:
            yield batch
        else:
            half = batch.num_rows // 2
            yield from parts(batch.slice(0, half))
            yield from parts(batch.slice(half))

    return lambda batches: work(part for batch in batches for part in parts(batch))


def without_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """One row, with all its columns, of each group of near copies (see ``grouped``): that of the smallest id.

    Of rows that share this id within the group, one with the smallest node stays; of rows equal in id and
    text, any.  A row without an id stays only if its group has none with one.  No rows give none.
    """
    id_name, node = fresh(docs, "__id", "__node")
    groups = grouped(docs, id_col, text_col, **limits)
    chosen = groups.groupBy("root").agg(F.min(F.struct(F.col("least").isNull().alias("none"), "least", "node")).alias("s"))
    chosen = checkpointed(chosen.select(F.col("s.least").alias(id_name), F.col("s.node").alias(node)))
    marked = docs.withColumn(node, node_of(column(text_col)))
    same = column(id_col).eqNullSafe(chosen[id_name]) & (marked[node] == chosen[node])
    return marked.join(chosen, same, "left_semi").dropDuplicates([id_col, node]).select(*[column(c) for c in docs.columns])
