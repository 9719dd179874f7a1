"""Near duplicates by SimHash and BK-trees.

Distinct fingerprints meet in shards of those that share two of their four 16-bit blocks: two differing
bits leave two blocks equal, so no link is lost.  A shard's task grows one BK-tree (children keyed by
the Hamming distance to their parent) and follows, for each fingerprint, only the edges within the
radius.  The trees travel to their queries by the shuffle that makes the shards, not by a broadcast,
which would have no bound.  A shard with many fingerprints is dealt out again by two of the four bytes
that are left, so that none can hold more than 65,536.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import appended, checkpointed, column, long
from tidelog.llm.components import components
from tidelog.llm.wordtable import fresh

SHINGLE = 3
RADIUS = 2
SEED = 42
#: Shards with more fingerprints are dealt out again.
SHARD_ROWS = 1024
BLOCK = 1 << 16


def fingerprint(text: str) -> int:
    """Bit i is 1 if it is set in over half of the XXH64 values of the shingles."""
    words = text.encode().lower().split()  # bytes: A to Z, and the six ASCII spaces
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    spans = zip(starts, ends[SHINGLE - 1:].tolist()) if len(words) >= SHINGLE else [(0, len(joined))]
    hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans], np.uint64)
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), BLOCK):  # bounded memory for very long texts
        part = hashes[i:i + BLOCK]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(bits.view(np.int64)[0])


class BKTree:
    """Fingerprints, each below its parent under their Hamming distance."""

    def __init__(self):
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        at = 0
        if self.values:
            while True:
                d = (value ^ self.values[at]).bit_count()
                if d not in self.children[at]:
                    self.children[at][d] = len(self.values)
                    break
                at = self.children[at][d]
        self.values.append(value)
        self.children.append({})

    def within(self, value: int, radius: int) -> list[int]:
        """Indices of the fingerprints at the radius or less."""
        found, todo = [], [0] if self.values else []
        while todo:
            at = todo.pop()
            d = (value ^ self.values[at]).bit_count()
            if d <= radius:
                found.append(at)
            for edge, child in self.children[at].items():
                if d - radius <= edge <= d + radius:
                    todo.append(child)
        return found


def spanning(values: list[int], radius: int) -> list[tuple[int, int]]:
    """Links that connect what is linked in a shard, at most one per fingerprint."""
    tree, root = BKTree(), list(range(len(values)))

    def top(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, v in enumerate(values):
        for j in tree.within(v, radius):
            a, b = top(i), top(j)
            root[max(a, b)] = min(a, b)
        tree.add(v)
    return [(values[i], values[top(i)]) for i in range(len(values)) if top(i) != i]


def _shard_links(batches):
    """Links of every shard in a run of rows sorted by shard; a shard is held at a time."""
    current, held = None, []

    def links():
        pairs = spanning([v & (2 ** 64 - 1) for v in dict.fromkeys(held)], RADIUS)
        if pairs:
            flat = np.array(pairs, np.uint64).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], names=["a", "b"])

    for batch in batches:
        for shard, part, fp in zip(*[batch.column(i).to_pylist() for i in range(3)]):
            if (shard, part) != current:
                yield from links()
                current, held = (shard, part), []
            held.append(fp)
    yield from links()


def _keys(value, width: int, tag: int = 0):
    """For each pair of the four ``width``-bit blocks of ``value``, the pair and its contents as one long."""
    mask = (1 << width) - 1
    blocks = [F.shiftrightunsigned(value, width * i).bitwiseAND(F.lit(mask)) for i in range(4)]
    return F.array(*[
        F.lit((tag + i) << (2 * width)).cast("long").bitwiseOR(F.shiftleft(blocks[p], width)).bitwiseOR(blocks[q])
        for i, (p, q) in enumerate(combinations(range(4), 2))])


def _rest(fp, shard):
    """The 32 bits of a fingerprint that its shard does not fix."""
    blocks = [F.shiftrightunsigned(fp, 16 * i).bitwiseAND(F.lit(0xFFFF)) for i in range(4)]
    which = F.shiftright(shard, 32)
    out = F.lit(0).cast("long")
    for i, pair in enumerate(combinations(range(4), 2)):
        p, q = [k for k in range(4) if k not in pair]
        out = F.when(which == i, F.shiftleft(blocks[p], 16).bitwiseOR(blocks[q])).otherwise(out)
    return out


def links(distinct: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Links (a, b) that connect the distinct fingerprints ``fp`` at a distance of RADIUS or less."""
    dealt = checkpointed(distinct.select("fp", F.explode(_keys(F.col("fp"), 16)).alias("shard")))
    sizes = dealt.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # cut off, so that the join may split a shard with many rows
    dealt = dealt.join(checkpointed(sizes), "shard")
    parts = F.when(F.col("n") > shard_rows, _keys(_rest(F.col("fp"), F.col("shard")), 8)) \
        .otherwise(F.array(F.lit(-1).cast("long")))
    spread = dealt.select("shard", F.explode(parts).alias("part"), "fp")
    return (spread.repartition("shard", "part").sortWithinPartitions("shard", "part", "fp")
            .mapInArrow(_shard_links, "a long, b long"))


def _start():
    return lambda texts: [[fingerprint(t or "") for t in texts]]


def clustered(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash, fp, component_id and root (a fingerprint of the component) of every row.

    Rows whose fingerprints differ in at most RADIUS bits are linked; the component is the smallest id
    that links reach.  Texts without a word, and null texts, have fingerprint 0, which links like any
    other.  A null id never becomes a component unless its component has no other; rows that repeat keep
    a row each.
    """
    text = F.coalesce(column(text_col), F.lit(""))
    narrow = docs.select(column(id_col).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    prints = checkpointed(appended(narrow, ["text"], ["doc_id", "text_hash"], [long("fp")], _start))
    least = checkpointed(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = checkpointed(components(links(least)))
    linked = least.join(roots.select(F.col("node").alias("fp"), "root"), "fp")
    smallest = linked.groupBy("root").agg(F.min("least").alias("smallest"))
    moved = linked.join(checkpointed(smallest), "root").select("fp", "root", "smallest")
    known = checkpointed(least.join(moved, "fp", "left").select(
        "fp", F.coalesce("smallest", "least").alias("component_id"), F.coalesce("root", "fp").alias("root")))
    return prints.join(known, "fp").select("doc_id", "text_hash", "fp", "component_id", "root")


def hexadecimal(fp):
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row, with all its columns, of each component: that of the smallest id.

    Of rows that share id and component, the one with the smallest text hash stays; of equal rows, any.
    Rows with a null id stay only if their component has no other.
    """
    marked = clustered(docs, id_col, text_col)
    own = marked.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    id_name, wanted, hashed = fresh(docs, "__id", "__wanted", "__text_hash")
    chosen = own.groupBy("root").agg(F.min(F.struct("doc_id", "text_hash")).alias("s"))
    chosen = checkpointed(chosen.select(F.col("s.doc_id").alias(id_name), F.col("s.text_hash").alias(wanted)).distinct())
    rows = docs.withColumn(hashed, F.xxhash64(F.coalesce(column(text_col), F.lit(""))))
    same = column(id_col).eqNullSafe(F.col(id_name)) & (F.col(hashed) == F.col(wanted))
    return rows.join(chosen, same, "left_semi").dropDuplicates([id_col, hashed]).select(*[column(c) for c in docs.columns])
