"""Passages that an earlier document holds too, found by windows of words that double in length.

Level 1 looks at windows of half the length.  Of those inside any full window the one of the smallest
hash stands for it (equal windows choose alike), so that about every fourth word starts one.  Level 2
extends only those that two documents share to about twice their length: to the span of all full windows
that they stand for.  A span that a smaller id has too goes as a whole.  Level 3 looks at the full windows
themselves, only where a repeated half window has no span to decide it.  Nothing else survives.

Every slice of text decides first what its own rows can decide: of a half window that several of its
documents share it sends one row, so a passage in a third of all documents is as many rows as there are
slices.  What is decided travels under keys of its own.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.common import column
from tidelog.llm.wordtable import Words, in_slices, joined, mixed, others, words_of
from tidelog.session import scratch_folder

#: Words of a window.
LENGTH = 13
_FACTORS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
#: What is known of a row: nothing, that others of its key are open, that it is open, that it is repeated.
FREE, OTHERS_OPEN, OPEN, REPEATED = 0, 1, 2, 3


class _Hashed:
    """Two 64-bit hashes of any stretch of words, from sums of the words' hashes times powers."""

    def __init__(self, words: Words):
        pairs = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words.spellings.to_pylist())), "<u8").reshape(-1, 2)
        n = len(words.codes)
        self.word = [pairs[words.codes, i] if n else np.zeros(0, np.uint64) for i in (0, 1)]
        self.sums, self.back = [], []
        for factor, word in zip(_FACTORS, self.word):
            powers = np.cumprod(np.append(np.uint64(1), np.full(n, factor, np.uint64)))
            self.sums.append(np.append(np.uint64(0), np.cumsum(word * powers[:-1])))
            inverse = pow(factor, -1, 1 << 64)
            self.back.append(np.cumprod(np.append(np.uint64(1), np.full(n, inverse, np.uint64))))

    def of(self, begin: np.ndarray, end: np.ndarray, which: int) -> np.ndarray:
        value = (self.sums[which][end] - self.sums[which][begin]) * self.back[which][begin]
        return mixed(value ^ (end - begin).astype(np.uint64))


def halves(words: Words, hashed: _Hashed, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each half window that stands for full ones: its hash and text, and the first and last full window."""
    half = (length + 1) // 2
    n = len(words.codes) - length + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none
    texts = words.texts
    starts = np.arange(len(words.codes) - half + 1)
    keys = hashed.of(starts, starts + half, 0)
    best, at = keys[:n].copy(), np.arange(n)
    for j in range(1, length - half + 1):
        other = keys[j:n + j]
        less = other < best
        best[less] = other[less]
        at[less] = np.flatnonzero(less) + j
    inside = np.flatnonzero(texts[:n] == texts[length - 1:])
    at = at[inside]
    first = np.append(True, (at[1:] != at[:-1]) | (texts[inside[1:]] != texts[inside[:-1]]))[:len(at)]
    begins = np.flatnonzero(first)
    last = inside[np.append(begins[1:], len(at)) - 1] if len(at) else inside
    return keys[at[begins]], texts[inside[begins]], inside[begins], last


def _group_starts(*sorted_values: np.ndarray) -> np.ndarray:
    changes = np.zeros(len(sorted_values[0]), bool)
    changes[:1] = True
    for v in sorted_values:
        changes[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(changes)


def _spread(values: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    return np.repeat(values, np.diff(np.append(starts, n)))


def _once(part: pa.RecordBatch) -> pa.RecordBatch:
    """Without further rows of one id and text, which would only repeat what the first one says."""
    rank = pc.rank(part.column(1), "ascending", tiebreaker="dense").to_numpy()
    first = np.unique(np.column_stack([rank.astype(np.int64), part.column(2).to_numpy()]), axis=0, return_index=True)[1]
    return part.take(pa.array(np.sort(first)))


def _rank(part: pa.RecordBatch) -> np.ndarray:
    """Order of the ids of a slice, equal ids alike."""
    return pc.rank(part.column(1), "ascending", tiebreaker="dense").to_numpy().astype(np.int64)


def _own_key(part: pa.RecordBatch, text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A key that a decided row has for itself."""
    return mixed(part.column(2).to_numpy().view(np.uint64)[text] ^ mixed(at))


def _first_level(length: int, part: pa.RecordBatch) -> pa.RecordBatch:
    part = _once(part)
    words = words_of(part.column(0))
    hashed = _Hashed(words)
    key, text, low, high = halves(words, hashed, length)
    span = hashed.of(low, high + length, 1)
    rank = _rank(part)[text]
    order = np.lexsort((rank, span, key))
    key, text, low, high, span, rank = (v[order] for v in (key, text, low, high, span, rank))
    state = np.full(len(key), FREE, np.int32)
    if len(key):
        by_key, by_span = _group_starts(key), _group_starts(key, span)
        least = _spread(np.minimum.reduceat(rank, by_key), by_key, len(key))
        shared = _spread(np.maximum.reduceat(rank, by_key), by_key, len(key)) > least
        repeated = rank > _spread(rank[by_span], by_span, len(key))
        # one row of the smallest id speaks for the key in this slice
        mine = np.flatnonzero(rank == least)
        speaker = np.zeros(len(key), bool)
        speaker[mine[_group_starts(key[mine])]] = True
        state[shared & repeated] = REPEATED
        state[shared & ~repeated & ~speaker] = OPEN
        is_open = _spread(np.maximum.reduceat(state == OPEN, by_key), by_key, len(key))
        state[speaker & is_open] = OTHERS_OPEN
    begin = words.bounds[text]
    at = (low - begin) * length + (high - low)
    key = np.where(state >= OPEN, _own_key(part, text, at), key)
    rows = pa.array(text)
    return pa.RecordBatch.from_arrays(
        [pa.array(key.view(np.int64)), pa.array(span.view(np.int64)), part.column(1).take(rows),
         part.column(2).take(rows), pa.array(at), pa.array(state)], names=["key", "span", "id", "tid", "at", "state"])


def _windows(length: int, part: pa.RecordBatch) -> pa.RecordBatch:
    part = _once(part)
    words = words_of(part.column(0))
    hashed = _Hashed(words)
    marks = part.column(3)
    text = np.repeat(np.arange(part.num_rows), np.diff(marks.offsets.to_numpy()))
    mark = marks.flatten().to_numpy()
    text, mark = text[mark % 2 == 0], mark[mark % 2 == 0] // 2
    low, count = mark // length, mark % length + 1
    text = np.repeat(text, count)
    at = np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    begin = words.bounds[text] + at
    one, two = (hashed.of(begin, begin + length, i) for i in (0, 1))
    rank = _rank(part)[text]
    order = np.lexsort((rank, two, one))
    one, two, text, at, rank = (v[order] for v in (one, two, text, at, rank))
    state = np.full(len(one), FREE, np.int32)
    if len(one):
        groups = _group_starts(one, two)
        state[rank > _spread(rank[groups], groups, len(one))] = REPEATED
    one = np.where(state == REPEATED, _own_key(part, text, at), one)
    rows = pa.array(text)
    return pa.RecordBatch.from_arrays(
        [pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), part.column(1).take(rows),
         part.column(2).take(rows), pa.array(at), pa.array(state)], names=["key", "span", "id", "tid", "at", "state"])


def _rows(kind: T.DataType) -> T.StructType:
    long = T.LongType()
    return T.StructType([T.StructField(n, t) for n, t in (
        ("key", long), ("span", long), ("id", kind), ("tid", long), ("at", long), ("state", T.IntegerType()))])


def shared_halves(docs: DataFrame, length: int) -> DataFrame:
    """Levels 1 and 2: per document (id, tid) its ``marks``, twice the place of a half window's full windows,
    and one more if they are all repeated.  Other marks are open."""
    rows = in_slices(docs.select("text", "id", "tid"), 0, _rows(docs.schema["id"].dataType), partial(_first_level, length))
    free = F.col("state") < OPEN
    same_span, same_key = Window.partitionBy("key", "span"), Window.partitionBy("key")
    id_if_free = F.when(free, F.col("id"))
    seen = (rows.repartition("key")
            .withColumn("span_first", F.min(id_if_free).over(same_span))
            .withColumn("key_first", F.min(id_if_free).over(same_key))
            .withColumn("repeated", (F.col("state") == REPEATED) | (free & (F.col("id") > F.col("span_first"))))
            .withColumn("unsure", (F.col("state") == OTHERS_OPEN)
                        | (free & ~F.col("repeated") & (F.col("id") > F.col("key_first"))))
            .withColumn("any_unsure", F.max("unsure").over(same_key)))
    open_ones = (F.col("state") == OPEN) | (free & F.col("any_unsure"))
    return (seen.where(F.col("repeated") | open_ones)
            .select("id", "tid", (F.col("at") * 2 + F.col("repeated").cast("int")).alias("mark"))
            .groupBy("id", "tid").agg(F.collect_set("mark").alias("marks")))


def repeated_windows(docs: DataFrame, marks: DataFrame, length: int) -> DataFrame:
    """Level 3: per document (id, tid) the starts of the open windows that a smaller id has too."""
    some = marks.where(F.exists("marks", lambda m: m % 2 == 0))
    candidates = docs.join(some, ["id", "tid"]).select("text", "id", "tid", "marks")
    rows = in_slices(candidates, 0, _rows(docs.schema["id"].dataType), partial(_windows, length))
    free = F.col("state") == FREE
    first = F.min(F.when(free, F.col("id"))).over(Window.partitionBy("key", "span"))
    return (rows.repartition("key").withColumn("first", first)
            .where(~free | (F.col("id") > F.col("first")))
            .groupBy("id", "tid").agg(F.collect_set("at").alias("starts")))


def _kept(length: int, kept: list[int], names: list[str], part: pa.RecordBatch) -> pa.RecordBatch:
    words = words_of(part.column(0))

    def flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        return np.repeat(np.arange(len(sizes)), sizes), lists.flatten().to_numpy()

    edge = np.zeros(len(words.codes) + 1, np.int64)
    text, mark = flat(part.column(1))
    text, mark = text[mark % 2 == 1], mark[mark % 2 == 1] // 2
    begin = words.bounds[text] + mark // length
    np.add.at(edge, begin, 1)
    np.add.at(edge, begin + mark % length + length, -1)
    text, at = flat(part.column(2))
    begin = words.bounds[text] + at
    np.add.at(edge, begin, 1)
    np.add.at(edge, begin + length, -1)
    gone = np.cumsum(edge)[:-1] > 0
    removed = np.append(0, np.cumsum(gone))[words.bounds]
    left = joined(words, np.flatnonzero(~gone)).cast(pa.large_string()).cast(pa.string())
    return pa.RecordBatch.from_arrays(
        [*[part.column(i) for i in kept], pa.array(words.counts.astype(np.int64)), pa.array(np.diff(removed)), left],
        names=names)


def without_repeats(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", keep: list[str] | None = None, *,
                    length: int = LENGTH) -> DataFrame:
    """Every row with ``n_words``, ``n_removed`` and ``kept_text``: its words, joined by one space, without those
    covered by a window of ``length`` consecutive words that also starts in a row of a smaller id.

    Windows are judged on the input.  A null text has no words and gives an empty ``kept_text``; so does
    an empty one.  Rows with a null id are kept whole and make no other row lose anything.  Rows of one id
    don't count as repeats of each other; equal rows give equal results.  A text of any length is one slice
    and takes some 200 bytes of memory a word.  No rows give none.  ``keep`` names the columns that come
    along (all by default); one named like a result, in any case, is replaced.  Windows are compared by 128
    bits of hashes.  The marks of the first two levels are written once to the shared folder.
    """
    if length < 2:
        raise ValueError("a window has two words at least")
    results = [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
               T.StructField("kept_text", T.StringType())]
    keep = [c for c in others(docs, [f.name for f in results]) if keep is None or c in keep]
    spark = docs.sparkSession
    rest = [c for c in keep if c != id_col]
    places = {c: f"in{i}" for i, c in enumerate(rest)}
    rows = docs.select(column(id_col).alias("id"), F.xxhash64(column(id_col), column(text_col)).alias("tid"), column(text_col).alias("text"),
                       *[column(c).alias(p) for c, p in places.items()])
    known = rows.where(F.col("id").isNotNull())
    folder = scratch_folder(spark, "doubling")
    shared_halves(known, length).write.parquet(folder)
    marks = spark.read.parquet(folder)
    starts = repeated_windows(known.select("id", "tid", "text"), marks, length)
    found = known.join(marks, ["id", "tid"], "left").join(starts, ["id", "tid"], "left")
    no_list = F.lit(None).cast("array<bigint>")
    nameless = rows.where(F.col("id").isNull()).withColumns({"marks": no_list, "starts": no_list})
    every = found.unionByName(nameless).select("text", "marks", "starts", "id", *places.values())
    fields = [T.StructField(c, every.schema[places.get(c, "id")].dataType) for c in keep]
    at = [every.columns.index(places.get(c, "id")) for c in keep]
    names = [f.name for f in [*fields, *results]]
    return in_slices(every, 0, T.StructType([*fields, *results]), partial(_kept, length, at, names))


def oracle(length: int = LENGTH) -> str:
    """The same result for DuckDB: windows are texts of words joined by a space, which no word holds."""
    grams = " || ' ' || ".join(["w", *[f"lead(w, {k}) OVER o" for k in range(1, length)]])
    return rf"""
WITH split AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
words AS (SELECT r, doc_id, unnest(ws) AS w, unnest(range(len(ws))) AS p FROM split),
grams AS (SELECT r, doc_id, p, w, {grams} AS g FROM words WINDOW o AS (PARTITION BY r ORDER BY p)),
seen AS (SELECT r, p, w, g IS NOT NULL AND doc_id > min(doc_id) OVER (PARTITION BY g) AS repeated FROM grams),
covered AS (SELECT r, p, w, coalesce(bool_or(repeated) OVER (PARTITION BY r ORDER BY p
  ROWS BETWEEN {length - 1} PRECEDING AND CURRENT ROW), false) AS gone FROM seen),
sums AS (SELECT r, count(*) FILTER (gone) AS n_removed, string_agg(w, ' ' ORDER BY p) FILTER (NOT gone) AS kept
  FROM covered GROUP BY r)
SELECT doc_id, len(ws) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM split LEFT JOIN sums USING (r)"""
