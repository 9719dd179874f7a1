"""Importance resampling towards a target text: hashed n-gram counts of both sides decide a document's weight.

Words come from the tokenizers library: an untrained regular-expression split over ASCII-lowered text
gives words with offsets.  Space parts words anyway, so each distinct chunk between spaces is split once
per slice of text and its words are put back by position.  Windows over the offset pairs are the
features; a feature's checksum picks its bucket.  One pass over the text leaves, per document, its
buckets and their counts, and per slice the sums; the weights are then sums of gains.
"""

from __future__ import annotations

import math
import zlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Regex, pre_tokenizers

from tidelog.functions.bounds import broadcast_if_small
from tidelog.llm.common import column
from tidelog.llm.wordtable import fresh, in_slices, others, words_of
from tidelog.session import scratch_folder

# What is no part of a word, the seed of the draw, the smoothing per bucket.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS, GRAMS, SEED = 10_000, 1, 2024
#: Words a document needs to be drawn, and the share of such documents that is drawn.
MIN_WORDS, PERCENT = 20, 10
#: Bytes of chunks that are split in one call.
AT_ONCE = 1 << 18
#: Neighbouring scores that are added up together first.
COARSE = 4096


def chunk_words(chunks: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """The words of all chunks in a row, and the chunk of each, by the offsets that the splitter gives."""
    splitter = pre_tokenizers.Split(Regex(WORD), behavior="removed", invert=True)
    words, owners, i = [], [], 0
    while i < len(chunks):
        j, size = i, 0
        while j < len(chunks) and (j == i or size + len(chunks[j]) < AT_ONCE):
            size += len(chunks[j]) + 1
            j += 1
        texts = [c.decode() for c in chunks[i:j]]
        begins = np.cumsum([0, *[len(t) + 1 for t in texts]])
        found = splitter.pre_tokenize_str("\n".join(texts))
        words += [w.encode() for w, _ in found]
        owners.append(i + np.searchsorted(begins, np.array([o[0] for _, o in found], np.int64), side="right") - 1)
        i = j
    return words, np.concatenate(owners) if owners else np.zeros(0, np.int64)


def features(texts: pa.Array, grams: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text the number of words, and of every feature (by text) the text and the bucket."""
    chunks = words_of(texts, lower=True)
    words, owners = chunk_words(chunks.spellings.to_pylist())
    n_chunks = len(chunks.spellings)
    per_chunk = np.bincount(owners, minlength=n_chunks) if n_chunks else np.zeros(0, np.int64)
    first = np.cumsum(per_chunk) - per_chunk
    sizes = per_chunk[chunks.codes]
    total = int(sizes.sum())
    # the word numbers of all texts in a row: each chunk's words one after the other
    at = np.repeat(first[chunks.codes] - (np.cumsum(sizes) - sizes), sizes) + np.arange(total)
    doc = np.repeat(chunks.texts, sizes)
    n_words = np.bincount(doc, minlength=len(texts)).astype(np.int64)
    checks = np.array([zlib.crc32(w) for w in words], np.int64)[at] if total else np.zeros(0, np.int64)
    docs, slots = [doc], [checks % buckets]
    for n in range(2, grams + 1):
        # a window of n words goes on from the checksum of the n - 1 before its last word
        inside = np.flatnonzero(doc[n - 1:] == doc[:max(0, total - n + 1)])
        checks = np.array([zlib.crc32(b" " + words[w], int(c)) for c, w in
                           zip(checks[inside], at[inside + n - 1])], np.int64)
        docs.append(doc[inside])
        slots.append(checks % buckets)
        full = np.zeros(total, np.int64)
        full[inside] = checks
        checks = full
    docs, slots = np.concatenate(docs), np.concatenate(slots)
    order = np.argsort(docs, kind="stable")
    return n_words, docs[order], slots[order]


def _counted(kept: list[int], grams: int, buckets: int, names: list[str], part: pa.RecordBatch) -> pa.RecordBatch:
    """Rows of documents with their buckets, and last a row with the sums of the slice."""
    n_words, docs, slots = features(part.column(0), grams, buckets)
    pairs, counts = np.unique(docs.astype(np.int64) * buckets + slots, return_counts=True)
    owner, slot = pairs // buckets, pairs % buckets
    sums = np.bincount(slots, minlength=buckets)
    present = np.flatnonzero(sums)
    ends = np.append(np.searchsorted(owner, np.arange(part.num_rows + 1)), len(owner) + len(present))

    def lists(own: np.ndarray, summed: np.ndarray, kind) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([own, summed]), kind))

    n_features = np.bincount(docs, minlength=part.num_rows)
    extra = [pa.concat_arrays([part.column(i), pa.nulls(1, part.column(i).type)]) for i in kept]
    return pa.RecordBatch.from_arrays(
        [*extra, pa.array([False] * part.num_rows + [True]), pa.array(np.append(n_words, 0)),
         pa.array(np.append(n_features, len(docs)).astype(np.int64)),
         lists(slot, present, pa.int32()), lists(counts, sums[present], pa.int64())], names=names)


def counted(docs: DataFrame, text_col: str, keep: list[str], grams: int, buckets: int, names: list[str]) -> DataFrame:
    """``keep`` of every row and, under ``names``: whether the row is a slice's sum, its words, its features, and
    its buckets with their counts."""
    fields = docs.select(*[column(c) for c in keep]).schema.fields
    made = [T.StructField(n, t) for n, t in zip(names, (
        T.BooleanType(), T.LongType(), T.LongType(), T.ArrayType(T.IntegerType()), T.ArrayType(T.LongType())))]
    rows = docs.select(column(text_col).alias("__in"), *[column(c) for c in keep])
    kept = list(range(1, len(keep) + 1))
    schema = T.StructType([*[T.StructField(f.name, f.dataType) for f in fields], *made])
    return in_slices(rows, 0, schema, partial(_counted, kept, grams, buckets, schema.names))


def totals(rows: DataFrame, names: list[str], buckets: int) -> np.ndarray:
    """The count of every bucket, from the sums of the slices; at most ``buckets`` rows reach the driver."""
    total, _, _, slots, counts = names
    pairs = rows.where(F.col(total)).select(F.explode(F.arrays_zip(F.col(slots).alias("slot"), F.col(counts).alias("n"))).alias("p"))
    sums = np.zeros(buckets, np.int64)
    for row in pairs.groupBy("p.slot").agg(F.sum("p.n").alias("n")).collect():
        sums[row["slot"]] = row["n"]
    return sums


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of each bucket's smoothed share in the target and in the corpus."""
    buckets, s_all, t_all = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * (s_all + buckets) / ((s + 1) * (t_all + buckets))))
                     for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def _weighed(gain: np.ndarray, at: int, names: list[str], batches):
    for batch in batches:
        slots, counts = batch.column(at), batch.column(at + 1)
        ends = np.append(0, np.cumsum(np.diff(slots.offsets.to_numpy())))
        each = np.append(0, np.cumsum(gain[slots.flatten().to_numpy()] * counts.flatten().to_numpy()))
        kept = [batch.column(i) for i in range(batch.num_columns) if i not in (at, at + 1)]
        yield pa.RecordBatch.from_arrays([*kept, pa.array((each[ends[1:]] - each[ends[:-1]]).astype(np.int64))], names=names)


def noise(key, seed: int):
    """Thousandths of a Gumbel variate that the seed and the id decide."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("bigint")


def resampled(docs: DataFrame, target: DataFrame, text_col: str = "text", id_col: str = "doc_id", keep: list[str] | None = None, *,
              target_text: str = "text", grams: int = GRAMS, buckets: int = BUCKETS, seed: int = SEED,
              min_words: int = MIN_WORDS, percent: int = PERCENT) -> DataFrame:
    """Every row with ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank`` (null if not drawn).

    Features are the runs of 1 to ``grams`` words; all documents and all target texts are counted.  A
    document's weight is the sum of the gains of its features, its score adds noise that its id decides,
    and of the N rows with ``min_words`` words floor(percent * N / 100) of the highest scores are drawn,
    ties to the smaller id.

    A null or empty text has no features, weight 0 and is not drawn (unless ``min_words`` is 0).  A null
    id takes the noise of an empty one and comes last among ties; rows with equal ids share their noise, and their
    order among ties is open.  Texts may be of any length; a longer one than a slice takes some 100 bytes
    of memory a byte of distinct chunks.  An empty table gives no rows; with an empty target only the
    corpus counts.  ``keep`` names the columns that come along (all by default); one named like a result,
    in any case, is replaced.  The counts of each document are written once to the shared folder.
    """
    results = ["n_words", "n_features", "weight", "score", "rank"]
    spark = docs.sparkSession
    kept = [c for c in others(docs, results) if keep is None or c in keep]
    key, summed, words, n_features, slots, counts, weight, score = fresh(
        docs, "__id", "__summed", "__words", "__features", "__slots", "__counts", "__weight", "__score")
    names = [summed, words, n_features, slots, counts]
    folder = scratch_folder(spark, "resampling")
    counted(docs.withColumn(key, column(id_col)), text_col, [key, *kept], grams, buckets, names).write.parquet(f"{folder}/counts")
    rows = spark.read.parquet(f"{folder}/counts")
    wanted = totals(counted(target, target_text, [], grams, buckets, names), names, buckets)
    gain = gains(totals(rows, names, buckets), wanted)

    narrow = rows.where(~F.col(summed)).select(key, *[column(c) for c in kept], words, n_features, slots, counts)
    schema = T.StructType([*narrow.schema.fields[:-2], T.StructField(weight, T.LongType())])
    weighed = narrow.mapInArrow(partial(_weighed, gain, len(narrow.columns) - 2, schema.names), schema)
    weighed.withColumn(score, F.col(weight) + noise(F.col(key), seed)).write.parquet(f"{folder}/scores")
    scored = spark.read.parquet(f"{folder}/scores")

    able = F.col(words) >= min_words
    n = scored.where(able).count()
    out = drawn(scored, able, score, key, percent * n // 100)
    return out.select(*[column(c) for c in kept], F.col(words).alias("n_words"), F.col(n_features).alias("n_features"),
                      F.col(weight).alias("weight"), F.col(score).alias("score"), "rank")


def drawn(scored: DataFrame, able, score: str, key: str, most: int) -> DataFrame:
    """``scored`` with ``rank``: the place of the ``most`` highest scores among the rows that are ``able``.

    Rows are counted per score; what lies above a score comes from running sums in two steps, so that no
    task orders more than the counts of COARSE scores.  Only rows of one score, which their noise spreads,
    are ordered by id.
    """
    above, coarse, place, value = fresh(scored, "__above", "__coarse", "__place", "__value")
    per = scored.where(able).groupBy(F.col(score).alias(value)).agg(F.count(F.lit(1)).alias("n")).withColumn(
        coarse, F.floor(F.col(value) / COARSE))
    stretches = per.groupBy(coarse).agg(F.sum("n").alias("n"))
    before = Window.orderBy(F.desc(coarse)).rowsBetween(Window.unboundedPreceding, -1)
    stretches = stretches.select(coarse, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(above))
    inside = Window.partitionBy(coarse).orderBy(F.desc(value)).rowsBetween(Window.unboundedPreceding, -1)
    firsts = (per.withColumn(place, F.coalesce(F.sum("n").over(inside), F.lit(0))).join(stretches, coarse)
              .select(value, (F.col(above) + F.col(place)).alias(above)).where(F.col(above) < most))
    tagged = scored.join(broadcast_if_small(firsts), able & (F.col(score) == F.col(value)), "left").drop(value)
    ties = Window.partitionBy(score).orderBy(F.col(key).asc_nulls_last())
    chosen = tagged.where(F.col(above).isNotNull()).withColumn(place, F.col(above) + F.row_number().over(ties))
    chosen = chosen.withColumn("rank", F.when(F.col(place) <= most, F.col(place))).drop(above, place)
    rest = tagged.where(F.col(above).isNull()).withColumn("rank", F.lit(None).cast("bigint")).drop(above)
    return chosen.unionByName(rest)


def oracle(grams: int = GRAMS, buckets: int = BUCKETS, seed: int = SEED, min_words: int = MIN_WORDS, percent: int = PERCENT) -> str:
    """The same draw for DuckDB, for single words; their checksums are computed byte by byte."""
    if grams != 1:
        raise ValueError("the SQL counts single words")
    bits = []
    for i in range(8):
        c = 1 << i
        for _ in range(8):
            c = (c >> 1) ^ (0xEDB88320 if c & 1 else 0)
        bits.append(f"((xor(a, b) >> {i}) & 1) * {c}")
    spread = "0"
    for term in bits:
        spread = f"xor({spread}, {term})"
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
WITH split AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({lower}, '{WORD}') AS ws FROM documents),
words AS (SELECT r, unnest(ws) AS w FROM split),
wanted AS (SELECT unnest(regexp_extract_all({lower}, '{WORD}')) AS w FROM benchmark),
spelled AS (SELECT w, list_transform(list_filter(string_split(regexp_replace(hex(w), '(..)', '\1,', 'g'), ','),
  lambda h: h <> ''), lambda h: CAST(('0x' || h) AS BIGINT)) AS bytes FROM (SELECT w FROM words UNION SELECT w FROM wanted)),
coded AS (SELECT w, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), bytes),
  lambda a, b: xor(a >> 8, {spread})), 4294967295) % {buckets} AS bucket FROM spelled),
s AS (SELECT bucket, count(*) AS n FROM words JOIN coded USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM wanted JOIN coded USING (w) GROUP BY bucket),
gains AS (SELECT b.bucket, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1) * CAST((SELECT count(*) FROM words) + {buckets} AS DOUBLE)
    / ((coalesce(s.n, 0) + 1) * CAST((SELECT count(*) FROM wanted) + {buckets} AS DOUBLE)))) AS BIGINT) AS gain
  FROM range({buckets}) b(bucket) LEFT JOIN s ON s.bucket = b.bucket LEFT JOIN t ON t.bucket = b.bucket),
weights AS (SELECT r, sum(gain) AS weight FROM words JOIN coded USING (w) JOIN gains USING (bucket) GROUP BY r),
scored AS (SELECT r, doc_id, len(ws) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight, CAST(coalesce(weight, 0) AS BIGINT)
    + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('{seed}:' || doc_id), 1, 8) AS BIGINT) + 0.5) / 4294967296.0::DOUBLE))) AS BIGINT)
    AS score FROM split LEFT JOIN weights USING (r)),
placed AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS able
  FROM scored WHERE n_features >= {min_words})
SELECT doc_id, n_features, weight, score, CASE WHEN place <= {percent} * able // 100 THEN place END AS rank
FROM scored LEFT JOIN placed USING (r)"""
