"""What the operators of this folder share: tables, Arrow batches of bounded size, cut lineage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.session import scratch_folder

#: Text bytes that a Python worker handles at a time.
SLICE_BYTES = 6 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def column(name: str):
    return F.col("`" + name.replace("`", "``") + "`")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the cluster's shared folder, with its lineage cut."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_folder(df.sparkSession, "checkpoints"))
    return df.checkpoint()


def forget(spark: SparkSession, folder: str) -> None:
    """Delete a folder that this session wrote and no longer reads."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def slices(batch: pa.RecordBatch, text: int | None) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about SLICE_BYTES of text each; a longer text is a part of its own."""
    if text is None or not batch.num_rows:
        yield batch
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + SLICE_BYTES, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def give_back() -> None:
    """Hand memory that is free back to the system: Spark keeps workers for later tasks and stages, beside
    those that run then."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's own
    if trim:
        trim(0)


def appended(df: DataFrame, inputs: list[str], keep: list[str], outputs: list[T.StructField],
             start: Callable[[], Callable], filtered: bool = False) -> DataFrame:
    """The ``keep`` columns of ``df`` followed by ``outputs``, computed from ``inputs`` in Arrow batches.

    ``start`` runs once per task and returns a function from lists (one per input) to lists or Arrow arrays
    (one per output).  The first input is the text by whose size batches are cut.  With ``filtered`` the first
    list returned says which rows stay.  An output takes the place of a kept column of its name.
    """
    names = {f.name for f in outputs}
    keep = [c for c in keep if c not in names]
    cols = list(dict.fromkeys([*keep, *inputs]))
    narrow = df.select(*[column(c) for c in cols])
    schema = T.StructType([narrow.schema[c] for c in keep] + outputs)
    at = [cols.index(c) for c in inputs]
    kept = [cols.index(c) for c in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work, types = start(), [_arrow(f.dataType) for f in outputs]
        for batch in batches:
            for part in slices(batch, at[0] if at else None):
                made = list(work(*[part.column(i).to_pylist() for i in at]))
                if filtered:
                    mask = pa.array(made.pop(0), pa.bool_())
                    part = part.filter(mask)
                made = [v if isinstance(v, pa.Array) else pa.array(v, t) for v, t in zip(made, types)]
                yield pa.RecordBatch.from_arrays([*[part.column(i) for i in kept], *made],
                                                 names=[*keep, *[f.name for f in outputs]])
                del part, made
        del work
        give_back()

    return narrow.mapInArrow(run, schema)


def labelled(docs: DataFrame, labels: DataFrame, label: str, held_out: Callable, most: dict[int, int],
             max_text: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """text, label and hash of a bounded sample of the labelled rows that are not held out.

    Of each label value the ``most`` rows of the smallest hash are taken.  Rows with a null id, label or
    text, and texts over ``max_text`` bytes, are not learned from.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.select(F.col("doc_id").alias("__id"), F.col(label).cast("int").alias("label"),
                         F.xxhash64(F.col("doc_id")).alias("hash"))
    chosen = None
    for value, n in most.items():
        part = known.where(F.col("label") == value).orderBy("hash", "__id").limit(n)
        chosen = part if chosen is None else chosen.unionAll(part)
    text = docs.select(column(id_col).alias("__id"), column(text_col).alias("text"))
    # a bounded number of ids goes to every task, so that no text is shuffled
    return (text.where(F.octet_length("text") <= max_text).join(F.broadcast(chosen), "__id")
            .select("text", "label", "hash").orderBy("hash", "text").limit(sum(most.values())))


def _arrow(kind: T.DataType) -> pa.DataType:
    plain = {T.LongType: pa.int64(), T.IntegerType: pa.int32(), T.DoubleType: pa.float64(),
             T.StringType: pa.string(), T.BooleanType: pa.bool_(), T.BinaryType: pa.binary()}
    if isinstance(kind, T.ArrayType):
        return pa.list_(_arrow(kind.elementType))
    return plain[type(kind)]


def long(name: str) -> T.StructField:
    return T.StructField(name, T.LongType())


def string(name: str) -> T.StructField:
    return T.StructField(name, T.StringType())


def double(name: str) -> T.StructField:
    return T.StructField(name, T.DoubleType())


def integer(name: str) -> T.StructField:
    return T.StructField(name, T.IntegerType())


def boolean(name: str) -> T.StructField:
    return T.StructField(name, T.BooleanType())
