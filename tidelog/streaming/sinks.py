"""Stream runs and ``foreachBatch`` sinks that are safe to repeat."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from tidelog.operators.write import resume_after
from tidelog.session import ROCKSDB_PROVIDER
from tidelog.streaming import commits


@contextmanager
def query_settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Start queries under these settings, and put the session's own back."""
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


# State in RocksDB.  One stateful operator per query, so late rows are judged by the newest watermark
# and not, as chained operators need it, by the one before.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    "spark.sql.streaming.statefulOperator.allowMultiple": "false",
}


def run_to_end(stream: DataFrame, *, checkpoint: str, path: str | None = None,
               each: Callable[[DataFrame, int], None] | None = None,
               mode: str = "append") -> StreamingQuery:
    """Process all there is and stop (``availableNow``); a later run goes on from the checkpoint."""
    writer = (stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
              .trigger(availableNow=True))
    with query_settings(stream.sparkSession, STATE_SETTINGS):
        query = (writer.foreachBatch(each).start() if each
                 else writer.format("parquet").option("path", path).start())
        query.awaitTermination()
    return query


def run_of(batch: DataFrame) -> str:
    """The stream that a batch belongs to: the id that Spark keeps in its checkpoint.  A job restarted
    from its checkpoint goes on under it; one without its checkpoint is another run."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"


def idempotent_append(path: str) -> Callable[[DataFrame, int], None]:
    """Each attempt at a batch writes a folder of its own and is then entered in a log of commits by one rename.

    ``read_batches`` takes the newest attempt of each batch: a repeated batch leaves no second copy, a reader
    that runs meanwhile sees the old rows or the new ones, and no run touches what another one wrote.
    Replaced attempts stay until ``drop_replaced``, for readers that still use them.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        run, attempt = run_of(batch), uuid.uuid4().hex
        folder = f"run_id={run}/batch_id={batch_id}/attempt={attempt}"
        batch.write.parquet(f"{path}/{folder}")
        number = time.time_ns()
        commits.put(batch.sparkSession, f"{path}/_commits", f"{number:020d}-{attempt}",
                    {"run": run, "batch": batch_id, "folder": folder})

    return write


def _committed(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """Folders of the newest attempts, and of those that they replaced."""
    newest: dict[tuple[str, int], str] = {}
    replaced = []
    for entry in commits.entries(spark, f"{path}/_commits"):
        old = newest.get((entry["run"], entry["batch"]))
        replaced += [old] if old else []
        newest[entry["run"], entry["batch"]] = entry["folder"]
    return list(newest.values()), replaced


def drop_replaced(spark: SparkSession, path: str) -> None:
    """Delete the attempts that later ones replaced, once no reader uses them."""
    for folder in _committed(spark, path)[1]:
        commits.delete(spark, f"{path}/{folder}")


def plain_append(path: str) -> Callable[[DataFrame, int], None]:
    """At least once: a repeated batch is written again; readers drop the copies."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("append").parquet(path)

    return write


def resuming_append(path: str, writer: str, ts: str,
                    marks: DataFrame | None) -> Callable[[DataFrame, int], None]:
    """Exactly once: rows up to the writer's restored time are skipped, the rest is written once."""
    write = idempotent_append(path)

    def resume_then_write(batch: DataFrame, batch_id: int) -> None:
        write(batch if marks is None else resume_after(batch, marks, writer, ts), batch_id)

    return resume_then_write


# Delivery guarantees.
NONE, AT_LEAST_ONCE, EXACTLY_ONCE = "none", "at_least_once", "exactly_once"


def publish_stream(stream: DataFrame, path: str, checkpoint: str, guarantee: str = NONE, *,
                   writer: str | None = None, ts: str | None = None,
                   marks: DataFrame | None = None) -> StreamingQuery:
    """Run outgoing rows into a table under a delivery guarantee.

    Exactly once names the writer and its strictly increasing time; ``marks`` holds the last sent
    time per writer when a job is restored without its checkpoint.  They are kept beside the new
    checkpoint, so that a restart of this run still skips what was sent before it.
    """
    if guarantee == EXACTLY_ONCE:
        if not (writer and ts):
            raise ValueError("exactly once needs a writer and a time column")
        if marks is not None:
            kept = f"{checkpoint.rstrip('/')}-marks"
            marks.write.mode("ignore").parquet(kept)
            marks = marks.sparkSession.read.schema(marks.schema).parquet(kept)
        each = resuming_append(path, writer, ts, marks)
    elif guarantee in (NONE, AT_LEAST_ONCE):
        each = plain_append(path)
    else:
        raise ValueError(f"unknown guarantee {guarantee!r}")
    return run_to_end(stream, checkpoint=checkpoint, each=each)


def read_batches(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All committed rows of an idempotent sink, of all its runs, with the batch that wrote them."""
    tagged = StructType([*schema.fields, StructField("batch_id", LongType())])
    folders, _ = _committed(spark, path)
    if not folders:
        return spark.createDataFrame([], tagged)
    return spark.read.schema(tagged).option("basePath", path).parquet(*[f"{path}/{f}" for f in folders]).select(*tagged.names)


def newest_per_key(updates: DataFrame, keys: list[str], order: str = "batch_id") -> DataFrame:
    """The last update of each key from the batches of an ``update``-mode sink."""
    rest = [c for c in updates.columns if c not in keys]
    return (updates.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("r"))
            .select(*keys, *[f"r.{c}" for c in rest]))
