"""Stream jobs: the operators run from a topic to a table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tidelog.functions.payload import to_json_text
from tidelog.operators.aggregate import AMOUNT, exact_text, price_windows
from tidelog.operators.changes import deltas, left_sight
from tidelog.operators.state import LIVE, fold, unfold
from tidelog.sources.topics import FIELDS, SOW, SOW_DELETE
from tidelog.streaming import commits, keyed
from tidelog.streaming.running import Job
from tidelog.streaming.sinks import idempotent_append, newest_per_key, read_batches, run_to_end
from tidelog.streaming.table import KeyedTable


def copy_stream(stream: DataFrame, folder: str) -> DataFrame:
    """Run a stateless stream to its end into a table and read that back."""
    run_to_end(stream, checkpoint=f"{folder}/checkpoint", path=f"{folder}/rows")
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/rows")


def latest_state(spark: SparkSession, stream: DataFrame, keys: Sequence[str],
                 fields: Sequence[str], folder: str) -> DataFrame:
    """Keep the latest record per key of a stream in a table.

    A batch is folded by the batch operator's aggregates and merged into the buckets of its keys, so the
    table and what a read costs grow with the keys and not with the messages.  Batches come in the order
    of the log: a deleted key is forgotten.  All of it stays in the JVM.
    """
    table = state_table(stream, keys, fields, f"{folder}/table")

    def upsert(batch: DataFrame, batch_id: int) -> None:
        table.upsert(batch.groupBy(*keys).agg(*fold(fields)), batch_id, keep=LIVE)

    run_to_end(stream.select("bookmark", "command", *keys, *fields), checkpoint=f"{folder}/checkpoint", each=upsert)
    return unfold(table.read(spark), keys, fields)


def state_table(rows: DataFrame, keys: Sequence[str], fields: Sequence[str], path: str, buckets: int = 16) -> KeyedTable:
    """The table of folded records of a log with the columns of ``rows``."""
    long = StructType.fromDDL("__last BIGINT, __deleted BIGINT, __reset BIGINT")
    at = [StructField(f"__at_{f}", long["__last"].dataType) for f in fields]
    schema = StructType([*[rows.schema[c] for c in keys], *long.fields, *[rows.schema[f] for f in fields], *at])
    merge = [*[F.max(c).alias(c) for c in long.names], *[F.max_by(f, f"__at_{f}").alias(f) for f in fields],
             *[F.max(f"__at_{f}").alias(f"__at_{f}") for f in fields]]
    return KeyedTable(path, keys, schema, merge, buckets)


def newest_windows(updates: DataFrame, key: str) -> DataFrame:
    """The last update of every window of a key."""
    return newest_per_key(updates, [key, "window_start", "window_end"]).drop("batch_id")


def window_totals(spark: SparkSession, stream: DataFrame, key: str, size: str, folder: str,
                  mode: str = "update") -> DataFrame:
    """Keyed windows of a stream with growing times.  ``update`` also hands on windows still open
    when the read ends; ``append`` only those the watermark has passed."""
    windows = price_windows(stream, key, "ts", size, ascending=True)
    run_to_end(windows, checkpoint=f"{folder}/checkpoint", mode=mode,
               each=idempotent_append(f"{folder}/updates"))
    updates = read_batches(spark, f"{folder}/updates", windows.schema)
    return newest_windows(updates, key)


def view_adjustments(history: DataFrame, amount: str = AMOUNT) -> DataFrame:
    """What each message takes from its key's old group and adds to the new one, from rows with the
    records after and before them."""
    def value(field: str, sign: str) -> str:
        return f"CAST({sign}coalesce({exact_text(field, amount)}, 0) AS {amount})"

    old = f"struct(prev_grp AS grp, {value('prev_ask', '-')} AS ask, {value('prev_bid', '-')} AS bid, -1 AS n)"
    new = f"struct(grp, {value('ask', '')} AS ask, {value('bid', '')} AS bid, 1 AS n)"
    return history.selectExpr(
        f"explode(array_compact(array(CASE WHEN had THEN {old} END, "
        f"CASE WHEN command <> '{SOW_DELETE}' THEN {new} END))) AS p").select("p.*")


def continuous_view(spark: SparkSession, stream: DataFrame, folder: str, amount: str = AMOUNT) -> DataFrame:
    """Keep ``sum(ask), sum(bid), count`` by group over the keyed state, in a table of one row per group.

    Each message retracts its key's old record from the old group and adds the new one, so the view
    is never recomputed; a batch's net change is added to the groups it touches.
    Values that are taken back are added as ``amount``; one that does not fit is an error.
    """
    schema = StructType.fromDDL(f"grp STRING, sum_ask {amount}, sum_bid {amount}, n BIGINT")
    total = [F.expr(f"CAST(sum({c}) AS {amount}) AS {c}") for c in ("sum_ask", "sum_bid")]
    table = KeyedTable(f"{folder}/view", ["grp"], schema, [*total, F.sum("n").alias("n")], buckets=1)
    history = keyed.record_changes(stream, ["id"], list(FIELDS))
    changes = view_adjustments(history, amount).withColumnsRenamed({"ask": "sum_ask", "bid": "sum_bid"})
    run_to_end(changes, checkpoint=f"{folder}/checkpoint", each=lambda batch, i: table.upsert(batch, i, keep="n > 0"))
    return table.read(spark)


def stored(stream: DataFrame, folder: str) -> DataFrame:
    """Run a stream to its end into an idempotent sink and read that back."""
    run_to_end(stream, checkpoint=f"{folder}/checkpoint", each=idempotent_append(f"{folder}/rows"))
    return read_batches(stream.sparkSession, f"{folder}/rows", stream.schema).drop("batch_id")


def delta_stream(stream: DataFrame, fields: Sequence[str], folder: str) -> DataFrame:
    """Field deltas of a stream as JSON: the key and the changed fields."""
    keys = ["id"]
    return stored(deltas(keyed.record_changes(stream, keys, fields), keys, fields), folder)


def snapshot_and_changes(snapshot: DataFrame, stream: DataFrame, fields: Sequence[str], folder: str, *,
                         as_deltas: bool = False, top: int | None = None) -> DataFrame:
    """The records of a snapshot (command ``sow``), then every update of a stream that starts behind it, as
    the full record or as field deltas.

    The snapshot becomes the initial state of the stream's operator, so no earlier message is read again;
    it is written first, so that what is handed on and what the state starts from are one and the same.
    ``top`` limits what is handed on of it, in key order, and not what the updates are compared with.
    """
    keys, spark = ["id"], stream.sparkSession
    snapshot.select("bookmark", *keys, *fields).write.mode("ignore").parquet(f"{folder}/snapshot")
    records = spark.read.schema(StructType([stream.schema[c] for c in ("bookmark", *keys, *fields)])).parquet(f"{folder}/snapshot")
    history = keyed.record_changes(stream, keys, fields, initial=records)
    later = deltas(history, keys, fields) if as_deltas else history.filter(
        F.col("command") != SOW_DELETE).select("bookmark", "command", *keys, *fields)
    shown = records if top is None else records.orderBy(*keys).limit(top)
    shown = shown.withColumn("command", F.lit(SOW))
    if as_deltas:
        shown = shown.select("bookmark", "command", *keys, to_json_text(*keys, *fields).alias("delta"))
    return shown.unionByName(stored(later, folder))


def out_of_focus_stream(stream: DataFrame, fields: Sequence[str], content_filter: str, folder: str, *,
                        expires: bool = False) -> DataFrame:
    """Events of a stream that take a matching record out of a reader's sight; with ``expires`` also when
    its time is over."""
    keys = ["id"]
    history = keyed.record_changes(stream, keys, fields, expires=expires)
    return stored(left_sight(history, keys, fields, content_filter), folder)


def changelog_stream(stream: DataFrame, measures: Sequence[str], folder: str) -> DataFrame:
    """Changelog of running totals per ``id``, from a stream."""
    return stored(keyed.changelog(stream, ["id"], measures), folder)


def command_stream(stream: DataFrame, wants_delete: Column, folder: str) -> DataFrame:
    """Rows with the commands of a writer that remembers its keys, from a stream."""
    return stored(keyed.choose_commands(stream, ["id"], wants_delete), folder)


def chain(first: DataFrame, topic: str, folder: str, build: Callable[[DataFrame], DataFrame],
          mode: str = "update") -> DataFrame:
    """Two queries in one job, at the same time: ``first`` is published to a topic folder, and what ``build``
    makes of the stream of that topic is written batch by batch.  Ends when both have done all there is."""
    spark, copy = first.sparkSession, f"{folder}/{topic}"
    commits.make_folder(spark, copy)
    with Job(spark) as job:
        second = build(spark.readStream.schema(first.schema).parquet(copy))
        follower = job.start(second, f"{folder}/second-checkpoint", each=idempotent_append(f"{folder}/updates"), mode=mode)
        leader = job.start(first, f"{folder}/{topic}-checkpoint", path=copy, every=None)
        job.wait(lambda: not leader.isActive)
        job.drain(follower)
    return read_batches(spark, f"{folder}/updates", second.schema)
