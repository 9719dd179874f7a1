"""Topics with a position index: folders by blocks of bookmarks, and a small table of what each block holds.

A block is ``width`` consecutive bookmarks of a topic.  Reads that start at a bookmark or a time, batch or
stream, learn from the index which blocks can match, and a condition on the folder columns keeps Spark
from opening any other file.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions.positions import after, may_hold, upto
from tidelog.functions.segments import whole_part

#: Bookmarks of a block.
WIDTH = 1 << 20

INDEX_SCHEMA = ("topic STRING, block BIGINT, n BIGINT, least_bookmark BIGINT, greatest_bookmark BIGINT, "
                "least_ts TIMESTAMP, greatest_ts TIMESTAMP")


def append(rows: DataFrame, path: str, width: int = WIDTH) -> None:
    """Append rows to an indexed topic folder.

    A block of one append is one file, written by one task that holds at most ``width`` rows.  The index
    follows the data: readers that start at a position see the rows once it is there.  Use one ``width``
    per folder.  A stream takes files by age, so those of one append in any order: where order matters
    between batches (state per key), append a block at a time or let a trigger take whole appends.
    """
    blocks = rows.withColumn("block", whole_part(F.col("bookmark"), width))
    blocks.repartition("topic", "block").write.mode("append").partitionBy("topic", "block").parquet(f"{path}/log")
    blocks.groupBy("topic", "block").agg(*[F.expr(e) for e in (
        "count(1) AS n", "min(bookmark) AS least_bookmark", "max(bookmark) AS greatest_bookmark",
        "min(ts) AS least_ts", "max(ts) AS greatest_ts")]).coalesce(1).write.mode("append").parquet(f"{path}/index")


def index(spark: SparkSession, path: str) -> DataFrame:
    """What each block of each append holds."""
    return spark.read.schema(INDEX_SCHEMA).parquet(f"{path}/index")


def newest(spark: SparkSession, path: str) -> str:
    """The position behind all messages that are there now: a read from it returns new ones only."""
    last = index(spark, path).agg(F.max("greatest_bookmark")).first()[0]
    return "0" if last is None else str(last)


def read(spark: SparkSession, path: str, schema: T.StructType, start: str = "", *, end: str = "") -> DataFrame:
    """The messages that a replay from ``start`` returns, or, with ``end``, those up to a point (inclusive)."""
    holds = may_hold(start) & (F.lit(True) if not end else _begins_by(end))
    return (spark.read.schema(_stored(schema)).parquet(f"{path}/log").filter(_inside(index(spark, path).filter(holds)))
            .filter(after(start)).filter(upto(end)).select(*schema.fieldNames()))


def stream(spark: SparkSession, path: str, schema: T.StructType, start: str = "", **options: str) -> DataFrame:
    """The messages from ``start`` on as a stream; those that come later are part of it."""
    known = index(spark, path)
    first = known.filter(may_hold(start)).groupBy("topic").agg(F.min("block").alias("block"))
    # a topic whose blocks all end before the start goes on behind its last one
    last = known.groupBy("topic").agg(F.max("block").alias("last"))
    starts = last.join(first, "topic", "left").select("topic", F.coalesce("block", "last").alias("block")).collect()  # a row a topic
    new_topic = ~F.col("topic").isin(*[r["topic"] for r in starts]) if starts else F.lit(True)
    wanted = reduce(lambda a, r: a | ((F.col("topic") == r["topic"]) & (F.col("block") >= r["block"])), starts, new_topic)
    return (spark.readStream.schema(_stored(schema)).options(**options).parquet(f"{path}/log").filter(wanted)
            .filter(after(start)).select(*schema.fieldNames()))


def _begins_by(end: str) -> Column:
    """Blocks whose first row is not behind ``end``."""
    return may_hold(f"[0:{end}]") if end.isdigit() else may_hold(f"[00010101T000000:{end}]")


def _inside(blocks: DataFrame) -> Column:
    """Folders between the first and the last of some blocks, per topic."""
    spans = blocks.groupBy("topic").agg(F.min("block").alias("a"), F.max("block").alias("b")).collect()  # a row a topic
    return reduce(lambda c, r: c | ((F.col("topic") == r["topic"]) & F.col("block").between(r["a"], r["b"])), spans, F.lit(False))


def _stored(schema: T.StructType) -> T.StructType:
    columns = [f for f in schema.fields if f.name != "topic"]
    return T.StructType([*columns, T.StructField("topic", T.StringType()), T.StructField("block", T.LongType())])
