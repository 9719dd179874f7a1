"""Replays, splits and filters.  Everything here works on a batch log and on a streaming one, unless
it says it needs a bounded log."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.functions.bounds import broadcast_if_small
from tidelog.functions.payload import path_filter
from tidelog.functions.positions import after
from tidelog.functions.segments import running_row_number, whole_part
from tidelog.sources.topics import DELTA_PUBLISH, OOF, PUBLISH, SOW

# The commands a plain read hands on; snapshot markers and acknowledgements are not.
DATA_COMMANDS = (PUBLISH, DELTA_PUBLISH, OOF, SOW)


@dataclass(frozen=True)
class Split:
    """One part of a read: a topic, an optional filter, and a start position of its own."""

    topic: str = ""
    content_filter: str | Column | None = None
    bookmark: str = ""

    def condition(self, default_topic: str | None = None, default_bookmark: str = "",
                  source_filter: str | Column | None = None) -> Column:
        """Rows of this split: the split's topic and position beat the source's, filters are ANDed."""
        topic = self.topic or default_topic
        parts = [predicate(source_filter), predicate(self.content_filter),
                 after(self.bookmark or default_bookmark)]
        if topic:
            parts.append(F.col("topic") == topic)
        out = parts[0]
        for p in parts[1:]:
            out = out & p
        return out


def predicate(condition: str | Column | None) -> Column:
    """A filter given as a column, as text with ``/field`` paths, or not at all."""
    if condition is None or (isinstance(condition, str) and not condition.strip()):
        return F.lit(True)
    return path_filter(condition) if isinstance(condition, str) else condition


def subscribe(log: DataFrame, topics: Sequence[str] | None = None, *, start: str = "",
              content_filter: str | Column | None = None) -> DataFrame:
    """Messages of the topics from a position on, in no promised order.

    On a stream this is the live tail; on a stored log, the replay."""
    rows = log.filter(after(start)).filter(predicate(content_filter))
    return rows.filter(F.col("topic").isin(*topics)) if topics else rows


def replay_top(log: DataFrame, n: int, order: str = "bookmark") -> DataFrame:
    """The first ``n`` messages of a bounded replay (one TakeOrderedAndProject)."""
    return log.orderBy(order).limit(n)


def read_splits(log: DataFrame, splits: Mapping[str, Split], *, topic: str | None = None,
                bookmark: str = "", source_filter: str | Column | None = None) -> DataFrame:
    """All rows of all splits, tagged ``split_id``; a row in two splits comes out twice.

    One pass over the log: each row lists the splits it is in and is repeated for each of them, so
    the log is not scanned once per split.
    """
    conditions = {i: s.condition(topic, bookmark, source_filter) for i, s in splits.items()}
    anywhere = None
    for c in conditions.values():
        anywhere = c if anywhere is None else anywhere | c
    if anywhere is None:
        raise ValueError("no splits")
    names = F.array(*[F.when(c, F.lit(i)) for i, c in conditions.items()])
    return log.filter(anywhere).withColumn("split_id", F.explode(F.array_compact(names)))


def shard(log: DataFrame, key: Column, n: int) -> DataFrame:
    """Shard number ``key MOD n`` for an integral key, computed in the scan; shards are disjoint
    and together complete."""
    return log.withColumn("split", F.pmod(key, F.lit(n)))


def shard_by_hash(log: DataFrame, key: Column, n: int) -> DataFrame:
    """Shard number by CRC32 of a key's text: a key stays in one shard."""
    return shard(log, F.crc32(key.cast("string")), n)


def top_per_split(log: DataFrame, n: int, split: str = "split_id",
                  order: Sequence[str | Column] = ("bookmark",)) -> DataFrame:
    """The first ``n`` messages of each split, numbered ``rn``.  Spark limits the groups before the
    shuffle (WindowGroupLimit), so at most ``n`` rows per split and map task move."""
    w = Window.partitionBy(split).orderBy(*order)
    return log.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= n)


def rate_schedule(log: DataFrame, rate: int, splits: Sequence[str] = ("topic",),
                  order: str = "bookmark", **limits: int) -> DataFrame:
    """The second at which a replay limited to ``rate`` messages per split hands on each message."""
    numbered = running_row_number(log, splits, order, "rn", **limits)
    return numbered.withColumn("emit_second", whole_part(F.col("rn") - 1, rate)).drop("rn")


def resume(log: DataFrame, points: DataFrame, split: str = "split_id") -> DataFrame:
    """Messages after the last position of each split; a split without a position starts over.

    ``points(split, last_bookmark)`` has one row per split and is broadcast if its count is small.
    """
    return (log.join(broadcast_if_small(points), split, "left")
            .filter(F.col("last_bookmark").isNull() | (F.col("bookmark") > F.col("last_bookmark")))
            .drop("last_bookmark"))


def data_messages(log: DataFrame) -> DataFrame:
    """Drop snapshot markers and acknowledgements."""
    return log.filter(F.col("command").isin(*DATA_COMMANDS))


def headers(log: DataFrame, keys: Mapping[str, Column], wanted: Sequence[str]) -> DataFrame:
    """Wanted headers as columns ``header_<name>``; a header the log does not carry is null."""
    missing = F.lit(None).cast("string")
    return log.withColumns({f"header_{k.lower()}": keys.get(k, missing) for k in wanted})
