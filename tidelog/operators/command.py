"""A read command as one value: what to read, from where, how much, in which form.

``TopicRead(...).run(log)`` only composes the operators of this package; the result is a DataFrame.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.payload import to_json_text
from tidelog.functions.positions import is_range, upto
from tidelog.operators import changes, read, state
from tidelog.operators.read import Split
from tidelog.sources.topics import EXPIRED, SOW_DELETE

# The read commands.
SUBSCRIBE = "subscribe"
SOW = "sow"
SOW_AND_SUBSCRIBE = "sow_and_subscribe"
DELTA_SUBSCRIBE = "delta_subscribe"
SOW_AND_DELTA_SUBSCRIBE = "sow_and_delta_subscribe"
COMMANDS = (SUBSCRIBE, SOW, SOW_AND_SUBSCRIBE, DELTA_SUBSCRIBE, SOW_AND_DELTA_SUBSCRIBE)

_ORDER = re.compile(r"/?([\w/]+)(?:\s+(ASC|DESC))?", re.IGNORECASE)


@dataclass(frozen=True)
class TopicRead:
    """A read.  ``keys`` and ``fields`` name the key and payload columns of the log.

    ``bookmark`` is a start position for replays and deltas, and for reads of state the point (a time or
    a bookmark) at which the state is taken.  Filters see messages in a replay and records elsewhere; a
    split's topic and bookmark beat the read's, and its filter is added.  ``top_n``, ``skip_n`` and
    ``order_by`` apply to replays and snapshots, per split.  Without a topic, records are kept per
    topic and key, and the result says the topic.  With ``expires`` records leave ``expiration_s`` after their
    last write, in snapshots by the newest row they show; otherwise ``expiration_s`` is not read.
    """

    keys: Sequence[str]
    fields: Sequence[str]
    command: str = SUBSCRIBE
    topic: str | None = None
    content_filter: str | Column | None = None
    splits: Mapping[str, Split] = field(default_factory=dict)
    bookmark: str = ""
    top_n: int = 0
    skip_n: int = 0
    order_by: str = ""
    expires: bool = False

    def __post_init__(self) -> None:
        if self.command not in COMMANDS:
            raise ValueError(f"unknown read command {self.command!r}")
        if self.skip_n and not (self.top_n and self.command == SOW):
            raise ValueError("skip_n pages through a state query and needs top_n")
        if self.order_by and self.command not in (SOW, SOW_AND_SUBSCRIBE, SOW_AND_DELTA_SUBSCRIBE):
            raise ValueError("order_by orders a state query")
        if self.top_n and self.command == DELTA_SUBSCRIBE:
            raise ValueError("top_n limits replays and state queries")

    @property
    def bounded(self) -> bool:
        """Whether the read ends by itself.  Reads that go on after a snapshot never do."""
        if self.command in (SOW_AND_SUBSCRIBE, SOW_AND_DELTA_SUBSCRIBE):
            return False
        starts = [s.bookmark or self.bookmark for s in self.splits.values()] or [self.bookmark]
        return self.top_n > 0 or self.command == SOW or all(is_range(b) for b in starts)

    def run(self, log: DataFrame) -> DataFrame:
        if self.command == SUBSCRIBE:
            rows = log.filter(F.col("topic") == self.topic) if self.topic and not self.splits else log
            return self._replay(rows)
        # splits with the same topic and point share one pass over the log
        groups: dict[tuple[str, str], dict[str, Split]] = {}
        for name, split in self.splits.items():
            at = (split.topic or self.topic or "", split.bookmark or self.bookmark)
            groups.setdefault(at, {})[name] = Split(content_filter=split.content_filter)
        parts = [self._records(log, topic, bookmark, splits)
                 for (topic, bookmark), splits in (groups or {(self.topic or "", self.bookmark): {}}).items()]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part, allowMissingColumns=True)
        return out

    def _replay(self, log: DataFrame) -> DataFrame:
        if self.splits:
            rows = read.read_splits(log, self.splits, topic=self.topic, bookmark=self.bookmark,
                                    source_filter=self.content_filter)
            return read.top_per_split(rows, self.top_n).drop("rn") if self.top_n else rows
        rows = read.subscribe(log, start=self.bookmark, content_filter=self.content_filter)
        return read.replay_top(rows, self.top_n) if self.top_n else rows

    def _records(self, log: DataFrame, topic: str, bookmark: str, splits: Mapping[str, Split]) -> DataFrame:
        """The snapshot, the changes behind it, or both, of one topic and point."""
        rows = log.filter(F.col("topic") == topic) if topic else log
        # keys of different topics are different keys
        keys = list(self.keys) if topic or "topic" not in log.columns else ["topic", *self.keys]
        columns = ["bookmark", "command", *keys, *self.fields]
        tag = ["split_id"] if splits else []
        beside = [*keys[:len(keys) - len(self.keys)], *tag]  # of a delta, which only holds the payload
        seen = F.coalesce(upto(bookmark), F.lit(False))
        deltas = self.command in (DELTA_SUBSCRIBE, SOW_AND_DELTA_SUBSCRIBE)
        out = None
        if self.command != DELTA_SUBSCRIBE:
            records = self._split(state.state_at(rows, keys, self.fields, upto=seen, expires=self.expires), splits)
            records = self._page(records, keys, tag)
            if self.command == SOW:
                return records
            records = records.withColumn("command", F.lit(changes.SOW))
            delta = to_json_text(*self.keys, *self.fields).alias("delta")
            out = records.select("bookmark", "command", *self.keys, delta, *beside) if deltas \
                else records.select(*columns, *tag)
        changed = self._split(changes.history(rows, keys, self.fields, expires=self.expires), splits)
        # a delta read without a position starts with the log, a snapshot without one is of all of it
        if bookmark or self.command != DELTA_SUBSCRIBE:
            changed = changed.filter(~seen)
        later = changes.deltas(changed, self.keys, self.fields, beside) if deltas \
            else changed.filter(~F.col("command").isin(SOW_DELETE, EXPIRED)).select(*columns, *tag)
        return later if out is None else out.unionByName(later)

    def _split(self, records: DataFrame, splits: Mapping[str, Split]) -> DataFrame:
        if splits:
            return read.read_splits(records, splits, source_filter=self.content_filter)
        return records.filter(read.predicate(self.content_filter))

    def _page(self, records: DataFrame, keys: Sequence[str], tag: Sequence[str]) -> DataFrame:
        order = self._order(keys)
        if tag and self.top_n:
            numbered = read.top_per_split(records, self.top_n + self.skip_n, order=order)
            return numbered.filter(F.col("rn") > self.skip_n).drop("rn")
        if self.top_n:
            return state.page(records, order, self.top_n, self.skip_n)
        return records.orderBy(*tag, *order) if self.order_by and self.command == SOW else records

    def _order(self, keys: Sequence[str]) -> list[Column]:
        """The order asked for, then the key, so that pages are stable."""
        wanted = []
        for part in filter(None, (p.strip() for p in self.order_by.split(","))):
            found = _ORDER.fullmatch(part)
            if not found:
                raise ValueError(f"not an order: {part!r}")
            column = F.col(found.group(1).strip("/").replace("/", "."))
            down = (found.group(2) or "ASC").upper() == "DESC"
            wanted.append(column.desc() if down else column.asc())
        return [*wanted, *[F.col(k) for k in keys]]
