"""State per key on Spark's own stateful operator: what a key holds lives in the state store, and a batch
reads and writes only the keys it has messages for.

``keyed`` is the general form: a step function takes what a key holds and a message, and gives what it
holds then and any number of rows.  Deadlines are event-time timers: a key that nobody writes to again still
gives its last rows and leaves the state.  A snapshot may come first, as the operator's initial state.

A task sorts one key's messages of one batch: the trigger's files or bytes bound them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import partial
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from tidelog.sources.topics import DELTA_PUBLISH, EXPIRED, SOW_DELETE

#: What a key holds: a tuple by the state's schema, or None.
Held = tuple | None
Step = Callable[[tuple, Held, Row], tuple[Held, list[tuple]]]


class _Keyed(StatefulProcessor):
    def __init__(self, state: T.StructType, output: T.StructType, order: str, step: Step, deadline, lapse):
        self.state, self.output, self.order = state, Row(*output.names), order
        self.step, self.deadline, self.lapse = step, deadline, lapse

    def init(self, handle) -> None:
        self.handle, self.value = handle, handle.getValueState("held", self.state)

    def _held(self) -> Held:
        found = self.value.get()
        return None if found is None else tuple(found)

    def _keep(self, old: Held, new: Held) -> None:
        if new is not None:
            self.value.update(new)
        elif old is not None:
            self.value.clear()
        if self.deadline:
            was, will = (None if h is None else self.deadline(h) for h in (old, new))
            if was != will:
                if was is not None:
                    self.handle.deleteTimer(was)
                if will is not None:
                    self.handle.registerTimer(will)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        before = held = self._held()
        for row in sorted(rows, key=lambda r: r[self.order]):
            held, made = self.step(key, held, row)
            yield from (self.output(*m) for m in made)
        self._keep(before, held)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held = self._held()
        # a timer that a later message of this batch has moved is none
        if held is None or self.deadline(held) != expiredTimerInfo.getExpiryTimeInMs():
            return
        self.value.clear()
        yield from (self.output(*m) for m in self.lapse(key, held))

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self._keep(None, tuple(initialState[f] for f in self.state.fieldNames()))


def keyed(stream: DataFrame, keys: Sequence[str], order: str, state: T.StructType, output: T.StructType, step: Step, *,
          clock: str | None = None, deadline: Callable[[tuple], int | None] | None = None,
          lapse: Callable[[tuple, tuple], list[tuple]] | None = None, initial: DataFrame | None = None) -> DataFrame:
    """The rows that ``step`` gives for every message, per key in ``order``.

    ``step(key, held, row)`` returns what the key holds after the row (None: nothing) and the output rows as
    tuples.  ``deadline(held)`` is a time in epoch milliseconds; once the newest ``clock`` of all messages
    has reached it, ``lapse(key, held)`` gives last rows and the key is gone.  Messages of any age are taken.
    ``initial`` holds keys and state columns that are there before the first message.
    """
    if deadline:
        # the watermark follows a copy, so that the operator does not drop old messages by it
        columns = stream.columns
        stream = stream.withColumn("__clock", F.col(clock)).withWatermark("__clock", "0 seconds").select(*columns)
    return stream.groupBy(*keys).transformWithState(
        _Keyed(state, output, order, step, deadline, lapse), output, "Append", "EventTime" if deadline else "None",
        initialState=None if initial is None else initial.groupBy(*keys))


# Records.


def _change(fields: int, expires: bool, key: tuple, held: Held, row: Row) -> tuple[Held, list[tuple]]:
    made = []
    if expires and held is not None and held[1] is not None and held[1] <= row["__micros"]:
        made += _lapse(fields, key, held)
        held = None
    before = held
    if row["command"] == SOW_DELETE:
        held = None
    else:
        base = before[2:] if before and row["command"] == DELTA_PUBLISH else (None,) * fields
        new = row[-fields:]
        ends = None
        if expires and row["__life"] is not None and row["__life"] >= 0:
            ends = row["__micros"] + row["__life"] * 1_000_000
        held = (row["bookmark"], ends, *[b if v is None else v for v, b in zip(new, base)])
    none = (None,) * fields
    made.append((row["bookmark"], row["command"], *key, *(held[2:] if held else none),
                 *(before[2:] if before else none), before is not None))
    return held, made


def _ends(held: tuple) -> int | None:
    return None if held[1] is None else -(-held[1] // 1000)


def _lapse(fields: int, key: tuple, held: tuple) -> list[tuple]:
    return [(held[0], EXPIRED, *key, *(None,) * fields, *held[2:], True)]


def record_changes(stream: DataFrame, keys: Sequence[str], fields: Sequence[str], *, expires: bool = False,
                   initial: DataFrame | None = None) -> DataFrame:
    """Every message of a stream with the key's record after it (``fields``) and before it (``prev_<field>``);
    ``had`` says whether the key was live before.  The same rule as the batch operator ``changes.history``.

    With ``expires`` a record leaves ``expiration_s`` after its last write, by the newest ``ts`` of all
    messages to the millisecond: a row of command ``expired`` with the position of that write tells it,
    whether or not the key is written to again.  ``initial`` is a snapshot (keys, fields, ``bookmark`` and,
    with ``expires``, ``last_ts`` and ``expiration_s``) that the stream goes on from.
    """
    schema = stream.schema
    state = T.StructType([T.StructField("bookmark", T.LongType()), T.StructField("ends", T.LongType()),
                          *[schema[f] for f in fields]])
    output = T.StructType([T.StructField("bookmark", T.LongType()), T.StructField("command", T.StringType()),
                           *[schema[k] for k in keys], *[schema[f] for f in fields],
                           *[T.StructField(f"prev_{f}", schema[f].dataType) for f in fields],
                           T.StructField("had", T.BooleanType())])
    timed = ["ts", F.unix_micros("ts").alias("__micros"), F.col("expiration_s").cast("bigint").alias("__life")] if expires else []
    rows = stream.select("bookmark", "command", *timed, *keys, *fields)
    if initial is not None:
        ends = F.when(F.col("expiration_s") >= 0, F.unix_micros("last_ts") + F.col("expiration_s").cast("bigint") * 1_000_000) \
            if expires else F.lit(None).cast("bigint")
        initial = initial.select(*keys, "bookmark", ends.alias("ends"), *fields)
    n = len(fields)
    more: dict[str, Any] = dict(clock="ts", deadline=_ends, lapse=partial(_lapse, n)) if expires else {}
    return keyed(rows, keys, "bookmark", state, output, partial(_change, n, expires), initial=initial, **more)


# Changelogs and commands.


def _total(measures: Sequence[str], key: tuple, held: Held, row: Row) -> tuple[Held, list[tuple]]:
    new = tuple(row[m] for m in measures)
    if held is None:
        return new, [(*key, row["bookmark"], "+I", *new)]
    total = tuple(h if v is None else v if h is None else h + v for h, v in zip(held, new))
    return total, [(*key, row["bookmark"], "-U", *held), (*key, row["bookmark"], "+U", *total)]


def changelog(stream: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """A stream's changelog of running totals of ``measures``, by position, as ``changes.aggregate_changelog``."""
    totals = [stream.schema[m] for m in measures]
    output = T.StructType([*[stream.schema[k] for k in keys], T.StructField("bookmark", T.LongType()),
                           T.StructField("op", T.StringType()), *totals])
    return keyed(stream.select("bookmark", *keys, *measures), keys, "bookmark", T.StructType(totals), output,
                 partial(_total, list(measures)))


def _choose(wants: str, key: tuple, held: Held, row: Row) -> tuple[Held, list[tuple]]:
    command = "publish" if held is None else SOW_DELETE if row[wants] else DELTA_PUBLISH
    return None if command == SOW_DELETE else (True,), [(*row[:-1], command)]


def choose_commands(stream: DataFrame, keys: Sequence[str], wants_delete) -> DataFrame:
    """A stream's rows with the command of a writer that remembers which keys are known."""
    rows = stream.withColumn("__wants", F.coalesce(wants_delete, F.lit(False)))
    state = T.StructType([T.StructField("known", T.BooleanType())])
    output = T.StructType([*stream.schema.fields, T.StructField("command", T.StringType())])
    return keyed(rows, keys, "bookmark", state, output, partial(_choose, "__wants"))
