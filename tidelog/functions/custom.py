"""User code on messages, for what expressions cannot say.  All of it runs on Arrow batches inside
Spark tasks; prefer ``explode``, built-in aggregates and ``operators`` where they suffice."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import chain, groupby

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def map_messages(log: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """A deserializer of one's own: each batch of messages gives any number of rows."""

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield fn(frame)

    return log.mapInPandas(batches, schema)


def merge_aggregate(rows: DataFrame, keys: Sequence[str], partial: Callable[[pd.DataFrame], pd.DataFrame],
                    merge: Callable[[pd.DataFrame], pd.DataFrame], schema: str, *,
                    fan_in: int = 64) -> DataFrame:
    """An aggregate of one's own from a partial step and a merge step.

    ``partial`` turns a batch of rows into one state row per key; ``merge`` turns state rows of one
    key into one.  States are merged in two rounds, first spread over ``fan_in`` groups per key, so
    no group receives the rows, and a hot key's states are spread over tasks as well.
    """
    states = map_messages(rows, partial, schema)
    spread = states.withColumn("__slot", F.pmod(F.xxhash64(*states.columns), F.lit(fan_in)))
    by_slot = spread.groupBy(*keys, "__slot").applyInPandas(
        lambda frame: merge(frame.drop(columns="__slot")), schema)
    return by_slot.groupBy(*keys).applyInPandas(merge, schema)


#: Rows that user code's results are handed on by.
OUT_ROWS = 10_000


def _codes(column: pa.Array) -> np.ndarray:
    """A number per row: equal where Spark takes the values of a key as equal (nulls, NaN, both zeros)."""
    if pa.types.is_floating(column.type):
        column = pc.add(column, pa.scalar(0, column.type))
    try:
        coded = column.dictionary_encode("encode")
    except pa.ArrowNotImplementedError:  # nested values
        values = [repr(v) for v in column.to_pylist()]
        coded = pa.array(values).dictionary_encode()
    return coded.indices.to_numpy()


def _stretches(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Batches cut where a key begins, each with the number of its key; equal keys lie together."""
    number, last = 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        cuts = np.zeros(batch.num_rows, bool)
        for k in keys:
            codes = _codes(batch.column(k))
            cuts[1:] |= codes[1:] != codes[:-1]
        first = [batch.column(k).slice(0, 1) for k in keys]
        if last is not None:
            number += any(len(set(_codes(pa.concat_arrays([a, b])).tolist())) > 1 for a, b in zip(last, first))
        starts = [0, *np.flatnonzero(cuts).tolist(), batch.num_rows]
        for a, b in zip(starts, starts[1:]):
            number += a > 0
            yield number, batch.slice(a, b - a)
        last = [batch.column(k).slice(batch.num_rows - 1) for k in keys]


def _by_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str], schema: StructType,
            fn: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple]]) -> DataFrame:
    """``fn`` on the batches of each key, one key after the other in a task that sorts its keys' rows (on disk
    where needed): a key costs no exchange of its own with Python.  What ``fn`` leaves of a key is passed over."""
    arrow = to_arrow_schema(schema)

    def handed(made: list[tuple]) -> pa.RecordBatch:
        columns = zip(*made) if made else [[] for _ in arrow]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = []
        for _, stretch in groupby(_stretches(batches, keys), key=lambda s: s[0]):
            for row in fn(batch for _, batch in stretch):
                made.append(tuple(row))
                if len(made) == OUT_ROWS:
                    yield handed(made)
                    made = []
        yield handed(made)

    return rows.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)


def per_window(rows: DataFrame, keys: Sequence[str], ts: str, size: str,
               fn: Callable[[tuple, Iterator[pa.RecordBatch]], Iterator[tuple]], schema: StructType) -> DataFrame:
    """User code on whole windows: ``fn`` gets the keys, the window's start and end, and its rows as an
    iterator of Arrow batches, and gives any number of rows of ``schema``.

    The batches pass by one after the other, so a window that holds a third of all rows is never in memory
    as a whole; it is still one task's work.  What merges is better aggregated (``merge_aggregate``).
    """
    names = [*keys, "__start", "__end"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        first = next(batches)
        key = tuple(first.column(k)[0].as_py() for k in names)
        yield from fn(key, chain([first], batches))

    window = F.window(ts, size)
    timed = rows.withColumn("__w", window).withColumns({"__start": F.col("__w.start"), "__end": F.col("__w.end")}).drop("__w")
    return _by_key(timed, names, [], schema, run)


def message_rows(log: DataFrame, handler: type, schema: str, inputs: Sequence[str]) -> DataFrame:
    """Each message with every row that ``handler().eval(*inputs)`` yields for it: a table function in a lateral
    join.  A message for which it yields none has no row."""
    function = F.udtf(handler, returnType=schema, useArrow=True)
    return log.lateralJoin(function(*[F.col(c).outer() for c in inputs]))


def rows_per_key(log: DataFrame, handler: type, schema: str, keys: Sequence[str], order: str) -> DataFrame:
    """The rows that a handler with fields of its own yields for a key's messages, one by one in ``order``.

    Each key gets a new handler: ``eval(row)`` per message, ``terminate()`` behind the last.  Spark sorts
    the messages of a key (on disk where needed) and a batch of them is held; a hot key is one task's work.
    """
    row = Row(*log.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        user = handler()
        for batch in batches:
            for values in zip(*[c.to_pylist() for c in batch.columns]):
                yield from user.eval(row(*values)) or ()
        if hasattr(user, "terminate"):
            yield from user.terminate() or ()

    return _by_key(log, keys, [order], StructType.fromDDL(schema), run)
