"""Jobs that keep running: several queries at once, stopped together, and what they counted."""

from __future__ import annotations

import json
import threading
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from tidelog.operators.aggregate import observe_io
from tidelog.streaming import commits
from tidelog.streaming.sinks import STATE_SETTINGS, query_settings


class Job:
    """Queries that run at the same time and end together: if one fails, the others are stopped and its
    error is raised.  Use it as a context manager, which stops what still runs at its end."""

    #: Seconds between two looks at the queries.
    PAUSE = 0.1

    def __init__(self, spark: SparkSession):
        self.spark, self.queries = spark, []

    def start(self, stream: DataFrame, checkpoint: str, *, path: str | None = None,
              each: Callable[[DataFrame, int], None] | None = None, mode: str = "append",
              every: str | None = "0 seconds") -> StreamingQuery:
        """Start a query: a micro-batch ``every`` so often, or, with None, all there is and then an end."""
        writer: DataStreamWriter = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
        writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
        with query_settings(self.spark, STATE_SETTINGS):
            query = writer.foreachBatch(each).start() if each else writer.format("parquet").option("path", path).start()
        self.queries.append(query)
        return query

    def wait(self, done: Callable[[], bool]) -> None:
        """Until ``done``, or until a query fails."""
        while True:
            self._check()
            if done():
                return
            time.sleep(self.PAUSE)

    def drain(self, query: StreamingQuery) -> None:
        """Until a query that keeps running has done all that is there now."""
        try:
            query.processAllAvailable()
        except Exception:
            self._check()
            raise
        self._check()

    def stop(self) -> None:
        for query in self.queries:
            query.stop()

    def _check(self) -> None:
        for query in self.queries:
            error = query.exception()
            if error is not None:
                self.stop()
                raise error

    def __enter__(self) -> Job:
        return self

    def __exit__(self, *_) -> None:
        self.stop()


class Counters(StreamingQueryListener):
    """Records, payload bytes and state of every batch of the queries watched, in a log of small files.

    ``watched`` puts the counters on a stream; they are taken while its rows pass by.  ``table`` reads them
    back, also while the queries run.  Queries report to their own session alone, and the thread's active one
    may be another: the listener joins the session of every stream watched, until the block ends.
    """

    def __init__(self, path: str):
        self.path, self.ended, self.spark, self.sessions = path, {}, None, []

    def watched(self, stream: DataFrame, name: str, data: str = "data") -> DataFrame:
        self.spark = stream.sparkSession
        if not any(self.spark is s for s in self.sessions):
            self.spark.streams.addListener(self)
            self.sessions.append(self.spark)
        return observe_io(stream, name, data)

    def __enter__(self) -> Counters:
        return self

    def __exit__(self, *_) -> None:
        while self.sessions:
            self.sessions.pop().streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        self.ended[str(event.runId)] = threading.Event()

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        for name, row in progress.observedMetrics.items():
            if row["records"]:
                entry = {"name": name, "run": str(progress.runId), "batch": progress.batchId, "records": row["records"],
                         "bytes": row["bytes"] or 0, "ms": progress.durationMs.get("triggerExecution", 0), "error": None}
                commits.put(self.spark, self.path, f"{progress.runId}-{progress.batchId:010d}-{name}", entry)

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            entry = {"name": None, "run": str(event.runId), "batch": None, "records": 0, "bytes": 0, "ms": 0,
                     "error": str(event.exception)[:1000]}
            commits.put(self.spark, self.path, f"{event.runId}-error", entry)
        self.ended.setdefault(str(event.runId), threading.Event()).set()

    def settled(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until the last events of a query that ended are there: they come by a queue of their own."""
        if not self.ended.setdefault(str(query.runId), threading.Event()).wait(seconds):
            raise TimeoutError(f"no end of {query.runId} was told")

    def table(self, spark: SparkSession) -> DataFrame:
        """A row per query and batch, and one per failure."""
        rows = [json.dumps(e) for e in commits.entries(spark, self.path)]
        texts = spark.createDataFrame([(r,) for r in rows], "value STRING")
        schema = "name STRING, run STRING, batch BIGINT, records BIGINT, bytes BIGINT, ms BIGINT, error STRING"
        return texts.selectExpr(f"from_json(value, '{schema}') AS r").select("r.*")
