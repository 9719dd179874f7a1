"""Outgoing rows: per-row overrides, routing, rejects, and what a recovered writer still has to send."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.bounds import broadcast_if_small
from tidelog.functions.payload import valid_correlation_id
from tidelog.sources.topics import DELTA_PUBLISH, PUBLISH, SOW_DELETE

# What a row may set, and the commands a writer accepts.
OVERRIDES = ("topic", "command", "sow_key", "correlation_id", "expiration_s")
WRITE_COMMANDS = (PUBLISH, DELTA_PUBLISH, SOW_DELETE)


def outgoing(rows: DataFrame, data: Column, *, topic: str, command: str = PUBLISH,
             correlation_id: str | None = None, expiration_s: int | None = None,
             overrides: Mapping[str, Column] | None = None) -> DataFrame:
    """Rows as messages: ``data`` and the writer's defaults, any of which a row may override."""
    if command not in WRITE_COMMANDS:
        raise ValueError(f"unknown command {command!r}")
    defaults = {"topic": F.lit(topic), "command": F.lit(command),
                "sow_key": F.lit(None).cast("string"),
                "correlation_id": F.lit(correlation_id).cast("string"),
                "expiration_s": F.lit(expiration_s).cast("int")}
    own = overrides or {}
    unknown = set(own) - set(OVERRIDES)
    if unknown:
        raise ValueError(f"a row cannot set {sorted(unknown)}")
    return rows.withColumns({
        "data": data,
        **{n: F.coalesce(own[n], d) if n in own else d for n, d in defaults.items()}})


def route(rows: DataFrame, condition: Column, topic: str, otherwise: str) -> DataFrame:
    """Topic per row: ``topic`` where the condition holds, ``otherwise`` where it does not or is
    unknown."""
    return rows.withColumn("topic", F.when(condition, topic).otherwise(otherwise))


def reject_reason(rows: DataFrame, parsed: Column | None = None) -> DataFrame:
    """Why a row cannot be written, null if it can.  Filter on it for either side."""
    checks = (F.when(F.col("topic").isNull() | (F.col("topic") == ""), "no topic")
              .when(~F.col("command").isin(*WRITE_COMMANDS), "unknown command")
              .when(F.col("correlation_id").isNotNull()
                    & ~valid_correlation_id(F.col("correlation_id")), "bad correlation id"))
    if parsed is not None:
        checks = checks.when((F.col("command") != SOW_DELETE) & parsed.isNull(), "bad payload")
    return rows.withColumn("reject", checks)


def split_rejects(rows: DataFrame, parsed: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows that can be written, and the others with their reason, so that none is lost."""
    judged = reject_reason(rows, parsed)
    return judged.filter(F.col("reject").isNull()).drop("reject"), judged.filter(F.col("reject").isNotNull())


def resume_after(rows: DataFrame, high_water: DataFrame, writer: str, ts: str) -> DataFrame:
    """Rows a restored writer still has to send: those newer than its last sent time.

    The mark is kept per writer, so a job may come back with another parallelism.  ``high_water``
    has one row per writer and is broadcast if its count is small.
    """
    marks = high_water.select(writer, F.col("high_water"))
    return (rows.join(broadcast_if_small(marks), writer, "left")
            .filter(F.col("high_water").isNull() | (F.col(ts) > F.col("high_water")))
            .drop("high_water"))


def high_water(rows: DataFrame, writer: str, ts: str) -> DataFrame:
    """The last sent time per writer."""
    return rows.groupBy(writer).agg(F.max(ts).alias("high_water"))


def strictly_increasing(violations: DataFrame) -> DataFrame:
    """Strict mode: reading a violation fails the query."""
    return violations.select(F.raise_error(F.concat_ws(
        " ", F.lit("refused row:"), F.col("reason"))).alias("error"))
