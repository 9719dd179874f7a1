"""Event-time windows and grouped aggregates, batch or streaming.

Every aggregate here is built in and mergeable, so Spark aggregates before it shuffles: a hot key or
window costs one row per map task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


#: The type in which totals are added that are later taken back or compared; a parameter everywhere.
AMOUNT = "decimal(28,6)"


def exact_text(text: str, kind: str = AMOUNT) -> str:
    """SQL text of a number as a decimal that keeps all its digits; one that does not fit is an error,
    never rounded."""
    return (f"CASE WHEN {text} IS NULL OR CAST(CAST({text} AS {kind}) AS DOUBLE) = CAST({text} AS DOUBLE) "
            f"THEN CAST({text} AS {kind}) ELSE CAST(raise_error(concat('{kind} cannot hold ', {text})) AS {kind}) END")


def exact(column: str, kind: str = AMOUNT) -> Column:
    """Exact amounts, for totals that are later taken back or compared: sums do not depend on the
    order of addition.  Plain reports add doubles, which is several times faster."""
    return F.expr(exact_text(f"`{column}`", kind))


def tumbling(rows: DataFrame, keys: Sequence[str], ts: str, size: str,
             measures: Mapping[str, Column], *, ascending: bool = False) -> DataFrame:
    """Keyed tumbling event-time windows, aligned to the epoch.

    ``ascending`` adds the watermark of a stream whose times only grow (no lateness); a batch read
    needs none.
    """
    timed = rows.withWatermark(ts, "0 seconds") if ascending else rows
    out = timed.groupBy(*keys, F.window(ts, size).alias("w")).agg(
        *[c.alias(n) for n, c in measures.items()])
    return out.select(*keys, F.col("w.start").alias("window_start"),
                      F.col("w.end").alias("window_end"), *measures)


def price_measures() -> dict[str, Column]:
    """Sums, averages and counts of bid and ask, and the number of records."""
    return {n: F.expr(t) for n, t in {
        "bid_sum": "sum(bid)", "ask_sum": "sum(ask)", "bid_avg": "avg(bid)", "ask_avg": "avg(ask)",
        "bid_n": "count(bid)", "ask_n": "count(ask)", "records": "count(1)"}.items()}


def price_windows(rows: DataFrame, key: str, ts: str, size: str, *,
                  ascending: bool = False) -> DataFrame:
    """Per key and window: sums, averages and counts of bid and ask, and the number of records."""
    return tumbling(rows, [key], ts, size, price_measures(), ascending=ascending)


def flag_windows(rows: DataFrame, key: str, ts: str, size: str, flag: Column, *,
                 ascending: bool = False) -> DataFrame:
    """Per key and window: rows with a flag, and all rows."""
    return tumbling(rows, [key], ts, size,
                    {"flagged": F.count_if(flag), "records": F.count(F.lit(1))},
                    ascending=ascending)


def alert_limit(window_s: int, per_second: float, max_share: float) -> Column:
    """The most flagged rows that still count as normal in a window."""
    return F.ceil(F.lit(window_s) * F.lit(per_second) * F.lit(max_share))


def alerts(windows: DataFrame, limit: Column, window_s: int, per_second: float) -> DataFrame:
    """Windows above the limit, with the share of flagged rows."""
    return windows.filter(F.col("flagged") > limit).withColumn(
        "share", F.col("flagged") / F.lit(window_s * per_second))


def two_level(rows: DataFrame, keys: Sequence[str], salt: Column) -> DataFrame:
    """Sums and averages from partial sums per salt: merging partial results gives the same result."""
    parts = rows.groupBy(*keys, salt.alias("__salt")).agg(*map(F.expr, (
        "sum(bid) AS b", "count(bid) AS bn", "sum(ask) AS a", "count(ask) AS an", "count(1) AS n")))
    return parts.groupBy(*keys).agg(*map(F.expr, (
        "sum(b) AS bid_sum", "sum(a) AS ask_sum", "sum(b) / sum(bn) AS bid_avg",
        "sum(a) / sum(an) AS ask_avg", "sum(bn) AS bid_n", "sum(an) AS ask_n", "sum(n) AS records")))


def group_count(rows: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Non-null values of a column per group."""
    return rows.groupBy(*keys).agg(F.count(column).alias("n"))


def group_sum(rows: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(*[F.sum(c).alias(f"sum_{c}") for c in columns])


def io_metrics(log: DataFrame, by: Sequence[str] = ("topic",), data: str = "data") -> DataFrame:
    """Messages and payload bytes per topic."""
    return log.groupBy(*by).agg(F.count(F.lit(1)).alias("records"),
                                F.sum(F.octet_length(F.col(data))).alias("bytes"))


def observe_io(log: DataFrame, name: str | Observation, data: str = "data") -> DataFrame:
    """The same counters taken while the rows pass by, batch or stream (``QueryProgress``)."""
    return log.observe(name, F.count(F.lit(1)).alias("records"),
                       F.sum(F.octet_length(F.col(data))).alias("bytes"))
