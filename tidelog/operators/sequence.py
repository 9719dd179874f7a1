"""Order-dependent checks and counters: gaps, every n-th message, duplicates, increasing times."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.segments import running, running_row_number, split_hot_keys, whole_part


def missing_numbers(rows: DataFrame, number: str, splits: int) -> DataFrame:
    """Numbers ``n + splits`` that never came although ``n`` did, apart from the end of each
    residue class.

    Every row votes "seen" for its own number and "due" for the one after it; one aggregate over the
    (evenly spread) numbers tells which are due but not seen.  Arrival order does not matter.
    """
    n = F.col(number)
    votes = rows.select(F.explode(F.array(
        F.struct(n.alias("missing"), F.lit(1).alias("seen")),
        F.struct((n + splits).alias("missing"), F.lit(0).alias("seen")))).alias("v")).select("v.*")
    due = votes.groupBy("missing").agg(F.max("seen").alias("seen"))
    # one row per residue class: ``splits`` rows in all
    ends = rows.groupBy(F.pmod(n, F.lit(splits)).alias("__class")).agg(
        (F.max(n) + splits).alias("missing")).select("missing")
    return (due.filter(F.col("seen") == 0).select("missing")
            .join(F.broadcast(ends), "missing", "left_anti"))


def outstanding_per_block(rows: DataFrame, order: str, number: str, block: int, first: int = 0,
                          **limits: int) -> DataFrame:
    """After every ``block`` arrivals: the highest number so far, and how many from ``first`` up to it
    have not arrived yet.  Each number arrives once; an unfinished last block is not reported."""
    seen = running(rows.select(order, number), [], order, sums={"__n": "1L"}, maxes={"__top": F.col(number)}, **limits)
    return seen.filter(F.col("__n") % block == 0).select(
        whole_part(F.col("__n"), block).alias("block"), F.col("__top").alias("highest"),
        (F.col("__top") - first + 1 - F.col("__n")).alias("outstanding"))


def every_nth(log: DataFrame, splits: Sequence[str], order: str, n: int, **limits: int) -> DataFrame:
    """Every ``n``-th message of each split."""
    return running_row_number(log, splits, order, "rn", **limits).filter(F.col("rn") % n == 0)


def drop_replayed(log: DataFrame, identity: Sequence[str]) -> DataFrame:
    """One copy of each message.  Copies are equal, so a map-side aggregate keeps one per task before
    the shuffle, however many there are."""
    return log.dropDuplicates(list(identity))


def drop_replayed_stream(log: DataFrame, identity: Sequence[str], ts: str, within: str) -> DataFrame:
    """The same on a stream: copies that come within some event time of each other.  Identities older
    than the watermark leave the state."""
    return log.withWatermark(ts, within).dropDuplicatesWithinWatermark(list(identity))


def time_violations(rows: DataFrame, writer: Sequence[str], order: str, ts: str, **limits: int) -> DataFrame:
    """Rows an exactly-once writer must refuse: no time, a negative one, or one not greater than
    every earlier time of the same writer."""
    scanned = running(rows, writer, order, maxes={"__high": F.col(ts)}, **limits)
    t, high = F.col(ts), F.col("__high__before")
    reason = (F.when(t.isNull(), "missing").when(t < 0, "negative")
              .when(t <= high, "not increasing"))
    return (scanned.withColumn("reason", reason).filter(F.col("reason").isNotNull())
            .withColumnRenamed("__high__before", "previous").drop("__high"))


def late_rows(rows: DataFrame, arrival: str, ts: str, batch_size: int, window_s: int, **limits: int) -> DataFrame:
    """Rows an event-time window of ``window_s`` seconds drops as late, batch by batch.

    The watermark of a batch is the greatest time of all earlier batches.  Times are reduced to one
    row per batch before they are scanned, and joined back on the batch number.
    """
    batch = whole_part(F.col(arrival), batch_size)
    tagged = rows.withColumn("batch", batch)
    highs = tagged.groupBy("batch").agg(F.max(ts).alias("__high"))
    marks = running(highs, [], "batch", maxes={"__mark": F.col("__high")}, **limits).select(
        "batch", F.col("__mark__before").alias("watermark"))
    end = F.window(ts, f"{window_s} seconds")["end"]
    return (tagged.withColumn("window_end", end).join(marks, "batch")
            .filter(F.col("window_end") <= F.col("watermark")))


def choose_commands(rows: DataFrame, keys: Sequence[str], order: str, wants_delete: Column, **limits: int) -> DataFrame:
    """The command of each row of a writer that remembers which keys it has published.

    An unknown key is published.  A known key is updated, or deleted and forgotten when
    ``wants_delete``; a null wish is none.  Seen as state changes, an update always leaves the key known, and a row that
    wants a delete flips known and unknown.  So the state before a row is the parity of the flips
    since the last update, which two running values give without walking the key in order.
    """
    wants_delete = F.coalesce(wants_delete, F.lit(False))
    flip = F.when(wants_delete, F.lit(1)).otherwise(F.lit(0)).cast("bigint")
    tagged = split_hot_keys(rows, keys, order, **limits)
    counted = running(tagged, keys, order, sums={"__flips": flip})
    marked = counted.withColumn("__at_update", F.when(~wants_delete, F.col("__flips")))
    scanned = running(marked, keys, order, maxes={"__base": F.col("__at_update")})
    base = F.col("__base__before")
    flips = F.coalesce(F.col("__flips__before"), F.lit(0))
    known = F.when(base.isNull(), flips % 2 == 1).otherwise((flips - base) % 2 == 0)
    command = (F.when(~known, "publish").when(wants_delete, "sow_delete")
               .otherwise("delta_publish"))
    return scanned.select(*rows.columns, command.alias("command"))
