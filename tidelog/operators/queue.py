"""Work queues as tables: a log of messages and a ledger of deliveries.

Ledger schema: ``bookmark, delivery, consumer, checkpoint_id, delivered_at, outcome`` with outcome
``ack``, ``cancel`` or ``none``.  An acknowledgement counts once its checkpoint, or any later one,
has completed; a cancelled delivery sends the message back.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class QueueRules:
    """Limits of a queue."""

    # Lease, message life, most deliveries and most cancels of the example queue.
    lease_s: int = 30
    ttl_s: int = 3600
    max_deliveries: int = 3
    max_cancels: int = 2


def last_completed(checkpoints: DataFrame) -> Column:
    """The last completed checkpoint as a scalar subquery; earlier ones are subsumed by it."""
    return checkpoints.agg(F.max("checkpoint_id")).scalar()


def acknowledged(ledger: DataFrame, completed: Column) -> DataFrame:
    """Deliveries whose acknowledgement a completed checkpoint covers."""
    return ledger.filter((F.col("outcome") == "ack") & (F.col("checkpoint_id") <= completed))


def pending(log: DataFrame, done: DataFrame) -> DataFrame:
    """Messages not yet done.  Bookmarks are unique in the log, so the join is even."""
    return log.join(done.select("bookmark"), "bookmark", "left_anti")


def pending_at_most_once(log: DataFrame, ledger: DataFrame) -> DataFrame:
    """At most once: a message is done with its first delivery, whatever came of it."""
    return pending(log, ledger)


def facts(ledger: DataFrame, completed: Column) -> DataFrame:
    """One row per delivered message: deliveries, cancels, covered acknowledgements, last delivery."""
    acked = (F.col("outcome") == "ack") & (F.col("checkpoint_id") <= completed)
    return ledger.groupBy("bookmark").agg(
        F.count(F.lit(1)).alias("deliveries"),
        F.count_if(F.col("outcome") == "cancel").alias("cancels"),
        F.count_if(acked).alias("acks"), F.max(F.struct("delivery", "delivered_at", "outcome")).alias("last"))


def status(log: DataFrame, ledger: DataFrame, completed: Column, now: Column,
           rules: QueueRules = QueueRules()) -> DataFrame:
    """Each message with its status: ``done``, ``leased``, ``failed``, ``expired`` or ``pending``.

    The last delivery decides: while it is out within its lease the message is leased, and a limit
    counts once that delivery has come back.  The ledger is reduced to one row per message before it
    meets the log; both sides are spread by bookmark.  The statuses partition the messages.
    """
    leased = ((F.col("last.outcome") == "none")
              & (F.col("last.delivered_at") + F.make_dt_interval(secs=F.lit(rules.lease_s)) > now))
    expired = F.col("ts") + F.make_dt_interval(secs=F.lit(rules.ttl_s)) <= now
    failed = ((F.col("deliveries") >= rules.max_deliveries)
              | (F.col("cancels") > rules.max_cancels))
    label = (F.when(F.col("acks") > 0, "done").when(leased, "leased").when(failed, "failed")
             .when(expired, "expired").otherwise("pending"))
    return (log.join(facts(ledger, completed), "bookmark", "left").withColumn("status", label)
            .withColumns({"deliveries": F.coalesce("deliveries", F.lit(0)),
                          "cancels": F.coalesce("cancels", F.lit(0))})
            .drop("acks", "last"))


def redeliveries(log: DataFrame, ledger: DataFrame, completed: Column, now: Column,
                 rules: QueueRules = QueueRules()) -> DataFrame:
    """Messages to deliver again: pending ones that were delivered before, so that their last delivery
    was cancelled or has outlived its lease."""
    again = status(log, ledger, completed, now, rules).filter(
        (F.col("status") == "pending") & (F.col("deliveries") > 0))
    return again.withColumn("next_delivery", F.col("deliveries") + 1).drop("status")


def unexpired(log: DataFrame, now: Column, ttl_s: int) -> DataFrame:
    return log.filter(F.col("ts") + F.make_dt_interval(secs=F.lit(ttl_s)) > now)


def lapsed_leases(ledger: DataFrame, completed: Column, now: Column, lease_s: int) -> DataFrame:
    """Messages whose last delivery was neither acknowledged nor cancelled and is past its lease."""
    return facts(ledger, completed).filter(
        (F.col("acks") == 0) & (F.col("last.outcome") == "none")
        & (F.col("last.delivered_at") + F.make_dt_interval(secs=F.lit(lease_s)) <= now)
    ).select("bookmark", F.col("last.delivery").alias("delivery"))


def failed(log: DataFrame, ledger: DataFrame, completed: Column, now: Column,
           rules: QueueRules = QueueRules()) -> DataFrame:
    """Messages that reached a delivery or cancel limit and came back without being acknowledged."""
    return status(log, ledger, completed, now, rules).filter(F.col("status") == "failed").drop("status")


def assign_consumers(messages: DataFrame, consumers: int, key: str = "bookmark") -> DataFrame:
    """Competing consumers: each message goes to exactly one."""
    return messages.withColumn("consumer", F.pmod(F.col(key), F.lit(consumers)))


def backlog_window(waiting: DataFrame, in_flight: DataFrame, max_backlog: int = 1) -> DataFrame:
    """What each consumer may be sent now: its first waiting messages, up to its free backlog.

    The fixed limit comes first, where Spark applies it before the shuffle; at most ``max_backlog``
    rows per consumer are left when the messages in flight are taken off.
    """
    w = Window.partitionBy("consumer").orderBy("bookmark")
    first = waiting.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= max_backlog)
    used = in_flight.groupBy("consumer").agg(F.count(F.lit(1)).alias("used"))
    return (first.join(used, "consumer", "left")
            .filter(F.col("rn") <= max_backlog - F.coalesce("used", F.lit(0))).drop("used"))
