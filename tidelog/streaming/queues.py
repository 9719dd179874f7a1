"""Queues fed by two streams: deliveries, and the answers to them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def answered(deliveries: DataFrame, answers: DataFrame, lease_s: int) -> DataFrame:
    """Each delivery (``bookmark, delivery, delivered_at``) with its answer (``bookmark, delivery, answered_at,
    outcome``) within the lease, or with a null ``outcome`` once its lease has lapsed on both streams' clocks.

    An answer that comes later is none.  The state holds what lies within a lease.  Times may grow only
    from batch to batch of a stream.
    """
    given = answers.withWatermark("answered_at", "0 seconds").select(
        F.col("bookmark").alias("__bookmark"), F.col("delivery").alias("__delivery"), "answered_at", "outcome")
    within = F.expr("bookmark = __bookmark AND delivery = __delivery AND answered_at >= delivered_at "
                    f"AND answered_at <= delivered_at + INTERVAL {int(lease_s)} SECONDS")
    sent = deliveries.withWatermark("delivered_at", "0 seconds")
    return sent.join(given, within, "leftOuter").drop("__bookmark", "__delivery")


def again(judged: DataFrame) -> DataFrame:
    """What is to be delivered again: deliveries that were cancelled or whose lease lapsed."""
    back = F.when(F.col("outcome").isNull(), "lapsed").when(F.col("outcome") == "cancel", "cancelled")
    return judged.withColumn("reason", back).filter(F.col("reason").isNotNull()).select(
        "bookmark", "delivery", "reason", (F.col("delivery") + 1).alias("next_delivery"))
