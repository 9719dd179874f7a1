"""Work queues over the event log and a ledger of deliveries derived from it."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelog.functions.segments import whole_part
from tidelog.operators import queue
from tidelog.operators.queue import QueueRules
from tidelog.plans.registry import query
from tidelog.plans.sqltext import LOG
from tidelog.sources import topics

# A message has 0 to 4 delivery attempts, an hour apart.  Checkpoints cover 100 messages; every
# seventh is aborted.  The ledger's last day is not yet completed.
NOW, NOW_SQL = "2024-01-30 12:00:00", "TIMESTAMP '2024-01-30 12:00:00'"
RULES = QueueRules(lease_s=6 * 3600, ttl_s=20 * 86400)

QUEUE = LOG + f""", ledger AS (
  SELECT bookmark, a AS delivery, (bookmark + a) % 3 AS consumer, bookmark // 100 + a - 1 AS checkpoint_id,
    ts + INTERVAL 1 HOUR * a AS delivered_at,
    CASE WHEN (bookmark // 100 + a - 1) % 7 = 0 THEN 'cancel'
      WHEN a = bookmark % 5 AND bookmark % 3 <> 0 THEN 'ack' ELSE 'none' END AS outcome
  FROM log, range(1, 5) t(a) WHERE a <= bookmark % 5),
done_upto AS (SELECT max(checkpoint_id) AS c FROM ledger
  WHERE checkpoint_id % 7 <> 0 AND delivered_at <= TIMESTAMP '2024-01-29 12:00:00'),
facts AS (SELECT bookmark, count(*) AS deliveries, count(*) FILTER (WHERE outcome = 'cancel') AS cancels,
    count(*) FILTER (WHERE outcome = 'ack' AND checkpoint_id <= (SELECT c FROM done_upto)) AS acks,
    arg_max(outcome, delivery) AS last_outcome, max(delivered_at) AS last_at, max(delivery) AS last_delivery
  FROM ledger GROUP BY bookmark),
st AS (SELECT log.bookmark, ts, id, coalesce(deliveries, 0) AS deliveries, coalesce(cancels, 0) AS cancels,
    CASE WHEN acks > 0 THEN 'done'
      WHEN last_outcome = 'none' AND last_at + INTERVAL 6 HOUR > {NOW_SQL} THEN 'leased'
      WHEN deliveries >= 3 OR cancels > 2 THEN 'failed'
      WHEN ts + INTERVAL 20 DAY <= {NOW_SQL} THEN 'expired'
      ELSE 'pending' END AS status
  FROM log LEFT JOIN facts ON log.bookmark = facts.bookmark)"""


def messages(spark, d):
    return topics.event_log(spark, d).select("bookmark", "ts", "id")


def ledger(spark, d):
    n, a = F.col("bookmark"), F.col("delivery")
    attempts = messages(spark, d).filter(n % 5 > 0).select(
        "bookmark", "ts", F.explode(F.sequence(F.lit(1), (n % 5).cast("int"))).alias("delivery"))
    checkpoint = whole_part(n, 100) + a - 1
    return attempts.select(
        "bookmark", "delivery", ((n + a) % 3).alias("consumer"), checkpoint.alias("checkpoint_id"),
        (F.col("ts") + F.make_dt_interval(hours=a)).alias("delivered_at"),
        F.when(checkpoint % 7 == 0, "cancel")
         .when((a == n % 5) & (n % 3 != 0), "ack").otherwise("none").alias("outcome"))


def completed(deliveries):
    upto = F.lit("2024-01-29 12:00:00").cast("timestamp")
    return queue.last_completed(deliveries.filter(
        (F.col("checkpoint_id") % 7 != 0) & (F.col("delivered_at") <= upto)))


def now():
    return F.lit(NOW).cast("timestamp")


@query(QUEUE + """ SELECT bookmark, ts, id FROM log WHERE bookmark NOT IN (
  SELECT bookmark FROM ledger WHERE outcome = 'ack')""")
def queue_pending(spark, d):
    acks = ledger(spark, d).filter(F.col("outcome") == "ack")
    return queue.pending(messages(spark, d), acks)


@query(QUEUE + """ SELECT bookmark, delivery, checkpoint_id FROM ledger
WHERE outcome = 'ack' AND checkpoint_id <= (SELECT c FROM done_upto)""")
def queue_ack_subsume(spark, d):
    deliveries = ledger(spark, d)
    return queue.acknowledged(deliveries, completed(deliveries)).select(
        "bookmark", "delivery", "checkpoint_id")


@query(QUEUE + """ SELECT bookmark, id, deliveries, cancels, deliveries + 1 AS next_delivery
FROM st WHERE status = 'pending' AND deliveries > 0""")
def queue_redelivery(spark, d):
    deliveries = ledger(spark, d)
    return queue.redeliveries(messages(spark, d), deliveries, completed(deliveries), now(), RULES).select(
        "bookmark", "id", "deliveries", "cancels", "next_delivery")


@query(QUEUE + " SELECT bookmark, ts, id FROM log WHERE bookmark NOT IN (SELECT bookmark FROM ledger)")
def queue_at_most_once(spark, d):
    return queue.pending_at_most_once(messages(spark, d), ledger(spark, d))


@query(QUEUE + """, waiting AS (SELECT bookmark, bookmark % 3 AS consumer,
    row_number() OVER (PARTITION BY bookmark % 3 ORDER BY bookmark) AS rn FROM st WHERE status = 'pending'),
used AS (SELECT bookmark % 3 AS consumer, count(*) AS used FROM st WHERE status = 'leased' GROUP BY 1)
SELECT bookmark, waiting.consumer, rn FROM waiting LEFT JOIN used ON waiting.consumer = used.consumer
WHERE rn <= 200 - coalesce(used, 0)""")
def queue_backlog(spark, d):
    deliveries = ledger(spark, d)
    state = queue.status(messages(spark, d), deliveries, completed(deliveries), now(), RULES)
    shared = queue.assign_consumers(state, 3)
    return queue.backlog_window(
        shared.filter(F.col("status") == "pending").select("bookmark", "consumer"),
        shared.filter(F.col("status") == "leased"), 200).select("bookmark", "consumer", "rn")


@query(QUEUE + " SELECT bookmark, bookmark % 3 AS consumer FROM log")
def queue_consumers(spark, d):
    return queue.assign_consumers(messages(spark, d).select("bookmark"), 3)


@query(QUEUE + f""" SELECT bookmark, last_delivery AS delivery FROM facts
WHERE acks = 0 AND last_outcome = 'none' AND last_at + INTERVAL 6 HOUR <= {NOW_SQL}""")
def queue_lease(spark, d):
    deliveries = ledger(spark, d)
    return queue.lapsed_leases(deliveries, completed(deliveries), now(), RULES.lease_s)


@query(QUEUE + f" SELECT bookmark, ts, id FROM log WHERE ts + INTERVAL 20 DAY > {NOW_SQL}")
def queue_expiry(spark, d):
    return queue.unexpired(messages(spark, d), now(), RULES.ttl_s)


@query(QUEUE + " SELECT bookmark, deliveries, cancels FROM st WHERE status = 'failed'")
def queue_failed(spark, d):
    deliveries = ledger(spark, d)
    return queue.failed(messages(spark, d), deliveries, completed(deliveries), now(), RULES).select(
        "bookmark", "deliveries", "cancels")


@query(QUEUE + " SELECT bookmark, status, deliveries, cancels FROM st")
def queue_status(spark, d):
    deliveries = ledger(spark, d)
    return queue.status(messages(spark, d), deliveries, completed(deliveries), now(), RULES).select(
        "bookmark", "status", "deliveries", "cancels")
