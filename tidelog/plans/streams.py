"""The operators under Structured Streaming, run to the end of the given data."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelog.operators import aggregate, read, sequence, state
from tidelog.plans.queues import QUEUE, RULES, ledger
from tidelog.plans.registry import query
from tidelog.plans.sequences import COIN_SQL, coin, replayed
from tidelog.plans.sqltext import CHANGED, HISTORY, LOG, OOF_EXPIRING, WHOLE, state as sql_state
from tidelog.plans.windows import CHANGELOG_SQL, PRICE_SQL, compared, in_sevenths
from tidelog.session import scratch_folder
from tidelog.sources import indexed, topics
from tidelog.streaming import jobs, running, sinks
from tidelog.streaming import queues as stream_queues

KEY, FIELDS = ["id"], list(topics.FIELDS)
HOURLY_SQL = in_sevenths(LOG) + f""" SELECT topic, time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
  time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, {PRICE_SQL}
FROM log GROUP BY ALL"""


@query(LOG + """, found AS (SELECT topic, bookmark, bid FROM log WHERE bid > 10)
SELECT 'batch' AS run, * FROM found UNION ALL SELECT 'stream', * FROM found""")
def bounded_equals_stream(spark, d):
    def found(log):
        return read.subscribe(log, content_filter="/bid > 10").select("topic", "bookmark", "bid")

    stream = jobs.copy_stream(found(topics.event_parts(spark, d)), scratch_folder(spark, "bounded"))
    return (found(topics.event_log(spark, d)).withColumn("run", F.lit("batch"))
            .unionByName(stream.withColumn("run", F.lit("stream"))))


@query(HOURLY_SQL)
def stream_window_agg(spark, d):
    stream = topics.event_parts(spark, d).withColumn("bid", F.col("bid") / 7)
    return compared(jobs.window_totals(spark, stream, "topic", "1 hour", scratch_folder(spark, "windows")))


@query(LOG + " SELECT topic, bookmark, ts, command, data FROM log")
def stream_passthrough(spark, d):
    stream = topics.event_parts(spark, d).select("topic", "bookmark", "ts", "command", "data")
    return jobs.copy_stream(stream, scratch_folder(spark, "passthrough"))


@query(LOG + " SELECT topic, bookmark, id FROM log")
def stream_resume(spark, d):
    """Run, add the second half of the messages, run again from the same checkpoint."""
    folder = scratch_folder(spark, "resume")
    log = topics.event_log(spark, d).select("topic", "bookmark", "ts", "id")
    half = F.col("ts") < F.lit("2024-01-16").cast("timestamp")
    for part in (half, ~half):
        topics.append_topics(log.filter(part), f"{folder}/topic")
        stream = topics.stream_topics(spark, f"{folder}/topic", log.schema)
        sinks.run_to_end(stream, checkpoint=f"{folder}/checkpoint", path=f"{folder}/rows")
    return spark.read.schema(log.schema).parquet(f"{folder}/rows").select("topic", "bookmark", "id")


@query(LOG + " SELECT topic, bookmark, id FROM log WHERE ts >= TIMESTAMP '2024-01-16'")
def stream_live_tail(spark, d):
    """New messages only: those that are appended after the reader has asked where the topic ends."""
    folder = scratch_folder(spark, "live-tail")
    log = topics.event_log(spark, d).select("topic", "bookmark", "ts", "id")
    half = F.col("ts") < F.lit("2024-01-16").cast("timestamp")
    indexed.append(log.filter(half), f"{folder}/topic")
    end = indexed.newest(spark, f"{folder}/topic")
    indexed.append(log.filter(~half), f"{folder}/topic")
    stream = indexed.stream(spark, f"{folder}/topic", log.schema, end)
    return jobs.copy_stream(stream, f"{folder}/out").select("topic", "bookmark", "id")


@query(HISTORY + " " + sql_state())
def stream_sow(spark, d):
    return jobs.latest_state(spark, topics.event_parts(spark, d), KEY, FIELDS,
                             scratch_folder(spark, "state"))


@query(HISTORY + f""" SELECT grp, CAST(coalesce(sum(CAST(ask AS DECIMAL(18,2))), 0) AS DOUBLE) AS sum_ask,
  CAST(coalesce(sum(CAST(bid AS DECIMAL(18,2))), 0) AS DOUBLE) AS sum_bid, count(id) AS n
FROM ({sql_state()}) GROUP BY grp""")
def stream_view(spark, d):
    return jobs.continuous_view(spark, topics.event_parts(spark, d), scratch_folder(spark, "view"))


@query(HOURLY_SQL)
def stream_chain(spark, d):
    folder = scratch_folder(spark, "chain")
    first = topics.event_parts(spark, d).select("topic", "ts", (F.col("bid") / 7).alias("bid"), "ask")
    updates = jobs.chain(first, "copied", folder, lambda second: aggregate.price_windows(
        second, "topic", "ts", "1 hour", ascending=True))
    return compared(jobs.newest_windows(updates, "topic"))


@query(LOG + " SELECT topic, count(*) AS records, CAST(sum(strlen(data)) AS BIGINT) AS bytes FROM log GROUP BY topic")
def stream_io_metrics(spark, d):
    """What a listener counted, batch by batch, while a stream of each topic was copied."""
    folder = scratch_folder(spark, "counters")
    counters = running.Counters(f"{folder}/counters")
    log = topics.event_parts(spark, d)
    names = [r[0] for r in topics.event_log(spark, d).select("topic").distinct().collect()]  # a handful of topics
    with counters, running.Job(spark) as job:
        for name in names:
            own = counters.watched(log.filter(F.col("topic") == name), name).select("topic", "bookmark", "data")
            job.start(own, f"{folder}/{name}-checkpoint", path=f"{folder}/{name}", every=None)
        job.wait(lambda: not any(q.isActive for q in job.queries))
        for started in job.queries:
            counters.settled(started)
    return counters.table(spark).groupBy(F.col("name").alias("topic")).agg(
        F.sum("records").alias("records"), F.sum("bytes").alias("bytes"))


def two_streams(spark, d):
    """Deliveries and the answers to them (up to 50 minutes later), each as four files by time."""
    sent = ledger(spark, d)
    answer = F.col("delivered_at") + F.make_dt_interval(mins=(F.col("bookmark") % 50).cast("int"))
    answers = sent.filter("outcome <> 'none'").select("bookmark", "delivery", answer.alias("answered_at"), "outcome")
    low, high = (F.lit(t).cast("timestamp").cast("long") for t in ("2024-01-01", "2024-02-01"))
    out = []
    for name, rows, at in (("sent", sent.select("bookmark", "delivery", "delivered_at"), "delivered_at"),
                           ("answers", answers, "answered_at")):
        folder = scratch_folder(spark, name)
        part = F.width_bucket(F.col(at).cast("long"), low, high, F.lit(4))
        for i in range(6):
            rows.filter(part == i).coalesce(1).write.mode("append").parquet(folder)
        out.append(spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", "1").parquet(folder))
    return out


CLOCK = """clock AS (SELECT date_trunc('milliseconds', least((SELECT max(delivered_at) FROM ledger),
  (SELECT max(delivered_at + INTERVAL 1 MINUTE * (bookmark % 50)) FROM ledger WHERE outcome <> 'none'))) AS at)"""


@query(QUEUE + f""", {CLOCK} SELECT bookmark, delivery, 'cancelled' AS reason, delivery + 1 AS next_delivery
FROM ledger WHERE outcome = 'cancel'
UNION ALL SELECT bookmark, delivery, 'lapsed', delivery + 1 FROM ledger, clock
WHERE outcome = 'none' AND delivered_at + INTERVAL 6 HOUR < clock.at""")
def stream_queue_redelivery(spark, d):
    judged = stream_queues.answered(*two_streams(spark, d), RULES.lease_s)
    return jobs.stored(stream_queues.again(judged), scratch_folder(spark, "queue"))


@query(HISTORY + f" SELECT bookmark, command, id, {CHANGED} AS delta FROM h WHERE command <> 'sow_delete'")
def stream_delta_subscribe(spark, d):
    return jobs.delta_stream(topics.event_parts(spark, d), FIELDS, scratch_folder(spark, "delta"))


POINT = 500


def behind_point(spark, d):
    """The records up to the point, and the messages behind it as a stream of an indexed topic, which opens
    no block of messages that ends before the point."""
    folder = scratch_folder(spark, "indexed")
    log = topics.event_log(spark, d).select(F.lit("all").alias("topic"), "bookmark", "ts", "command", *KEY, *FIELDS)
    last = log.agg(F.max("bookmark")).first()[0] or 0
    width = last // 5 + 1
    for part in range(5):
        indexed.append(log.filter(F.col("bookmark").between(part * width, (part + 1) * width - 1)), folder, width)
    records = state.state_at(indexed.read(spark, folder, log.schema, end=str(POINT)), KEY, FIELDS)
    return records, indexed.stream(spark, folder, log.schema, str(POINT), maxFilesPerTrigger="1")


def from_point(changes: str, columns: str) -> str:
    return HISTORY + f""" SELECT bookmark, 'sow' AS command, id, {columns} FROM ({sql_state(f"bookmark <= {POINT}")})
UNION ALL SELECT bookmark, command, id, {changes} FROM h WHERE bookmark > {POINT} AND command <> 'sow_delete'"""


@query(from_point("m_num, m_bid, m_ask, m_grp", "num, bid, ask, grp"))
def stream_sow_and_subscribe(spark, d):
    return jobs.snapshot_and_changes(*behind_point(spark, d), FIELDS, scratch_folder(spark, "sow-and-subscribe"))


@query(HISTORY + f""" SELECT bookmark, 'sow' AS command, id, num, bid, ask, grp
FROM ({sql_state(f"bookmark <= {POINT}")} ORDER BY id LIMIT 20)
UNION ALL SELECT bookmark, command, id, m_num, m_bid, m_ask, m_grp FROM h
WHERE bookmark > {POINT} AND command <> 'sow_delete'""")
def stream_sow_and_subscribe_topn(spark, d):
    return jobs.snapshot_and_changes(*behind_point(spark, d), FIELDS, scratch_folder(spark, "sow-top"), top=20)


@query(from_point(f"{CHANGED} AS delta", f"{WHOLE.replace('m_', '')} AS delta"))
def stream_sow_and_delta_subscribe(spark, d):
    return jobs.snapshot_and_changes(*behind_point(spark, d), FIELDS, scratch_folder(spark, "sow-and-delta"),
                                     as_deltas=True)


@query(HISTORY + """ SELECT bookmark, id, 'oof' AS command,
  CASE command WHEN 'sow_delete' THEN 'deleted' ELSE 'match' END AS reason
FROM h WHERE had AND p_bid > 20 AND (command = 'sow_delete' OR NOT coalesce(m_bid > 20, false))""")
def stream_oof(spark, d):
    return jobs.out_of_focus_stream(topics.event_parts(spark, d), FIELDS, "/bid > 20", scratch_folder(spark, "oof"))


@query(OOF_EXPIRING)
def stream_oof_expiry(spark, d):
    return jobs.out_of_focus_stream(topics.event_parts(spark, d), FIELDS, "/bid > 20",
                                    scratch_folder(spark, "oof-expiry"), expires=True)


@query(LOG + """, src AS (SELECT id AS grp, bookmark AS pos, 1 AS n,
  CAST(coalesce(CAST(bid AS DECIMAL(18,2)), 0) * 100 AS BIGINT) AS s FROM log)""" + CHANGELOG_SQL
       .format(pos="bookmark").replace("SELECT grp,", "SELECT grp AS id,")
       .replace("CAST(cs AS DOUBLE) AS sum_bid", "CAST(cs AS BIGINT) AS cents")
       .replace("CAST(ps AS DOUBLE)", "CAST(ps AS BIGINT)"))
def stream_changelog(spark, d):
    amount = F.coalesce((aggregate.exact("bid", "decimal(18,2)") * 100).cast("bigint"), F.lit(0).cast("bigint"))
    rows = topics.event_parts(spark, d).select(
        "id", "bookmark", F.lit(1).cast("bigint").alias("n"), amount.alias("cents"))
    return jobs.changelog_stream(rows, ["n", "cents"], scratch_folder(spark, "changelog"))


@query(f"""WITH RECURSIVE numbered AS (SELECT event_id AS bookmark, user_id AS id, {COIN_SQL} AS wants,
  row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM events),
walk AS (SELECT bookmark, id, i, 'publish' AS command FROM numbered WHERE i = 1
  UNION ALL SELECT n.bookmark, n.id, n.i, CASE WHEN w.command = 'sow_delete' THEN 'publish'
    WHEN n.wants THEN 'sow_delete' ELSE 'delta_publish' END
  FROM walk w JOIN numbered n ON n.id = w.id AND n.i = w.i + 1)
SELECT bookmark, id, command FROM walk""")
def stream_command_chooser(spark, d):
    rows = topics.event_parts(spark, d).select("id", "bookmark")
    return jobs.command_stream(rows, coin("bookmark"), scratch_folder(spark, "chooser"))


@query("SELECT event_id AS bookmark, user_id AS id, CAST(2 AS BIGINT) AS copies FROM events")
def at_least_once(spark, d):
    """A writer that lost its checkpoint sends everything again; the reader drops the copies."""
    folder = scratch_folder(spark, "at-least-once")
    stream = topics.event_parts(spark, d).select("topic", "bookmark", "id")
    for run in ("first", "again"):
        sinks.run_to_end(stream, checkpoint=f"{folder}/{run}", each=sinks.plain_append(f"{folder}/rows"))
    stored = spark.read.schema(stream.schema).parquet(f"{folder}/rows")
    copies = stored.groupBy("topic", "bookmark").agg(F.count("*").alias("copies"))
    return sequence.drop_replayed(stored, ["topic", "bookmark"]).join(
        copies, ["topic", "bookmark"]).select("bookmark", "id", "copies")


@query("SELECT event_type AS topic, event_id AS bookmark, user_id AS id FROM events")
def stream_dedup(spark, d):
    log = replayed(topics.event_parts(spark, d).select("topic", "bookmark", "ts", "id"))
    once = sequence.drop_replayed_stream(log, ["topic", "bookmark"], "ts", "1 hour")
    return jobs.copy_stream(once, scratch_folder(spark, "dedup")).drop("ts")
