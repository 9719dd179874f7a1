"""Publishing, upserts, merges, deletes, routing, expiry and delivery guarantees."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelog.functions import payload
from tidelog.operators import aggregate, changes, state, write
from tidelog.plans.registry import query
from tidelog.plans.sqltext import EXPIRING, HISTORY, LOG, state as sql_state
from tidelog.session import scratch_folder
from tidelog.sources import topics
from tidelog.streaming import sinks

KEY, FIELDS = ["id"], list(topics.FIELDS)
RECORD = ["id", *FIELDS, "bookmark"]
MID, MID_SQL = "2024-01-16 00:00:00", "TIMESTAMP '2024-01-16 00:00:00'"


def mid():
    return F.lit(MID).cast("timestamp")


@query(LOG + " SELECT topic, bookmark, ts, command, id, data FROM log")
def publish_append(spark, d):
    folder = scratch_folder(spark, "publish")
    columns = ["topic", "bookmark", "ts", "command", "id", "data"]
    rows = topics.event_log(spark, d).select(*columns)
    topics.append_topics(rows, folder)
    return topics.read_topics(spark, folder, rows.schema).select(*columns)


@query(LOG + " SELECT topic, bookmark, id, num, bid, ask, grp FROM log")
def publish_json(spark, d):
    folder = scratch_folder(spark, "publish-json")
    rows = topics.event_log(spark, d).select("topic", "bookmark", "id", *FIELDS)
    topics.append_topics(rows, folder, "json")
    return topics.read_topics(spark, folder, rows.schema, "json").select(rows.columns)


@query("""SELECT o_custkey AS customer, o_orderkey AS bookmark, o_totalprice AS price, o_orderstatus AS status
FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1""")
def upsert_latest(spark, d):
    return state.latest(topics.order_log(spark, d), ["customer"], ["customer", "price", "status"])


@query(HISTORY + " " + sql_state())
def delta_merge_state(spark, d):
    return state.state_at(topics.event_log(spark, d), KEY, FIELDS).select(*RECORD)


@query(HISTORY + """ SELECT bookmark, command, id, m_num AS num, m_bid AS bid, m_ask AS ask, m_grp AS grp
FROM m WHERE command <> 'sow_delete'""")
def delta_merge_stream(spark, d):
    return changes.merged_records(topics.event_log(spark, d), KEY, FIELDS)


@query(HISTORY + f""" SELECT id, grp, bookmark FROM ({sql_state()})""")
def sow_delete_data(spark, d):
    # the deleting message names its key only inside its payload
    log = topics.event_log(spark, d)
    keyed = payload.parse_json(log.select("bookmark", "ts", "command", "data"), topics.PAYLOAD_SCHEMA)
    keyed = keyed.select("bookmark", "ts", "command", "payload.*")
    return state.state_at(keyed, KEY, ["grp"]).select("id", "grp", "bookmark")


@query(HISTORY + f""" SELECT * FROM ({sql_state(f"ts < {MID_SQL}")})
WHERE id NOT IN (SELECT id FROM log WHERE topic = 'error' AND ts >= {MID_SQL}
  AND ts < {MID_SQL} + INTERVAL 1 DAY)""")
def sow_delete_key(spark, d):
    log = topics.event_log(spark, d)
    deletions = log.filter((F.col("topic") == "error") & (F.col("ts") >= mid())
                           & (F.col("ts") < mid() + F.expr("INTERVAL 1 DAY"))).select(
        F.col("sow_key").cast("bigint").alias("id"))
    return state.delete_keys(state.state_at(log, KEY, FIELDS, upto=F.col("ts") < mid()),
                             deletions, KEY).select(*RECORD)


# The records that match at the middle are gone: their keys start over with the rows behind it.
@query(HISTORY + f""", doomed AS (SELECT id FROM ({sql_state(f"ts < {MID_SQL}")}) WHERE bid > 10),
left_over AS (SELECT * FROM log WHERE ts >= {MID_SQL} OR id NOT IN (SELECT id FROM doomed))"""
       + HISTORY[len(LOG):].replace("FROM log", "FROM left_over").replace("epochs", "epochs2")
       .replace("m AS (", "m2 AS (").replace("FROM m WINDOW", "FROM m2 WINDOW").replace("h AS (", "h2 AS (")
       + " " + sql_state().replace("FROM m ", "FROM m2 "))
def sow_delete_filter(spark, d):
    log = topics.event_log(spark, d)
    return state.delete_where(log, KEY, FIELDS, "/bid > 10", F.col("ts") < mid()).select(*RECORD)


@query(HISTORY.replace("user_id AS id,", "user_id AS id, CASE WHEN event_id % 10 = 0 THEN 'fixed' "
                       "ELSE CAST(user_id AS VARCHAR) END AS key,", 1).replace("PARTITION BY id", "PARTITION BY key")
       + """ SELECT key, id, m_bid AS bid, bookmark FROM (SELECT *,
  row_number() OVER (PARTITION BY key ORDER BY bookmark DESC) AS rn FROM m) WHERE rn = 1 AND command <> 'sow_delete'""")
def explicit_key(spark, d):
    log = topics.event_log(spark, d)
    own = F.when(F.col("num") % 10 == 0, "fixed")
    keyed = log.withColumn("key", F.coalesce(own, F.col("sow_key")))
    return state.state_at(keyed, ["key"], ["id", "bid"])


# Rows without a command of their own are published.
@query(HISTORY.replace("FROM events)", "FROM events WHERE event_type <> 'signup' "
                       "UNION ALL SELECT 'signup', event_id, ts, 'publish', user_id, event_id, value, "
                       "CAST(json_extract(props, '$.k') AS DOUBLE), 'signup', false, '', '', 0, '' "
                       "FROM events WHERE event_type = 'signup')", 1)
       + " SELECT command, id, bookmark FROM log UNION ALL SELECT 'live', id, bookmark FROM (" + sql_state() + ")")
def per_row_command(spark, d):
    log = topics.event_log(spark, d)
    own = F.when(F.col("topic") != "signup", F.col("command"))
    sent = write.outgoing(log, F.col("data"), topic="any", overrides={"command": own})
    live = state.state_at(sent, KEY, FIELDS).select(F.lit("live").alias("command"), "id", "bookmark")
    return sent.select("command", "id", "bookmark").unionByName(live)


@query(LOG + """ SELECT CASE WHEN bid > ask THEN 'falling' ELSE 'rising' END AS topic, bookmark, bid, ask
FROM log""")
def topic_routing(spark, d):
    folder = scratch_folder(spark, "routing")
    rows = topics.event_log(spark, d).select("bookmark", "bid", "ask")
    routed = write.route(rows, F.col("bid") > F.col("ask"), "falling", "rising")
    topics.append_topics(routed, folder)
    return topics.read_topics(spark, folder, routed.schema).select("topic", "bookmark", "bid", "ask")


@query(EXPIRING + """, last AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY bookmark DESC) AS rn FROM m)
SELECT id, m_num AS num, m_bid AS bid, m_ask AS ask, m_grp AS grp, bookmark, ts AS last_ts FROM last
WHERE rn = 1 AND command <> 'sow_delete' AND (expiration_s IS NULL
  OR ts + INTERVAL 1 SECOND * expiration_s > TIMESTAMP '2024-02-01 00:00:00')""")
def sow_expiry(spark, d):
    now = F.lit("2024-02-01 00:00:00").cast("timestamp")
    records = state.with_expiry(topics.event_log(spark, d), KEY, FIELDS, now)
    return records.filter("NOT expired").drop("expired")


# A first run sends what came before the middle; a second run, without the first one's checkpoint, gets
# everything again and writes to the same table.
@query("SELECT event_id AS bookmark, user_id % 4 AS writer, epoch_us(ts) AS micros FROM events")
def exactly_once_resume(spark, d):
    folder = scratch_folder(spark, "exactly-once")

    def rows(log):
        return log.select("bookmark", F.pmod("id", F.lit(4)).alias("writer"), F.unix_micros("ts").alias("micros"))

    log = topics.event_parts(spark, d)
    schema = rows(log).schema
    for run, part in (("first", F.col("ts") < mid()), ("second", F.lit(True))):
        sent = sinks.read_batches(spark, f"{folder}/rows", schema) if run == "second" else None
        marks = None if sent is None else write.high_water(sent, "writer", "micros")
        sinks.publish_stream(rows(log.filter(part)), f"{folder}/rows", f"{folder}/{run}", sinks.EXACTLY_ONCE,
                             writer="writer", ts="micros", marks=marks)
    return sinks.read_batches(spark, f"{folder}/rows", schema).select("bookmark", "writer", "micros")


@query(LOG + " SELECT topic, count(*) AS records, CAST(sum(strlen(data)) AS BIGINT) AS bytes FROM log GROUP BY topic")
def io_metrics(spark, d):
    return aggregate.io_metrics(topics.event_log(spark, d))


# A -> B -> C: B changes the text, C adds the group; each is a topic folder of its own.
@query(LOG + """ SELECT bookmark, replace(data, '"grp":"' || grp || '"', '"grp":"copied"') AS data,
  id % 9 + 1 AS grp FROM log""")
def mirror_chain(spark, d):
    folder = scratch_folder(spark, "mirror")
    first = topics.event_log(spark, d).select(F.lit("b").alias("topic"), "bookmark", "id",
                                              payload.replace_json_field("data", "grp", "copied").alias("data"))
    topics.append_topics(first, folder)
    second = topics.read_topics(spark, folder, first.schema).filter(F.col("topic") == "b").withColumns(
        {"topic": F.lit("c"), "grp": F.col("id") % 9 + 1})
    topics.append_topics(second, f"{folder}-second")
    return topics.read_topics(spark, f"{folder}-second", second.schema).select("bookmark", "data", "grp")


# Broken rows: no topic, an unknown command, a bad correlation id, a payload cut short.  The good ones are
# written to their topics, the others, with the reason, to a table beside them; both are read again.
@query(LOG + """ SELECT num, coalesce(CASE WHEN num % 11 = 0 THEN 'no topic' WHEN num % 13 = 0 THEN 'unknown command'
  WHEN num % 17 = 0 THEN 'bad correlation id'
  WHEN num % 19 = 0 AND command <> 'sow_delete' THEN 'bad payload' END, 'written') AS reject FROM log""")
def reject_rows(spark, d):
    n = F.col("num")
    rows = topics.event_log(spark, d).select(
        "num", F.when(n % 11 != 0, F.col("topic")).alias("topic"),
        F.when(n % 13 == 0, "no such").otherwise(F.col("command")).alias("command"),
        F.when(n % 17 == 0, "not/base 64!").otherwise(F.col("correlation_id")).alias("correlation_id"),
        F.when(n % 19 == 0, F.expr("left(data, 9)")).otherwise(F.col("data")).alias("data"))
    folder = scratch_folder(spark, "rejects")
    good, bad = write.split_rejects(rows, payload.json_or_null("data", topics.PAYLOAD_SCHEMA))
    topics.append_topics(good, f"{folder}/topics")
    bad.write.parquet(f"{folder}/rejects")
    written = topics.read_topics(spark, f"{folder}/topics", good.schema).select("num", F.lit("written").alias("reject"))
    return written.unionByName(spark.read.schema(bad.schema).parquet(f"{folder}/rejects").select("num", "reject"))
