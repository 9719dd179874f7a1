"""Replays, splits, filters and keyed-state reads."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelog.operators import changes, read, state
from tidelog.operators.command import TopicRead
from tidelog.operators.read import Split
from tidelog.plans.registry import query
from tidelog.plans.sqltext import (CHANGED, EXPIRING, HISTORY, LOG, OOF_EXPIRING, WHOLE, crc32,
                                   state as sql_state)
from tidelog.sources import topics

KEY, FIELDS = ["id"], list(topics.FIELDS)
RECORD = ["id", *FIELDS, "bookmark"]

# The middle of the given event times: a snapshot point for reads that need one.
CUT_TEXT, CUT_SQL = "20240116T000000.000000Z", "TIMESTAMP '2024-01-16 00:00:00'"


def cut():
    return F.col("ts") < F.lit("2024-01-16 00:00:00").cast("timestamp")


@query(LOG + f" SELECT topic, bookmark, ts, id, bid FROM log WHERE topic = 'purchase' AND ts >= {CUT_SQL}")
def subscribe_live(spark, d):
    log = topics.event_log(spark, d)
    return read.subscribe(log, ["purchase"], start=CUT_TEXT).select("topic", "bookmark", "ts", "id", "bid")


@query(LOG + " SELECT topic, bookmark, ts, command, id FROM log")
def bookmark_replay(spark, d):
    return read.subscribe(topics.event_log(spark, d), start="0").select(
        "topic", "bookmark", "ts", "command", "id")


@query(LOG + " SELECT topic, bookmark, ts, command, id FROM log WHERE ts >= TIMESTAMP '2024-01-10 12:30:00'")
def bookmark_from_ts(spark, d):
    return read.subscribe(topics.event_log(spark, d), start="20240110T123000.000000Z").select(
        "topic", "bookmark", "ts", "command", "id")


@query("SELECT o_orderkey AS bookmark, o_orderdate AS ts, o_totalprice AS price FROM orders "
       "WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1996-07-01'")
def bookmark_range_open(spark, d):
    log = topics.order_log(spark, d)
    return read.subscribe(log, start="[19960101T000000:19960701T000000)").select("bookmark", "ts", "price")


@query("SELECT o_orderkey AS bookmark, o_orderdate AS ts, o_totalprice AS price FROM orders "
       "WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1996-07-01'")
def bookmark_range_closed(spark, d):
    log = topics.order_log(spark, d)
    return read.subscribe(log, start="[19960101T000000:19960701T000000]").select("bookmark", "ts", "price")


@query(LOG + f" SELECT bookmark, ts, topic, id FROM log WHERE ts >= {CUT_SQL} ORDER BY bookmark LIMIT 100")
def replay_topn(spark, d):
    log = read.subscribe(topics.event_log(spark, d), start=CUT_TEXT)
    return read.replay_top(log, 100).select("bookmark", "ts", "topic", "id")


@query(LOG + """ SELECT topic AS split_id, bookmark, id, rn FROM (
  SELECT *, row_number() OVER (PARTITION BY topic ORDER BY bookmark) AS rn FROM log) WHERE rn <= 50""")
def split_topn(spark, d):
    log = topics.event_log(spark, d).withColumn("split_id", F.col("topic"))
    return read.top_per_split(log, 50).select("split_id", "bookmark", "id", "rn")


@query(LOG + """ SELECT topic, bookmark,
  (row_number() OVER (PARTITION BY topic ORDER BY bookmark) - 1) // 20 AS emit_second FROM log""")
def replay_rate_schedule(spark, d):
    log = topics.event_log(spark, d).select("topic", "bookmark")
    return read.rate_schedule(log, 20)


@query(HISTORY + " " + sql_state())
def sow_latest(spark, d):
    return state.state_at(topics.event_log(spark, d), KEY, FIELDS).select(*RECORD)


@query(HISTORY + f" SELECT * FROM ({sql_state()}) WHERE bid > 20 AND ask < 60")
def sow_filtered(spark, d):
    return state.state_at(topics.event_log(spark, d), KEY, FIELDS,
                          content_filter="/bid > 20 AND /ask < 60").select(*RECORD)


@query(HISTORY + f" SELECT * FROM ({sql_state()}) ORDER BY bid DESC, id")
def sow_order_by(spark, d):
    records = state.state_at(topics.event_log(spark, d), KEY, FIELDS)
    return records.orderBy(F.col("bid").desc(), "id").select(*RECORD)


@query(HISTORY + f" SELECT * FROM ({sql_state()}) ORDER BY id LIMIT 25")
def sow_topn(spark, d):
    return state.page(state.state_at(topics.event_log(spark, d), KEY, FIELDS), KEY, 25).select(*RECORD)


@query(HISTORY + f" SELECT * FROM ({sql_state()}) ORDER BY id LIMIT 20 OFFSET 10")
def sow_page(spark, d):
    return state.page(state.state_at(topics.event_log(spark, d), KEY, FIELDS), KEY, 20, 10).select(*RECORD)


@query(HISTORY + f" {sql_state(f'ts < {CUT_SQL}')}")
def sow_as_of(spark, d):
    return state.state_at(topics.event_log(spark, d), KEY, FIELDS, upto=cut()).select(*RECORD)


@query(HISTORY + """, grid AS (
  SELECT TIMESTAMP '2024-01-10 00:00:00' + INTERVAL 36 HOUR * i AS grid_ts FROM range(8) t(i)),
at_point AS (SELECT m.*, grid_ts, row_number() OVER (PARTITION BY id, grid_ts ORDER BY bookmark DESC) AS rn
  FROM m JOIN grid ON m.ts <= grid_ts)
SELECT id, m_num AS num, m_bid AS bid, m_ask AS ask, m_grp AS grp, bookmark, grid_ts
FROM at_point WHERE rn = 1 AND command <> 'sow_delete'""")
def sow_history_grid(spark, d):
    return state.history_grid(topics.event_log(spark, d), KEY, FIELDS, points=8, step_s=36 * 3600,
                              start=F.lit("2024-01-10 00:00:00").cast("timestamp"))


def snapshot_then_changes(snapshot: str) -> str:
    return HISTORY + f""", parts AS (
  SELECT 'sow' AS command, id, num, bid, ask, grp, bookmark FROM ({snapshot})
  UNION ALL SELECT command, id, m_num, m_bid, m_ask, m_grp, bookmark FROM m
  WHERE NOT ts < {CUT_SQL} AND command <> 'sow_delete')
SELECT bookmark, command, id, num, bid, ask, grp FROM parts"""


@query(snapshot_then_changes(sql_state(f"ts < {CUT_SQL}")) + " WHERE bid > 5")
def sow_and_subscribe(spark, d):
    return changes.sow_and_subscribe(topics.event_log(spark, d), KEY, FIELDS, cut(),
                                     content_filter="/bid > 5")


@query(snapshot_then_changes(sql_state(f"ts < {CUT_SQL}") + " ORDER BY id LIMIT 30"))
def sow_and_subscribe_topn(spark, d):
    return changes.sow_and_subscribe(topics.event_log(spark, d), KEY, FIELDS, cut(), top=30)


@query(HISTORY + f""" SELECT 0 :: BIGINT AS seq, 'group_begin' AS command, NULL :: VARCHAR AS label
UNION ALL SELECT 2, 'group_end', NULL
UNION ALL SELECT 1, 'sow', 'SOW: ' || id || ' at ' || bookmark FROM ({sql_state()})""")
def sow_markers(spark, d):
    records = state.state_at(topics.event_log(spark, d), KEY, FIELDS)
    return changes.snapshot_with_markers(
        records, F.concat(F.lit("SOW: "), "id", F.lit(" at "), "bookmark"))


@query(HISTORY + f" SELECT bookmark, command, id, {CHANGED} AS delta FROM h "
       f"WHERE command <> 'sow_delete' AND NOT ts < {CUT_SQL}")
def delta_subscribe(spark, d):
    return changes.delta_subscribe(topics.event_log(spark, d), KEY, FIELDS, since=~cut())


@query(HISTORY + f""" SELECT bookmark, command, id, {CHANGED} AS delta FROM h
WHERE command <> 'sow_delete' AND NOT ts < {CUT_SQL}
UNION ALL SELECT bookmark, 'sow', id, {WHOLE.replace('m_', '')} FROM ({sql_state(f'ts < {CUT_SQL}')})""")
def sow_and_delta_subscribe(spark, d):
    return changes.sow_and_delta_subscribe(topics.event_log(spark, d), KEY, FIELDS, cut())


@query(HISTORY + """ SELECT bookmark, id, 'oof' AS command,
  CASE command WHEN 'sow_delete' THEN 'deleted' ELSE 'match' END AS reason
FROM h WHERE had AND p_bid > 20 AND (command = 'sow_delete' OR NOT coalesce(m_bid > 20, false))""")
def oof_events(spark, d):
    return changes.out_of_focus(topics.event_log(spark, d), KEY, FIELDS, "/bid > 20")


@query(OOF_EXPIRING)
def oof_with_expiry(spark, d):
    return changes.out_of_focus(topics.event_log(spark, d), KEY, FIELDS, "/bid > 20", expires=True)


@query(EXPIRING + f" SELECT bookmark, command, id, {CHANGED.replace('NOT had', 'NOT had OR lapsed')} AS delta FROM h "
       f"WHERE command <> 'sow_delete' AND NOT ts < {CUT_SQL}")
def delta_subscribe_expiry(spark, d):
    return changes.delta_subscribe(topics.event_log(spark, d), KEY, FIELDS, since=~cut(), expires=True)


@query(EXPIRING + """, grid AS (
  SELECT TIMESTAMP '2024-01-10 00:00:00' + INTERVAL 36 HOUR * i AS grid_ts FROM range(8) t(i)),
at_point AS (SELECT m.*, grid_ts, row_number() OVER (PARTITION BY id, grid_ts ORDER BY bookmark DESC) AS rn
  FROM m JOIN grid ON m.ts <= grid_ts)
SELECT id, m_num AS num, m_bid AS bid, m_ask AS ask, m_grp AS grp, bookmark, grid_ts FROM at_point
WHERE rn = 1 AND command <> 'sow_delete' AND (expiration_s IS NULL OR ts + INTERVAL 1 SECOND * expiration_s > grid_ts)""")
def sow_history_expiry(spark, d):
    return state.history_grid(topics.event_log(spark, d), KEY, FIELDS, points=8, step_s=36 * 3600,
                              start=F.lit("2024-01-10 00:00:00").cast("timestamp"), expires=True)


@query(EXPIRING + """ SELECT grp, sum(ask) AS sum_ask, sum(bid) AS sum_bid, count(id) AS n
FROM (SELECT id, m_bid AS bid, m_ask AS ask, m_grp AS grp, row_number() OVER (PARTITION BY id ORDER BY bookmark DESC) AS rn,
  command, ts, expiration_s FROM m) WHERE rn = 1 AND command <> 'sow_delete' AND (expiration_s IS NULL
  OR ts + INTERVAL 1 SECOND * expiration_s > (SELECT date_trunc('milliseconds', max(ts)) FROM log)) GROUP BY grp"""
       .replace("sum(ask)", "round(sum(ask), 5)").replace("sum(bid)", "round(sum(bid), 5)"))
def sow_view_expiry(spark, d):
    records = state.state_at(topics.event_log(spark, d), KEY, FIELDS, expires=True)
    view = state.grouped_view(records)
    return view.withColumns({c: F.round(c, 5) for c in ("sum_ask", "sum_bid")})


@query(EXPIRING + """, last AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY bookmark DESC) AS rn FROM m)
SELECT bookmark, id, 'oof' AS command, 'expired' AS reason FROM last
WHERE rn = 1 AND command <> 'sow_delete' AND m_bid > 20
  AND ts + INTERVAL 1 SECOND * expiration_s <= TIMESTAMP '2024-02-01'""")
def oof_expired(spark, d):
    return changes.expired_out_of_focus(topics.event_log(spark, d), KEY, FIELDS, "/bid > 20",
                                        F.lit("2024-02-01").cast("timestamp"))


# The read command as one value: each command with a filter, splits and, but for deltas, a limit per split.
SPLITS = {"low": Split(content_filter="/bid < 20"), "high": Split(content_filter="/bid >= 20")}


def per_split(records: str) -> str:
    return f"""SELECT 'low' AS split_id, * FROM ({records}) WHERE bid < 20 AND ask > 30
  UNION ALL SELECT 'high', * FROM ({records}) WHERE bid >= 20 AND ask > 30"""


def command_read(spark, d, command: str, **more):
    topic_read = TopicRead(KEY, FIELDS, command, topic="all", bookmark=CUT_TEXT, content_filter="/ask > 30",
                           splits=SPLITS, **more)
    return topic_read.run(topics.event_log(spark, d).withColumn("topic", F.lit("all")))


@query(HISTORY + f""", records AS ({sql_state(f"ts <= {CUT_SQL}")}), parts AS ({per_split("SELECT * FROM records")})
SELECT split_id, id, num, bid, ask, grp, bookmark FROM parts
QUALIFY row_number() OVER (PARTITION BY split_id ORDER BY bid DESC, id) BETWEEN 4 AND 13""")
def read_command(spark, d):
    return command_read(spark, d, "sow", order_by="/bid DESC", top_n=10, skip_n=3).select("split_id", *RECORD)


@query(LOG + f""", parts AS ({per_split(f"SELECT * FROM log WHERE ts >= {CUT_SQL}")})
SELECT split_id, bookmark, id FROM parts
QUALIFY row_number() OVER (PARTITION BY split_id ORDER BY bookmark) <= 40""")
def read_command_replay(spark, d):
    return command_read(spark, d, "subscribe", top_n=40).select("split_id", "bookmark", "id")


LATER_SQL = f"""later AS (SELECT bookmark, command, id, m_num AS num, m_bid AS bid, m_ask AS ask, m_grp AS grp,
  {{delta}} AS delta FROM h WHERE NOT ts <= {CUT_SQL} AND command <> 'sow_delete')"""
SNAPSHOT_SQL = f""", records AS ({sql_state(f"ts <= {CUT_SQL}")}),
top AS (SELECT * FROM ({per_split("SELECT * FROM records")})
  QUALIFY row_number() OVER (PARTITION BY split_id ORDER BY bid DESC, id) <= 10), """


@query(HISTORY + SNAPSHOT_SQL + LATER_SQL.format(delta="''") + f""", moved AS ({per_split("SELECT * FROM later")})
SELECT split_id, bookmark, 'sow' AS command, id, num, bid, ask, grp FROM top
UNION ALL SELECT split_id, bookmark, command, id, num, bid, ask, grp FROM moved""")
def read_command_sow_and_subscribe(spark, d):
    out = command_read(spark, d, "sow_and_subscribe", order_by="/bid DESC", top_n=10)
    return out.select("split_id", "bookmark", "command", *KEY, *FIELDS)


@query(HISTORY + ", " + LATER_SQL.format(delta=CHANGED) + f""", moved AS ({per_split("SELECT * FROM later")})
SELECT split_id, bookmark, command, id, delta FROM moved""")
def read_command_delta_subscribe(spark, d):
    return command_read(spark, d, "delta_subscribe").select("split_id", "bookmark", "command", "id", "delta")


@query(HISTORY + SNAPSHOT_SQL + LATER_SQL.format(delta=CHANGED) + f""", moved AS ({per_split("SELECT * FROM later")})
SELECT split_id, bookmark, 'sow' AS command, id, {WHOLE.replace("m_", "")} AS delta FROM top
UNION ALL SELECT split_id, bookmark, command, id, delta FROM moved""")
def read_command_sow_and_delta_subscribe(spark, d):
    out = command_read(spark, d, "sow_and_delta_subscribe", order_by="/bid DESC", top_n=10)
    return out.select("split_id", "bookmark", "command", "id", "delta")


@query(LOG + " SELECT topic, bookmark, id FROM log WHERE topic IN ('purchase', 'view')")
def multi_topic(spark, d):
    return read.subscribe(topics.event_log(spark, d), ["purchase", "view"]).select("topic", "bookmark", "id")


@query("SELECT event_id AS num, event_id % 4 AS split FROM events")
def split_mod(spark, d):
    return read.shard(topics.event_log(spark, d), F.col("num"), 4).select("num", "split")


@query(f"SELECT event_id AS bookmark, user_id AS id, {crc32('CAST(user_id AS VARCHAR)')} % 4 AS split FROM events")
def split_crc32(spark, d):
    return read.shard_by_hash(topics.event_log(spark, d), F.col("id"), 4).select("bookmark", "id", "split")


@query("SELECT 'even' AS split_id, event_id AS bookmark FROM events WHERE event_id % 2 = 0 "
       "UNION ALL SELECT 'third', event_id FROM events WHERE event_id % 3 = 0 "
       "UNION ALL SELECT 'all', event_id FROM events")
def split_overlap_bag(spark, d):
    splits = {"even": Split(content_filter="/num MOD 2 = 0"),
              "third": Split(content_filter="/num MOD 3 = 0"), "all": Split()}
    return read.read_splits(topics.event_log(spark, d), splits).select("split_id", "bookmark")


@query(LOG + f""" SELECT 'own start' AS split_id, bookmark, topic FROM log
  WHERE topic = 'view' AND ts >= TIMESTAMP '2024-01-25'
UNION ALL SELECT 'source start', bookmark, topic FROM log WHERE topic = 'signup' AND ts >= {CUT_SQL}
UNION ALL SELECT 'source topic', bookmark, topic FROM log
  WHERE topic = 'purchase' AND bid > 10 AND ts >= {CUT_SQL}""")
def split_overrides(spark, d):
    splits = {"own start": Split("view", bookmark="20240125T000000.000000Z"),
              "source start": Split("signup"), "source topic": Split(content_filter="/bid > 10")}
    return read.read_splits(topics.event_log(spark, d), splits, topic="purchase",
                            bookmark=CUT_TEXT).select("split_id", "bookmark", "topic")


@query(LOG + f""", points AS (SELECT topic, max(bookmark) AS last FROM log WHERE ts < {CUT_SQL} GROUP BY topic)
SELECT log.topic AS split_id, bookmark, ts FROM log JOIN points ON log.topic = points.topic
WHERE bookmark > last""")
def resume_points(spark, d):
    log = topics.event_log(spark, d).withColumn("split_id", F.col("topic"))
    points = log.filter(cut()).groupBy("split_id").agg(F.max("bookmark").alias("last_bookmark"))
    return read.resume(log.select("split_id", "bookmark", "ts"), points)


@query(LOG + " SELECT bookmark, id, bid, topic FROM log WHERE bid > 10 AND num % 2 = 0 AND topic = 'view'")
def content_filter(spark, d):
    return read.subscribe(topics.event_log(spark, d),
                          content_filter="/bid > 10 AND /num MOD 2 = 0 AND /grp = 'view'").select(
        "bookmark", "id", "bid", "topic")


@query(LOG + " SELECT 'both' AS split_id, bookmark FROM log WHERE bid > 10 AND num % 2 = 0 "
       "UNION ALL SELECT 'source only', bookmark FROM log WHERE bid > 10")
def filter_and_split(spark, d):
    splits = {"both": Split(content_filter="/num MOD 2 = 0"), "source only": Split()}
    return read.read_splits(topics.event_log(spark, d), splits, source_filter="/bid > 10").select(
        "split_id", "bookmark")


@query("SELECT o_orderkey AS id, o_orderstatus AS name, c_name AS username "
       "FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey > 10")
def nested_filter(spark, d):
    orders = topics.nested_orders(spark, d)
    return orders.filter(read.predicate("/buyer/num > 10")).select("id", "name", "buyer.username")


@query(LOG + " SELECT bookmark, command FROM log WHERE command IN ('publish', 'delta_publish', 'oof', 'sow')")
def command_filter(spark, d):
    return read.data_messages(topics.event_log(spark, d)).select("bookmark", "command")
