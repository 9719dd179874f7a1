"""Payload parsing, writing and per-row projections."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import functions as F

from tidelog.functions import custom, payload
from tidelog.operators import changes, read
from tidelog.operators.aggregate import price_measures
from tidelog.operators.write import outgoing
from tidelog.plans.registry import query
from tidelog.plans.sqltext import HISTORY, LOG, state as sql_state
from tidelog.sources import synthetic, topics

FIELDS = list(topics.FIELDS)


@query(LOG + " SELECT bookmark, data FROM log")
def raw_string(spark, d):
    return topics.event_log(spark, d).select("bookmark", F.col("data").cast("string").alias("data"))


@query(LOG + " SELECT bookmark, id, num, bid, ask, grp FROM log")
def json_parse(spark, d):
    messages = topics.event_log(spark, d).select("bookmark", "data")
    return payload.parse_json(messages, topics.PAYLOAD_SCHEMA).select("bookmark", "payload.*")


@query(LOG + " SELECT bookmark, id, coalesce(bid, 0) AS bid, coalesce(ask, 0) AS ask, grp FROM log")
def json_defaults(spark, d):
    messages = topics.event_log(spark, d).select("bookmark", "data")
    parsed = payload.parse_json(messages, topics.PAYLOAD_SCHEMA)
    return parsed.select("bookmark", *payload.with_defaults(
        "payload", {"id": 0, "bid": 0.0, "ask": 0.0, "grp": ""}))


NESTED_JSON = """'{"id":' || o_orderkey || ',"name":"' || o_orderstatus || '","itemId":' || o_custkey
  || ',"buyer":{"str":"' || c_mktsegment || '","username":"' || c_name
  || '","num":' || c_nationkey || '}}'"""


@query(f"""SELECT o_orderkey AS id, CAST(c_nationkey AS BIGINT) AS buyer_num, c_name AS buyer_name,
  {NESTED_JSON} AS data FROM orders JOIN customer ON o_custkey = c_custkey""")
def json_nested(spark, d):
    written = topics.nested_orders(spark, d).select(
        payload.to_json_text("id", "name", "itemId", "buyer").alias("data"))
    parsed = payload.parse_json(written, topics.ORDER_SCHEMA)
    return parsed.select("payload.id", F.col("payload.buyer.num").alias("buyer_num"),
                         F.col("payload.buyer.username").alias("buyer_name"), "data")


@query("""SELECT event_id AS bookmark, '{"id":' || user_id || ',"data":"' || event_type || '"}' AS data
FROM events""")
def json_write(spark, d):
    log = topics.event_log(spark, d)
    return log.select("bookmark", payload.to_json_text("id", F.col("grp").alias("data")).alias("data"))


@query(HISTORY + f""", messages AS (
  SELECT 'group_begin' AS command, NULL AS id, NULL AS bookmark UNION ALL SELECT 'group_end', NULL, NULL
  UNION ALL SELECT 'sow', id, bookmark FROM ({sql_state("ts < TIMESTAMP '2024-01-16'")})
  UNION ALL SELECT command, id, bookmark FROM m WHERE ts >= TIMESTAMP '2024-01-16' AND command <> 'sow_delete')
SELECT CASE command WHEN 'group_begin' THEN 'snapshot begins' WHEN 'group_end' THEN 'snapshot ends'
  WHEN 'sow' THEN 'snapshot: ' || id WHEN 'publish' THEN 'publish: ' || id
  ELSE 'unexpected ' || command END AS label, coalesce(bookmark, -1) AS bookmark FROM messages
UNION ALL SELECT 'pair ' || part, bookmark FROM messages, range(2) t(part) WHERE command = 'publish'""")
def labelled_messages(spark, d):
    cut = F.col("ts") < F.lit("2024-01-16 00:00:00").cast("timestamp")
    log = topics.event_log(spark, d)
    messages = changes.sow_and_subscribe(log, ["id"], FIELDS, cut).select("command", "id", "bookmark")
    ends = spark.createDataFrame([("group_begin",), ("group_end",)], "command STRING")
    messages = messages.unionByName(ends, allowMissingColumns=True)
    command = F.col("command")
    label = (F.when(command == "group_begin", "snapshot begins")
             .when(command == "group_end", "snapshot ends")
             .when(command == "sow", F.concat(F.lit("snapshot: "), "id"))
             .when(command == "publish", F.concat(F.lit("publish: "), "id"))
             .otherwise(F.concat(F.lit("unexpected "), "command")))
    # a message may give any number of rows: a publish gives three, the rest one
    labels = F.when(command == "publish", F.array(label, F.lit("pair 0"), F.lit("pair 1"))).otherwise(
        F.array(label))
    return messages.select(F.explode(labels).alias("label"), F.coalesce("bookmark", F.lit(-1)).alias("bookmark"))


class Labels:
    """A deserializer of one's own: a purchase gives two rows, an error none, any other message one."""

    def eval(self, topic, key):
        if topic == "purchase":
            yield f"bought by {key}", 0
            yield f"billed to {key}", 1
        elif topic != "error":
            yield f"{topic} of {key}", 0


@query(LOG + """ SELECT bookmark, 'bought by ' || id AS label, 0 :: BIGINT AS part FROM log WHERE topic = 'purchase'
UNION ALL SELECT bookmark, 'billed to ' || id, 1 FROM log WHERE topic = 'purchase'
UNION ALL SELECT bookmark, topic || ' of ' || id, 0 FROM log WHERE topic NOT IN ('purchase', 'error')""")
def message_table_function(spark, d):
    log = topics.event_log(spark, d).select("bookmark", "topic", "id")
    return custom.message_rows(log, Labels, "label STRING, part BIGINT", ["topic", "id"]).select("bookmark", "label", "part")


@query(LOG + """ SELECT bookmark, '{"id":' || id || ',"grp":"' || grp || '"}' AS data,
  CASE WHEN flag THEN 'purchases' ELSE 'other' END AS topic,
  CASE WHEN topic = 'error' THEN 'sow_delete' ELSE 'publish' END AS command,
  coalesce(correlation_id, 'none') AS correlation_id, sow_key,
  CAST(coalesce(expiration_s, 60) AS BIGINT) AS expiration_s FROM log""")
def serialize_row(spark, d):
    log = topics.event_log(spark, d).withColumnRenamed("topic", "source")
    return outgoing(
        log, payload.to_json_text("id", "grp"), topic="other", correlation_id="none", expiration_s=60,
        overrides={"topic": F.when(F.col("flag"), "purchases"),
                   "command": F.when(F.col("source") == "error", topics.SOW_DELETE),
                   "sow_key": F.col("sow_key"), "correlation_id": F.col("correlation_id"),
                   "expiration_s": F.col("expiration_s")},
    ).select("bookmark", "data", "topic", "command", "correlation_id", "sow_key", "expiration_s")


@query(LOG + """ SELECT bookmark, command AS header_command, topic AS header_topic, sow_key AS header_sow_key,
  strftime(ts, '%Y%m%dT%H%M%S.%fZ') AS header_timestamp, correlation_id AS header_correlation_id,
  CAST(NULL AS VARCHAR) AS header_subscription_id, CAST(strlen(data) AS BIGINT) AS header_length FROM log""")
def headers(spark, d):
    log = topics.event_log(spark, d)
    known = {"COMMAND": F.col("command"), "TOPIC": F.col("topic"), "SOW_KEY": F.col("sow_key"),
             "TIMESTAMP": payload.broker_time_text("ts"), "BOOKMARK": F.col("bookmark"),
             "CORRELATION_ID": F.col("correlation_id"), "LENGTH": payload.payload_length()}
    wanted = ["COMMAND", "TOPIC", "SOW_KEY", "TIMESTAMP", "CORRELATION_ID", "SUBSCRIPTION_ID", "LENGTH"]
    return read.headers(log, known, wanted).select("bookmark", *[f"header_{k.lower()}" for k in wanted])


@query("SELECT event_id AS bookmark, epoch_us(ts) // 1000 AS millis, date_trunc('millisecond', ts) AS ts "
       "FROM events")
def event_time_millis(spark, d):
    stamped = topics.event_log(spark, d).select("bookmark", payload.broker_time_text("ts").alias("text"))
    return stamped.select("bookmark", payload.parse_broker_time("text").alias("ts")).withColumn(
        "millis", F.unix_millis("ts"))


@query(LOG + """ SELECT bookmark, replace(data, '"grp":"' || grp || '"', '"grp":"modified"') AS data FROM log""")
def field_replace(spark, d):
    return topics.event_log(spark, d).select(
        "bookmark", payload.replace_json_field("data", "grp", "modified").alias("data"))


@query(LOG + " SELECT bookmark, split_part(data, ',', 1) AS head FROM log")
def first_part(spark, d):
    return topics.event_log(spark, d).select("bookmark", payload.first_part("data").alias("head"))


@query(LOG + """ SELECT bookmark, grp || CAST(trunc(bid + ask) AS BIGINT) AS correlation_id, 'd' AS data FROM log""")
def correlation_id(spark, d):
    """A message without one of its prices has no correlation id of its own: null."""
    return topics.event_log(spark, d).select(
        "bookmark", F.lit("d").alias("data"),
        F.concat("grp", (F.col("bid") + F.col("ask")).cast("int")).alias("correlation_id"))


@query(LOG + """ SELECT bookmark, coalesce(correlation_id, 'ZGVmYXVsdA==') AS correlation_id,
  regexp_full_match(coalesce(correlation_id, 'ZGVmYXVsdA=='), '[A-Za-z0-9+/=]*') AS valid FROM log""")
def correlation_default(spark, d):
    sent = outgoing(topics.event_log(spark, d), F.col("data"), topic="any",
                    correlation_id="ZGVmYXVsdA==",
                    overrides={"correlation_id": F.col("correlation_id")})
    return sent.select("bookmark", "correlation_id").withColumn(
        "valid", payload.valid_correlation_id(F.col("correlation_id")))


@query(LOG + """, sums AS (SELECT topic, sum(CAST(bid AS DECIMAL(18,2))) AS b, count(bid) AS bn,
  sum(CAST(ask AS DECIMAL(18,2))) AS a, count(ask) AS an, count(*) AS n FROM log GROUP BY topic)
SELECT topic, printf('%-5s - bidAgg: %s, bidAvg: %s, askAgg: %s, askAvg: %s, records: %d', topic,
  CAST(b AS DECIMAL(18,2)) :: VARCHAR, CAST(round(CAST(b AS DOUBLE) / bn, 2) AS DECIMAL(18,2)) :: VARCHAR,
  CAST(a AS DECIMAL(18,2)) :: VARCHAR, CAST(round(CAST(a AS DOUBLE) / an, 2) AS DECIMAL(18,2)) :: VARCHAR, n) AS line
FROM sums""")
def report_line(spark, d):
    totals = topics.event_log(spark, d).groupBy("topic").agg(
        *[c.alias(n) for n, c in price_measures().items()])

    def two_digits(name: str):
        return F.round(name, 2).cast("decimal(18,2)").cast("string")

    # Fixed value: the report's wording and order.
    line = F.format_string("%-5s - bidAgg: %s, bidAvg: %s, askAgg: %s, askAvg: %s, records: %d",
                           F.col("topic"), two_digits("bid_sum"), two_digits("bid_avg"),
                           two_digits("ask_sum"), two_digits("ask_avg"), F.col("records"))
    return totals.select("topic", line.alias("line"))


@query("SELECT event_id AS bookmark, user_id AS id, true AS stamped FROM events")
def enrich_ts(spark, d):
    """The time itself differs from run to run: compared is that each message has the one time of its run,
    which lies between the start of the query and an hour later."""
    start = datetime.now(UTC)
    rows = topics.event_log(spark, d).select("bookmark", "id", F.current_timestamp().alias("processed"))
    times = rows.agg(F.count_distinct("processed")).scalar()
    in_run = F.col("processed").between(F.lit(start), F.lit(start + timedelta(hours=1)))
    return rows.select("bookmark", "id", F.coalesce(in_run & (times <= 1), F.lit(False)).alias("stamped"))


def _draw_sql(stream: int, bound: int) -> str:
    x = f"(event_id % 2147483647 + {7919 * stream} + 1) * 48271 % 2147483647"
    return f"(({x} + {104729 * stream}) * 48271 % 2147483647 // 1024) % {bound}"


SYMBOL_LIST = ", ".join(f"'{s}'" for s in synthetic.SYMBOLS)


@query(f"""SELECT event_id AS num, ([{SYMBOL_LIST}])[{_draw_sql(1, 49)} + 1] AS symbol,
  {_draw_sql(2, 100000)} / 100 AS bid, {_draw_sql(3, 100000)} / 100 AS ask,
  CAST(450 AS BIGINT) AS size FROM events""")
def gen_market_data(spark, d):
    made = synthetic.market_data(topics.table(spark, d, "events"), "event_id")
    return made.select("num", "symbol", "bid", "ask", F.length("data").alias("size"))


@query(f"""SELECT md5(CAST(event_id AS VARCHAR)) AS id, event_id + 1 AS item_id,
  (['A', 'AA', 'CSB', 'LSL', 'GQ', 'WO', 'ZES', 'CX', 'OVS', 'EN'])[{_draw_sql(1, 10)} + 1] AS name,
  (['abb', 'al', 'joe', 'steve', 'charles', 'bob', 'peter'])[{_draw_sql(2, 7)} + 1] AS username,
  {_draw_sql(3, 100000)} AS buyer_num FROM events""")
def gen_orders(spark, d):
    made = synthetic.orders_with_buyer(topics.table(spark, d, "events"), "event_id")
    return made.select("id", F.col("itemId").alias("item_id"), "name", "buyer.username",
                       F.col("buyer.num").alias("buyer_num"))


@query(f"SELECT event_id AS num, repeat('a', {synthetic.SOAK_FILLER}) AS data FROM events")
def gen_counter_lines(spark, d):
    return synthetic.counter_lines(topics.table(spark, d, "events"), "event_id")


@query(f"""SELECT event_id AS counter, {_draw_sql(1, 9)} + 1 AS grp, 'Message ' || event_id AS data
FROM events""")
def gen_grouped_counter(spark, d):
    return synthetic.grouped_counters(topics.table(spark, d, "events"), "event_id").select(
        "counter", F.col("group").alias("grp"), "data")


@query(f"""SELECT event_id % 10 AS player, 1000 + event_id // 10 * 500 AS millis,
  {_draw_sql(1, 1000000)} < CASE WHEN event_id % 10 = 0 THEN 600000 ELSE 25000 END AS diamond
FROM events""")
def gen_block_breaks(spark, d):
    made = synthetic.block_breaks(topics.table(spark, d, "events"), "event_id", start_ms=1000)
    return made.select(F.col("playerId").alias("player"), F.col("timestamp").alias("millis"),
                       F.col("isDiamond").alias("diamond"))


# User code on Arrow batches: a message gives one row per two units of k, and none below 10.
@query("""SELECT event_id AS bookmark, i AS part FROM
  (SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events), range(50) t(i)
  WHERE i < k // 2 AND k >= 10""")
def custom_messages(spark, d):
    def expand(frame):
        k = frame["props"].str.extract(r"(\d+)", expand=False).astype("int64")
        counts = (k // 2).where(k >= 10, 0)
        out = frame.loc[frame.index.repeat(counts), ["event_id"]].rename(columns={"event_id": "bookmark"})
        out["part"] = out.groupby("bookmark").cumcount()
        return out

    messages = topics.table(spark, d, "events").select("event_id", "props")
    return custom.map_messages(messages, expand, "bookmark BIGINT, part BIGINT")


@query("""SELECT event_type AS topic, min(value) AS low, max(value) AS high, count(*) AS n
FROM events GROUP BY event_type""")
def custom_aggregate(spark, d):
    def partial(frame):
        return frame.groupby("topic", as_index=False).agg(
            low=("value", "min"), high=("value", "max"), n=("value", "size"))

    def merge(frame):
        return frame.groupby("topic", as_index=False).agg(
            low=("low", "min"), high=("high", "max"), n=("n", "sum"))

    rows = topics.table(spark, d, "events").selectExpr("event_type AS topic", "value")
    return custom.merge_aggregate(rows, ["topic"], partial, merge,
                                  "topic STRING, low DOUBLE, high DOUBLE, n BIGINT")
