"""Event-time windows, grouped aggregates, views and changelogs."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType, TimestampType

from tidelog.functions import custom, payload
from tidelog.operators import aggregate, changes, state
from tidelog.plans.registry import query
from tidelog.plans.sqltext import HISTORY, LOG, state as sql_state
from tidelog.sources import topics

KEY, FIELDS = ["id"], list(topics.FIELDS)

PRICE_SQL = """round(sum(bid), 5) AS bid_sum, round(sum(ask), 5) AS ask_sum, round(avg(bid), 5) AS bid_avg,
  round(avg(ask), 5) AS ask_avg, count(bid) AS bid_n, count(ask) AS ask_n, count(*) AS records"""


def compared(df):
    """Sums and averages of doubles to five digits on either side: what is compared does not depend on
    the order of addition.  The operators do not round."""
    return df.withColumns({c: F.round(c, 5) for c, kind in df.dtypes if kind == "double"})


def in_sevenths(sql: str) -> str:
    """The same log with bids of more than two digits."""
    return sql.replace("THEN value END AS bid", "THEN value / 7 END AS bid")


def sevenths(spark, d):
    return topics.event_log(spark, d).withColumn("bid", F.col("bid") / 7)


@query(in_sevenths(LOG) + f""" SELECT topic, time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
  time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, {PRICE_SQL}
FROM log GROUP BY ALL""")
def window_agg(spark, d):
    return compared(aggregate.price_windows(sevenths(spark, d), "topic", "ts", "1 hour"))


@query("""SELECT l_returnflag || l_linestatus AS symbol, date_trunc('day', l_shipdate) AS window_start,
  date_trunc('day', l_shipdate) + INTERVAL 1 DAY AS window_end,
  round(sum(l_extendedprice), 5) AS bid_sum, round(sum(l_quantity), 5) AS ask_sum,
  round(avg(l_extendedprice), 5) AS bid_avg, round(avg(l_quantity), 5) AS ask_avg,
  count(l_extendedprice) AS bid_n, count(l_quantity) AS ask_n,
  count(*) AS records FROM lineitem GROUP BY ALL""")
def window_agg_items(spark, d):
    return compared(aggregate.price_windows(topics.item_log(spark, d), "symbol", "ts", "1 day"))


FLAG_SQL = """count(*) FILTER (WHERE flag) AS flagged, count(*) AS records"""


@query(LOG + f""" SELECT id, date_trunc('day', ts) AS window_start,
  date_trunc('day', ts) + INTERVAL 1 DAY AS window_end, {FLAG_SQL} FROM log GROUP BY ALL""")
def window_flag_count(spark, d):
    return aggregate.flag_windows(topics.event_log(spark, d), "id", "ts", "1 day", F.col("flag"))


@query(LOG + f""" SELECT id, date_trunc('day', ts) AS window_start,
  date_trunc('day', ts) + INTERVAL 1 DAY AS window_end, {FLAG_SQL} FROM log GROUP BY ALL""")
def window_broker_time(spark, d):
    stamped = topics.event_log(spark, d).select(
        "id", "flag", payload.parse_broker_time(payload.broker_time_text("ts")).alias("ts"))
    return aggregate.flag_windows(stamped, "id", "ts", "1 day", F.col("flag"))


# An alert needs more than ceil(10 * 0.3 * 0.5) = 2 flagged rows in a day; shares are of 5 a day.
@query(LOG + f""", w AS (SELECT id, date_trunc('day', ts) AS window_start,
  date_trunc('day', ts) + INTERVAL 1 DAY AS window_end, {FLAG_SQL} FROM log GROUP BY ALL)
SELECT id, window_start, flagged, flagged / 3.0 :: DOUBLE AS share,
  '(ALERT) Player ' || id || ' collected ' || flagged || ' diamonds' AS line
FROM w WHERE flagged > 2""")
def alerts(spark, d):
    windows = aggregate.flag_windows(topics.event_log(spark, d), "id", "ts", "1 day", F.col("flag"))
    limit = aggregate.alert_limit(10, 0.3, 0.5)
    # Fixed value: the alert's wording.
    line = F.format_string("(ALERT) Player %d collected %d diamonds", "id", "flagged")
    return aggregate.alerts(windows, limit, 10, 0.3).select(
        "id", "window_start", "flagged", "share", line.alias("line"))


def flagged_too_often(key, batches):
    """User code on a window: counts its flagged rows and tells of more than two."""
    player, start, _ = key
    flagged = sum(batch.column("flag").true_count for batch in batches)
    if flagged > 2:
        yield player, start, flagged, flagged / 3.0, f"(ALERT) Player {player} collected {flagged} diamonds"


@query(LOG + f""", w AS (SELECT id, date_trunc('day', ts) AS window_start, {FLAG_SQL} FROM log GROUP BY ALL)
SELECT id, window_start, flagged, flagged / 3.0 :: DOUBLE AS share,
  '(ALERT) Player ' || id || ' collected ' || flagged || ' diamonds' AS line FROM w WHERE flagged > 2""")
def window_user_code(spark, d):
    schema = StructType([StructField("id", LongType()), StructField("window_start", TimestampType()),
                         StructField("flagged", LongType()), StructField("share", DoubleType()), StructField("line", StringType())])
    rows = topics.event_log(spark, d).select("id", "ts", "flag")
    return custom.per_window(rows, ["id"], "ts", "1 day", flagged_too_often, schema)


@query(in_sevenths(LOG) + f" SELECT topic, {PRICE_SQL} FROM log GROUP BY topic")
def two_level_agg(spark, d):
    return compared(aggregate.two_level(sevenths(spark, d), ["topic"], F.col("bookmark") % 16))


@query(LOG + " SELECT grp, count(bid) AS n FROM log GROUP BY grp")
def group_count(spark, d):
    return aggregate.group_count(topics.event_log(spark, d), ["grp"], "bid")


@query("""SELECT l_returnflag || l_linestatus AS symbol,
  round(sum(l_extendedprice), 2) AS sum_bid, round(sum(l_quantity), 2) AS sum_ask FROM lineitem GROUP BY 1""")
def group_sum(spark, d):
    # a few groups of many rows: two digits are what doubles of this size keep in any order
    sums = aggregate.group_sum(topics.item_log(spark, d), ["symbol"], ["bid", "ask"])
    return sums.withColumns({c: F.round(c, 2) for c in ("sum_bid", "sum_ask")})


def view_sql(source: str) -> str:
    return f"""SELECT grp, CAST(sum(CAST(ask AS DECIMAL(18,2))) AS DOUBLE) AS sum_ask,
  CAST(sum(CAST(bid AS DECIMAL(18,2))) AS DOUBLE) AS sum_bid, count(id) AS n
  FROM ({source}) GROUP BY grp"""


@query(in_sevenths(HISTORY) + f""" SELECT grp, round(sum(ask), 5) AS sum_ask, round(sum(bid), 5) AS sum_bid,
  count(id) AS n FROM ({sql_state()}) GROUP BY grp""")
def sow_view(spark, d):
    return compared(state.grouped_view(state.state_at(sevenths(spark, d), KEY, FIELDS)))


@query(HISTORY + f""", v0 AS ({view_sql(sql_state("ts < TIMESTAMP '2024-01-16'"))}),
v1 AS ({view_sql(sql_state("ts < TIMESTAMP '2024-01-24'"))})
SELECT coalesce(v0.grp, v1.grp) AS grp, v0.sum_ask AS old_sum_ask, v1.sum_ask AS new_sum_ask,
  v0.sum_bid AS old_sum_bid, v1.sum_bid AS new_sum_bid, v0.n AS old_n, v1.n AS new_n
FROM v0 FULL JOIN v1 ON v0.grp IS NOT DISTINCT FROM v1.grp
WHERE (v0.sum_ask, v0.sum_bid, v0.n) IS DISTINCT FROM (v1.sum_ask, v1.sum_bid, v1.n)""")
def sow_view_delta(spark, d):
    def seen(day: str):
        return F.col("ts") < F.lit(day).cast("timestamp")

    return state.view_delta(topics.event_log(spark, d), KEY, FIELDS, seen("2024-01-16"), seen("2024-01-24"))


CHANGELOG_SQL = """, steps AS (SELECT *, row_number() OVER k AS i, sum(n) OVER k AS cn, sum(s) OVER k AS cs
  FROM src WINDOW k AS (PARTITION BY grp ORDER BY pos)),
pairs AS (SELECT *, lag(cn) OVER k AS pn, lag(cs) OVER k AS ps FROM steps
  WINDOW k AS (PARTITION BY grp ORDER BY pos))
SELECT grp, pos AS {pos}, CASE WHEN i = 1 THEN '+I' ELSE '+U' END AS op,
  CAST(cn AS BIGINT) AS n, CAST(cs AS DOUBLE) AS sum_bid FROM pairs
UNION ALL SELECT grp, pos, '-U', CAST(pn AS BIGINT), CAST(ps AS DOUBLE) FROM pairs WHERE i > 1"""


@query(LOG + """, src AS (SELECT grp, bookmark AS pos, 1 AS n,
  coalesce(CAST(bid AS DECIMAL(18,2)), 0) AS s FROM log)""" + CHANGELOG_SQL.format(pos="bookmark"))
def agg_changelog(spark, d):
    log = topics.event_log(spark, d).select("grp", "bookmark", "bid")
    return changes.aggregate_changelog(log, ["grp"], "bookmark", _totals())


@query(LOG + """, src AS (SELECT grp, bookmark // 500 AS pos, count(*) AS n,
  sum(coalesce(CAST(bid AS DECIMAL(18,2)), 0)) AS s FROM log GROUP BY ALL)""" + CHANGELOG_SQL.format(pos="batch"))
def agg_changelog_minibatch(spark, d):
    log = topics.event_log(spark, d).select("grp", "bookmark", "bid")
    return changes.aggregate_changelog_batched(log, ["grp"], "bookmark", _totals(), 500)


def _totals():
    return {"n": F.lit(1).cast("bigint"),
            "sum_bid": F.coalesce(aggregate.exact("bid"), F.lit(0).cast(aggregate.AMOUNT))}
