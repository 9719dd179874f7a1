"""Gap checks, counters, duplicates, increasing times, late rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelog.functions import custom
from tidelog.functions.segments import running_row_number, whole_part
from tidelog.operators import sequence
from tidelog.plans.registry import query
from tidelog.plans.sqltext import LOG
from tidelog.sources import topics

# Numbers seen are those of messages that are not errors; errors leave the gaps.
MISSING_SQL = LOG + """, seen AS (SELECT num FROM log WHERE topic <> 'error'),
missing AS (SELECT num + 2 AS missing FROM seen
  WHERE num + 2 NOT IN (SELECT num FROM seen)
    AND num NOT IN (SELECT max(num) FROM seen GROUP BY num % 2))"""


@query(MISSING_SQL + " SELECT missing FROM missing")
def sequence_gaps(spark, d):
    seen = topics.event_log(spark, d).filter(F.col("topic") != "error")
    return sequence.missing_numbers(seen, "num", 2)


# Messages arrive in another order than that of their numbers.
@query("""WITH seen AS (SELECT event_id AS num, event_id % 97 * 1000000000 + event_id AS arrival FROM events),
numbered AS (SELECT row_number() OVER w AS n, max(num) OVER w AS highest FROM seen WINDOW w AS (ORDER BY arrival))
SELECT n // 100 AS block, highest, highest + 1 - n AS outstanding FROM numbered WHERE n % 100 = 0""")
def gaps_per_block(spark, d):
    log = topics.event_log(spark, d).select("num", (F.col("num") % 97 * 1_000_000_000 + F.col("num")).alias("arrival"))
    return sequence.outstanding_per_block(log, "arrival", "num", 100)


@query(LOG + """ SELECT bookmark, topic || ' ' || row_number() OVER (PARTITION BY topic ORDER BY bookmark)
  || ' ' || id AS line FROM log""")
def running_counter(spark, d):
    log = topics.event_log(spark, d).select("topic", "bookmark", "id")
    numbered = running_row_number(log, ["topic"], "bookmark", "rn")
    return numbered.select("bookmark", F.concat_ws(" ", "topic", "rn", "id").alias("line"))


@query(LOG + """ SELECT topic, bookmark, rn FROM (
  SELECT *, row_number() OVER (PARTITION BY topic ORDER BY bookmark) AS rn FROM log) WHERE rn % 25 = 0""")
def every_nth(spark, d):
    log = topics.event_log(spark, d).select("topic", "bookmark")
    return sequence.every_nth(log, ["topic"], "bookmark", 25)


class EveryNth:
    """User code with a field of its own: hands on every 25th message of its key."""

    def __init__(self):
        self.seen = 0

    def eval(self, row):
        self.seen += 1
        if self.seen % 25 == 0:
            yield row["topic"], row["bookmark"], self.seen


@query(LOG + """ SELECT topic, bookmark, rn FROM (
  SELECT *, row_number() OVER (PARTITION BY topic ORDER BY bookmark) AS rn FROM log) WHERE rn % 25 = 0""")
def key_user_code(spark, d):
    log = topics.event_log(spark, d).select("topic", "bookmark")
    return custom.rows_per_key(log, EveryNth, "topic STRING, bookmark BIGINT, rn BIGINT", ["topic"], "bookmark")


# Every third message is delivered twice, every fifteenth four times.
@query("SELECT event_type AS topic, event_id AS bookmark, user_id AS id FROM events")
def dedup_replay(spark, d):
    log = topics.event_log(spark, d).select("topic", "bookmark", "id")
    return sequence.drop_replayed(replayed(log), ["topic", "bookmark"]).select("topic", "bookmark", "id")


def replayed(log):
    copies = F.when(F.col("bookmark") % 15 == 0, 4).when(F.col("bookmark") % 3 == 0, 2).otherwise(1)
    return log.withColumn("copy", F.explode(F.sequence(F.lit(1), copies))).drop("copy")


# Writers are users modulo 4; their times are cut to five minutes, so some do not increase.
WRITER_SQL = """WITH rows AS (SELECT event_id AS bookmark, user_id % 4 AS writer,
  CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0 THEN -1
    ELSE epoch_us(ts) // 300000000 * 300000 END AS ms FROM events)"""


def writer_rows(spark, d):
    n = F.col("bookmark")
    ms = (F.when(n % 97 == 0, F.lit(None)).when(n % 89 == 0, F.lit(-1))
          .otherwise(whole_part(F.unix_micros("ts"), 300000000) * 300000)).cast("bigint")
    return topics.event_log(spark, d).select(
        "bookmark", F.pmod("id", F.lit(4)).alias("writer"), ms.alias("ms"))


@query(WRITER_SQL + """, k AS (SELECT *, max(ms) OVER (PARTITION BY writer ORDER BY bookmark
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous FROM rows)
SELECT bookmark, writer, CAST(ms AS DOUBLE) AS ms, CAST(previous AS DOUBLE) AS previous,
  CASE WHEN ms IS NULL THEN 'missing' WHEN ms < 0 THEN 'negative' ELSE 'not increasing' END AS reason
FROM k WHERE ms IS NULL OR ms < 0 OR ms <= previous""")
def ts_violations(spark, d):
    found = sequence.time_violations(writer_rows(spark, d), ["writer"], "bookmark", "ms")
    return found.withColumns({c: F.col(c).cast("double") for c in ("ms", "previous")})


# Every seventh message arrives 500 positions late; a batch is 200 arrivals, a window an hour.
ARRIVAL_SQL = """WITH arrivals AS (SELECT event_id AS bookmark, ts,
  (event_id + CASE WHEN event_id % 7 = 0 THEN 500 ELSE 0 END) // 200 AS batch FROM events),
marks AS (SELECT batch, max(max(ts)) OVER (ORDER BY batch
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS watermark FROM arrivals GROUP BY batch)"""


@query(ARRIVAL_SQL + """ SELECT bookmark, batch, watermark,
  time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end
FROM arrivals JOIN marks USING (batch) WHERE time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR <= watermark""")
def late_rows(spark, d):
    n = F.col("bookmark")
    arrived = topics.event_log(spark, d).select(
        "bookmark", "ts", (n + F.when(n % 7 == 0, 500).otherwise(0)).alias("arrival"))
    return sequence.late_rows(arrived, "arrival", "ts", 200, 3600).select(
        "bookmark", "batch", "watermark", "window_end")


# The coin of a row: a fixed mix of its position decides between update and delete.
COIN_SQL = "(event_id * 48271 % 2147483647) // 1024 % 2 = 1"


@query(f"""WITH RECURSIVE numbered AS (SELECT event_id AS bookmark, user_id AS id, {COIN_SQL} AS wants,
  row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM events),
walk AS (SELECT bookmark, id, i, 'publish' AS command FROM numbered WHERE i = 1
  UNION ALL SELECT n.bookmark, n.id, n.i, CASE WHEN w.command = 'sow_delete' THEN 'publish'
    WHEN n.wants THEN 'sow_delete' ELSE 'delta_publish' END
  FROM walk w JOIN numbered n ON n.id = w.id AND n.i = w.i + 1)
SELECT bookmark, id, command FROM walk""")
def command_chooser(spark, d):
    rows = topics.event_log(spark, d).select("bookmark", "id")
    return sequence.choose_commands(rows, ["id"], "bookmark", coin("bookmark"))


def coin(number: str):
    return whole_part(F.col(number) * 48271 % 2147483647, 1024) % 2 == 1
