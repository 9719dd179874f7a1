"""Results that must be exact: totals, sinks of several runs, reads of several topics, expiry, payload edits."""

import pytest
from pyspark.sql import functions as F

from tidelog.functions import payload
from tidelog.operators import aggregate, changes, queue, sequence, state
from tidelog.operators.command import TopicRead
from tidelog.operators.read import Split
from tidelog.streaming import sinks

LOG = ("topic string, bookmark long, ts timestamp_ntz, command string, id long, num long, bid double, ask double, grp string, "
       "expiration_s long")
FIELDS = ["num", "bid", "ask", "grp"]


def log_of(spark, rows):
    """Rows of (topic, bookmark, second, command, id, bid, expiration)."""
    return spark.createDataFrame(
        [(t, b, None, c, i, b, bid, 1.0, "g", e) for t, b, s, c, i, bid, e in rows], LOG).drop("ts").join(
        spark.createDataFrame([(b, s) for _, b, s, *_ in rows], "bookmark long, s long"), "bookmark").withColumn(
        "ts", F.timestamp_seconds("s")).drop("s")


def test_small_amounts_are_not_lost(spark):
    records = spark.range(1000).select("id", F.lit("g").alias("grp"), F.lit(0.004).alias("bid"), F.lit(0.004).alias("ask"))
    view = state.grouped_view(records).first()
    assert view["sum_bid"] == pytest.approx(4.0, abs=1e-9) and view["n"] == 1000
    assert records.agg(F.sum(aggregate.exact("bid"))).first()[0] == 4
    with pytest.raises(Exception, match="cannot hold"):
        records.select(aggregate.exact("bid", "decimal(18,2)")).collect()


def test_view_delta_of_small_amounts(spark):
    log = log_of(spark, [("a", i, i, "publish", i, 0.004, None) for i in range(100)])
    (row,) = state.view_delta(log, ["id"], FIELDS, F.col("bookmark") < 50, F.lit(True)).collect()
    assert (float(row["old_sum_bid"]), float(row["new_sum_bid"])) == (0.2, 0.4)


def test_a_run_never_overwrites_another_ones_rows(spark, tmp_path):
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    rows = spark.range(10).select(F.col("id").alias("n"), F.lit("w").alias("writer"))
    stream = lambda: spark.readStream.schema(rows.schema).parquet(source)
    run = lambda name, marks=None: sinks.publish_stream(
        stream(), sink, str(tmp_path / name), sinks.EXACTLY_ONCE, writer="writer", ts="n", marks=marks)
    rows.write.parquet(source)
    run("first")
    spark.range(10, 15).select(F.col("id").alias("n"), F.lit("w").alias("writer")).write.mode("append").parquet(source)
    sent = sinks.read_batches(spark, sink, rows.schema)
    run("second", sent.groupBy("writer").agg(F.max("n").alias("high_water")))
    out = sinks.read_batches(spark, sink, rows.schema)
    assert sorted(r["n"] for r in out.collect()) == list(range(15))
    run("second")  # goes on from its checkpoint: nothing new
    assert out.count() == 15


def test_a_read_command_keeps_all_it_is_told(spark):
    log = log_of(spark, [("a", 1, 1, "publish", 1, 5.0, None), ("b", 2, 2, "publish", 1, 60.0, None), ("a", 3, 3, "publish", 2, 50.0, None),
                         ("a", 4, 4, "publish", 1, 6.0, None), ("b", 5, 5, "publish", 2, 7.0, None), ("a", 6, 6, "publish", 2, 55.0, None)])
    read = lambda *a, **k: TopicRead(["id"], FIELDS, *a, **k).run(log)
    # equal keys of two topics are two records
    assert sorted((r["topic"], r["id"], r["bid"]) for r in read("sow").collect()) == [
        ("a", 1, 6.0), ("a", 2, 55.0), ("b", 1, 60.0), ("b", 2, 7.0)]
    deltas = read("delta_subscribe", topic="a", content_filter="/bid > 40").collect()
    assert sorted(r["bookmark"] for r in deltas) == [3, 6]
    both = read("sow_and_delta_subscribe", topic="a", bookmark="3", content_filter="/bid > 4", top_n=1, order_by="/bid DESC").collect()
    assert sorted((r["command"], r["bookmark"]) for r in both) == [("publish", 4), ("publish", 6), ("sow", 3)]
    snapshot = read("sow_and_subscribe", topic="a", bookmark="3", top_n=1, order_by="/bid DESC").where("command = 'sow'").collect()
    assert [r["bid"] for r in snapshot] == [50.0]
    splits = {"x": Split(topic="b"), "y": Split(topic="a", content_filter="/bid > 20", bookmark="3"), "z": Split(content_filter="/id = 1")}
    found = read("sow", topic="a", splits=splits).collect()
    assert sorted((r["split_id"], r["id"], r["bid"]) for r in found) == [("x", 1, 60.0), ("x", 2, 7.0), ("y", 2, 50.0), ("z", 1, 6.0)]
    for command in ("sow_and_subscribe", "delta_subscribe", "sow_and_delta_subscribe"):
        found = read(command, topic="a", splits={"x": Split(topic="b", content_filter="/bid < 20")}).collect()
        assert {(r["split_id"], r["bookmark"]) for r in found} == {("x", 5)}


def test_rows_without_a_time_come_later(spark):
    log = log_of(spark, [("a", 1, 1, "publish", 1, 5.0, None), ("a", 2, None, "publish", 2, 6.0, None)])
    point = F.col("ts") <= F.timestamp_seconds(F.lit(1))
    for read in (changes.sow_and_subscribe, changes.sow_and_delta_subscribe):
        assert sorted((r["bookmark"], r["command"]) for r in read(log, ["id"], FIELDS, point).collect()) == [(1, "sow"), (2, "publish")]


def test_an_expiry_inside_the_log_starts_a_record_anew(spark):
    log = log_of(spark, [("a", 1, 0, "publish", 1, 5.0, 10), ("a", 2, 3600, "delta_publish", 1, None, None),
                         ("a", 3, 0, "publish", 2, 5.0, 10), ("a", 4, 9, "delta_publish", 2, None, None)])
    rows = {r["id"]: r for r in state.with_expiry(log, ["id"], FIELDS, F.timestamp_seconds(F.lit(4000))).collect()}
    assert rows[1]["bid"] is None and rows[2]["bid"] == 5.0
    assert not rows[1]["expired"] and not rows[2]["expired"]


def test_null_wishes_are_none(spark):
    rows = spark.createDataFrame(list(enumerate([None, False, True, None, False])), "n long, wish boolean").withColumn("id", F.lit(1))
    out = sequence.choose_commands(rows, ["id"], "n", F.col("wish")).orderBy("n").collect()
    assert [r["command"] for r in out] == ["publish", "delta_publish", "sow_delete", "publish", "delta_publish"]


def test_only_the_objects_own_field_is_replaced(spark):
    texts = ['{"a":1,"f":2}', '{"a":{"f":1},"f":2}', '{"f":[1,2,{"f":3}],"b":4}', '{"a":{"f":1}}', '{ "x" : "f\\":9" , "f" : {"f":0} }',
             '{"g":"a,b","f":"q"}', '{}', 'no json', '{"a":[[{"f":5}]],"f":null}']
    wanted = ['{"a":1,"f":"N"}', '{"a":{"f":1},"f":"N"}', '{"f":"N","b":4}', '{"a":{"f":1}}', '{ "x" : "f\\":9" , "f" : "N" }',
              '{"g":"a,b","f":"N"}', '{}', 'no json', '{"a":[[{"f":5}]],"f":"N"}']
    df = spark.createDataFrame(list(zip(texts, wanted)), "data string, want string")
    for r in df.select("want", payload.replace_json_field("data", "f", "N").alias("got")).collect():
        assert r["got"] == r["want"]


def test_the_last_delivery_decides(spark):
    rules = queue.QueueRules(lease_s=30, ttl_s=10_000, max_deliveries=3, max_cancels=2)
    log = spark.createDataFrame([(i, 0) for i in range(1, 6)], "bookmark long, s long").select("bookmark", F.timestamp_seconds("s").alias("ts"))
    deliveries = [(1, 1, 10, "cancel"), (1, 2, 90, "none"), (2, 1, 10, "cancel"), (3, 1, 1, "none"), (3, 2, 2, "cancel"), (3, 3, 95, "none"),
                  (4, 1, 1, "none"), (4, 2, 2, "none"), (4, 3, 3, "none")]
    ledger = spark.createDataFrame([(b, d, 0, 1, at, o) for b, d, at, o in deliveries],
                                   "bookmark long, delivery long, consumer long, checkpoint_id long, at long, outcome string")
    ledger = ledger.withColumn("delivered_at", F.timestamp_seconds("at"))
    now, done = F.timestamp_seconds(F.lit(100)), F.lit(1)
    got = {r["bookmark"]: r["status"] for r in queue.status(log, ledger, done, now, rules).collect()}
    assert got == {1: "leased", 2: "pending", 3: "leased", 4: "failed", 5: "pending"}
    assert [r["bookmark"] for r in queue.redeliveries(log, ledger, done, now, rules).collect()] == [2]
    assert [r["bookmark"] for r in queue.failed(log, ledger, done, now, rules).collect()] == [4]
