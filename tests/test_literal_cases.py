"""Literal cases: given messages, expected reads."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from helpers import START, make_log
from tidelog.functions import payload
from tidelog.functions.positions import after, is_range
from tidelog.operators import changes, queue, read, sequence, state, write
from tidelog.operators.command import TopicRead
from tidelog.operators.queue import QueueRules
from tidelog.operators.read import Split

K, FIELDS = ["id"], ["data", "num"]


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def records(log, **kw):
    return rows(state.state_at(log, K, FIELDS, **kw), "id", *FIELDS)


def before(n):
    return F.col("bookmark") < n


def test_source_and_split_filter(spark):
    log = make_log(spark, [("publish", i, str(i), i) for i in (1, 2, 3, 4)])
    splits = {"even": Split(content_filter="/id MOD 2 = 0"), "all": Split()}
    out = read.read_splits(log, splits, source_filter="/id > 2")
    assert rows(out, "split_id", "id") == [("all", 3), ("all", 4), ("even", 4)]


def test_delta_subscribe_shows_key_and_changes_only(spark):
    log = make_log(spark, [("publish", 1, "1", 1), ("publish", 2, "1", 2),
                           ("publish", 1, "1", 1), ("publish", 2, "2", 2)])
    out = changes.delta_subscribe(log, K, FIELDS, since=~before(2))
    assert rows(out, "delta") == [('{"id":1}',), ('{"id":2,"data":"2"}',)]


def test_snapshot_then_deltas(spark):
    log = make_log(spark, [("publish", 1, "1", 1), ("publish", 2, "1", 1),
                           ("publish", 1, "1", 100), ("publish", 2, "2", 1)])
    out = changes.sow_and_delta_subscribe(log, K, FIELDS, before(2))
    assert rows(out, "command", "delta") == [
        ("publish", '{"id":1,"num":100}'), ("publish", '{"id":2,"data":"2"}'),
        ("sow", '{"id":1,"data":"1","num":1}'), ("sow", '{"id":2,"data":"1","num":1}')]


def test_state_top_skip_and_order(spark):
    log = make_log(spark, [("publish", i, "abc"[i], i) for i in range(3)])
    everything = state.state_at(log, K, FIELDS)
    assert len(state.page(everything, K, 3).collect()) == 3
    assert rows(state.page(everything, K, 1, 1), "id") == [(1,)]
    ordered = TopicRead(K, FIELDS, "sow", order_by="/data DESC").run(log)
    assert [r.id for r in ordered.collect()] == [2, 1, 0]


def test_skip_needs_top():
    with pytest.raises(ValueError):
        TopicRead(K, FIELDS, "sow", skip_n=1)


def test_snapshot_and_subscribe(spark):
    log = make_log(spark, [("publish", 1, "a", 1), ("publish", 2, "b", 2), ("publish", 3, "c", 3)])
    out = changes.sow_and_subscribe(log, K, FIELDS, before(1))
    assert rows(out, "command", "id") == [("publish", 2), ("publish", 3), ("sow", 1)]
    topped = changes.sow_and_subscribe(log, K, FIELDS, before(2), top=1)
    assert rows(topped, "command", "id") == [("publish", 3), ("sow", 1)]
    assert not TopicRead(K, FIELDS, "sow_and_subscribe", top_n=1).bounded


def test_range_on_empty_topic_ends(spark):
    log = make_log(spark, [])
    for text in ("[20200604T000000:20200605T000000)", "[20200604T000000:20200605T000000]"):
        assert is_range(text) and TopicRead(K, FIELDS, bookmark=text).bounded
        assert read.subscribe(log, start=text).collect() == []


def test_range_ends(spark):
    log = make_log(spark, [("publish", i, "x", i) for i in range(5)])
    for text, expected in {"[20240101T000001:20240101T000003)": [1, 2],
                           "[20240101T000001:20240101T000003]": [1, 2, 3],
                           "(1:3]": [2, 3], "20240101T000003Z": [3, 4], "2": [3, 4],
                           "0": [0, 1, 2, 3, 4], "": [0, 1, 2, 3, 4]}.items():
        assert [i for (i,) in rows(log.filter(after(text)), "id")] == expected, text


def test_bad_position(spark):
    with pytest.raises(ValueError):
        after("yesterday")


def test_read_commands(spark):
    log = make_log(spark, [("publish", 1, "a", 1), ("publish", 2, "b", 2), ("delta_publish", 1, None, 3),
                           ("publish", 3, "c", 4)])

    def run(*columns, **kw):
        return rows(TopicRead(K, FIELDS, **kw).run(log), *columns)

    assert run("bookmark", top_n=2, bookmark="20240101T000001Z") == [(1,), (2,)]
    assert run("split_id", "bookmark", top_n=1, splits={"x": Split(), "y": Split(content_filter="/num > 2")}) == [
        ("x", 0), ("y", 2)]
    assert run("id", "num", command="sow", bookmark="1") == [(1, 1), (2, 2)]
    assert run("id", "num", command="sow", topic="other") == []
    assert run("command", "id", command="sow_and_subscribe", bookmark="2", content_filter="/num > 2") == [
        ("publish", 3), ("sow", 1)]
    assert run("delta", command="delta_subscribe", bookmark="1") == [
        ('{"id":1,"num":3}',), ('{"id":3,"data":"c","num":4}',)]
    assert run("command", "delta", command="sow_and_delta_subscribe", bookmark="20240101T000002Z") == [
        ("publish", '{"id":3,"data":"c","num":4}'), ("sow", '{"id":1,"data":"a","num":3}'),
        ("sow", '{"id":2,"data":"b","num":2}')]
    with pytest.raises(ValueError):
        TopicRead(K, FIELDS, "listen")


def test_overlapping_splits_keep_copies_and_resume_per_split(spark):
    log = make_log(spark, [("publish", i, str(i), i) for i in (1, 2, 3)])
    both = read.read_splits(log, {"a": Split(), "b": Split()})
    assert rows(both, "id") == [(1,), (1,), (2,), (2,), (3,), (3,)]
    points = spark.createDataFrame([("a", 1)], "split_id STRING, last_bookmark BIGINT")
    assert rows(read.resume(both, points), "split_id", "id") == [("a", 3), ("b", 1), ("b", 2), ("b", 3)]


def test_delta_publish_merges(spark):
    log = make_log(spark, [("publish", 1, "1", 1), ("delta_publish", 1, None, 2)])
    assert records(log) == [(1, "1", 2)]
    merged = changes.merged_records(log, K, FIELDS)
    assert rows(merged, "bookmark", *FIELDS) == [(0, "1", 1), (1, "1", 2)]
    deltas = changes.delta_subscribe(log, K, FIELDS, since=~before(1))
    assert rows(deltas, "delta") == [('{"id":1,"num":2}',)]


def test_publish_replaces_and_delta_after_delete_starts_anew(spark):
    log = make_log(spark, [("publish", 1, "1", 1), ("publish", 1, None, 2),
                           ("publish", 2, "x", 1), ("sow_delete", 2, None, None),
                           ("delta_publish", 2, None, 9)])
    assert records(log) == [(1, None, 2), (2, None, 9)]


def test_explicit_null_overwrites_where_presence_is_known(spark):
    raw = spark.createDataFrame(
        [(0, "publish", 1, '{"data":"a","num":1}'), (1, "delta_publish", 1, '{"data":null}')],
        "bookmark BIGINT, command STRING, id BIGINT, text STRING")
    log = raw.withColumn("raw", F.from_json("text", "map<string,string>")).selectExpr(
        "*", "raw['data'] AS data", "int(raw['num']) AS num")
    present = {f: f"map_contains_key(raw, '{f}')" for f in FIELDS}
    assert records(log) == [(1, "a", 1)]
    assert records(log, present=present) == [(1, None, 1)]
    after_rows = changes.history(log, K, FIELDS, present=present)
    assert rows(after_rows.filter("bookmark = 1"), *FIELDS) == [(None, 1)]


def test_deletes(spark):
    log = make_log(spark, [("publish", 1, "1", 1), ("sow_delete", 1, "1", 1), ("publish", 2, "2", 2)])
    assert records(log, content_filter="/id = 1") == []
    assert records(log) == [(2, "2", 2)]
    keyed = make_log(spark, [("publish", 0, "1", 1), ("sow_delete", 0, None, None)])
    assert [r.sow_key for r in state.state_at(keyed.filter(before(1)), ["sow_key"], FIELDS).collect()] == ["0"]
    assert state.state_at(keyed, ["sow_key"], FIELDS).collect() == []


def test_delete_by_filter(spark):
    log = make_log(spark, [("publish", 1, "a", 1), ("publish", 2, "b", 2), ("delta_publish", 1, "c", None),
                           ("delta_publish", 2, "d", None), ("publish", 3, "e", 3)])
    assert rows(state.delete_where(log, K, FIELDS, "1 = 1", before(3)), "id", *FIELDS) == [
        (2, "d", None), (3, "e", 3)]
    assert rows(state.delete_where(log, K, FIELDS, "/data = 'c'", before(3)), "id", *FIELDS) == [
        (2, "d", 2), (3, "e", 3)]


def test_filter_on_state_is_not_a_filter_on_history(spark):
    log = make_log(spark, [("publish", 1, "a", 1), ("publish", 1, "b", 2)])
    assert records(log, content_filter="/data = 'a'") == []


def test_out_of_focus(spark):
    log = make_log(spark, [("publish", 1, "a", 10), ("publish", 1, "a", 1), ("publish", 2, "a", 10),
                           ("sow_delete", 2, None, None), ("publish", 3, "a", 1), ("sow_delete", 3, None, None)])
    out = changes.out_of_focus(log, K, FIELDS, "/num > 5")
    assert rows(out, "bookmark", "id", "reason") == [(1, 1, "match"), (3, 2, "deleted")]


def test_expiry(spark):
    log = make_log(spark, [("publish", 1, "1", 1), ("publish", 2, "2", 2)]).withColumn(
        "expiration_s", F.when(F.col("id") == 1, 1))
    for seconds, expected in ((0, [1, 2]), (1, [2])):
        now = F.lit(START + timedelta(seconds=seconds))
        live = state.with_expiry(log, K, FIELDS, now).filter("NOT expired")
        assert [i for (i,) in rows(live, "id")] == expected
    gone = changes.expired_out_of_focus(log, K, FIELDS, "1 = 1", F.lit(START + timedelta(hours=1)))
    assert rows(gone, "id", "reason") == [(1, "expired")]


def test_history_grid_carries_records_forward(spark):
    log = make_log(spark, [("publish", 1, "a", 0), ("delta_publish", 1, None, 1), ("sow_delete", 1, None, None),
                           ("publish", 2, "b", 5)])
    grid = state.history_grid(log, K, FIELDS, start=F.lit(START), step_s=1, points=5)
    assert [(r.grid_ts.second, r.id, r.data, r.num) for r in grid.orderBy("grid_ts", "id").collect()] == [
        (0, 1, "a", 0), (1, 1, "a", 1), (3, 2, "b", 5), (4, 2, "b", 5)]


def test_view_keeps_the_null_group(spark):
    log = make_log(spark, [("publish", 1, None, 1), ("publish", 2, "g", 2), ("publish", 2, None, 3)])
    view = state.grouped_view(state.state_at(log, K, FIELDS).selectExpr(
        "id", "data AS grp", "double(num) AS bid", "double(num) AS ask"))
    assert [(r.grp, float(r.sum_bid), r.n) for r in view.collect()] == [(None, 4.0, 2)]
    priced = log.selectExpr("*", "data AS grp", "double(num) AS bid", "double(num) AS ask")
    delta = state.view_delta(priced, K, ["grp", "bid", "ask"], before(2), before(9)).collect()
    assert {r.grp: (r.old_n, r.new_n) for r in delta} == {None: (1, 2), "g": (1, None)}
    assert state.view_delta(priced, K, ["grp", "bid", "ask"], before(2), before(2)).collect() == []


def test_exactly_once_resume_and_order_check(spark):
    sent = spark.createDataFrame([("w", 1), ("w", 2)], "writer STRING, ms BIGINT")
    again = spark.createDataFrame([("w", 1), ("w", 2), ("w", 3), ("v", 1)], "writer STRING, ms BIGINT")
    rest = write.resume_after(again, write.high_water(sent, "writer", "ms"), "writer", "ms")
    assert rows(rest, "writer", "ms") == [("v", 1), ("w", 3)]
    bad = spark.createDataFrame([(0, "w", 1), (1, "w", 2), (2, "w", 2)], "n BIGINT, writer STRING, ms BIGINT")
    found = sequence.time_violations(bad, ["writer"], "n", "ms")
    assert rows(found, "n", "reason") == [(2, "not increasing")]
    with pytest.raises(PySparkException):
        write.strictly_increasing(found).collect()


def test_row_overrides_win(spark):
    log = make_log(spark, [("publish", 1, "own", 1), ("publish", 2, None, 2)])
    out = write.outgoing(log, F.col("data"), topic="out", correlation_id="default",
                         overrides={"correlation_id": F.col("data")})
    assert rows(out, "correlation_id") == [("default",), ("own",)]
    with pytest.raises(ValueError):
        write.outgoing(log, F.col("data"), topic="out", command="shout")
    with pytest.raises(ValueError):
        write.outgoing(log, F.col("data"), topic="out", overrides={"colour": F.lit(1)})


def test_routing_of_unknown_goes_to_the_other_topic(spark):
    df = spark.createDataFrame([(2.0, 1.0), (1.0, 2.0), (None, 1.0)], "bid DOUBLE, ask DOUBLE")
    assert rows(write.route(df, F.col("bid") > F.col("ask"), "a", "b"), "topic") == [("a",), ("b",), ("b",)]


def test_broker_time(spark):
    df = spark.createDataFrame([("20210101T010101.999999Z",), ("20210101T010102.000000Z",),
                                ("20240208T010101.000000Z",), ("20241130T010101.000000Z",), (None,)], "t STRING")
    out = df.select(F.unix_millis(payload.parse_broker_time("t")).alias("ms"))
    assert [r.ms for r in out.collect()] == [1609462861999, 1609462862000, 1707354061000, 1732928461000, None]


def test_defaults_and_malformed_payload(spark):
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    schema = StructType([StructField("id", LongType()), StructField("data", StringType())])
    df = spark.createDataFrame([('{"id":1}',), ("{broken",)], "data STRING")
    parsed = payload.parse_json(df, schema)
    out = parsed.select(*payload.with_defaults("payload", {"id": 0, "data": ""}))
    assert [tuple(r) for r in out.collect()] == [(1, ""), (0, "")]
    ok = df.select(payload.json_or_null("data", schema).isNull().alias("bad"))
    assert [r.bad for r in ok.collect()] == [False, True]


def test_path_filter_leaves_literals_alone(spark):
    df = spark.createDataFrame([(6, "/id MOD 2", 3.0)], "id BIGINT, data STRING, num DOUBLE")
    assert df.filter(payload.path_filter("/id MOD 4 = 2 AND /data = '/id MOD 2' AND /id / 2 = /num")).count() == 1
    assert df.filter(payload.path_filter("CRC32(/data) MOD 4 >= 0")).count() == 1


def test_replace_field_keeps_the_rest(spark):
    df = spark.createDataFrame([('{"id":1, "data" : "a\\"b", "num":2}',), ('{"id":1}',)], "data STRING")
    out = df.select(payload.replace_json_field("data", "data", 'x$1"y').alias("d"),
                    payload.replace_json_field("data", "num", "z").alias("n"))
    assert [tuple(r) for r in out.collect()] == [
        ('{"id":1, "data" : "x$1\\"y", "num":2}', '{"id":1, "data" : "a\\"b", "num":"z"}'),
        ('{"id":1}', '{"id":1}')]


def test_replace_field_behind_a_deeply_nested_value(spark):
    deep = '{"a":' + '[' * 9 + '{"f":1}' + ']' * 9 + ',"f":{"b":2},"g":1.50,"t":"x\\"y"}'
    other = '{"a":' + '[' * 9 + '{"f":1}' + ']' * 9 + ',"g":1}'
    df = spark.createDataFrame([(deep,), (other,), ("not json",), (None,), ('{"a":[{"f":1}],"f":null}',)], "data STRING")
    out = [r[0] for r in df.select(payload.replace_json_field("data", "f", 'new "$1"')).collect()]
    parsed = json.loads(out[0])
    assert parsed == {**json.loads(deep), "f": 'new "$1"'} and list(parsed) == ["a", "f", "g", "t"]
    assert out[1:] == [other, "not json", None, '{"a":[{"f":1}],"f":"new \\"$1\\""}']


LEDGER = "bookmark BIGINT, delivery INT, checkpoint_id BIGINT, delivered_at TIMESTAMP, outcome STRING, consumer BIGINT"


def test_queue_redelivery_after_abort(spark):
    log = make_log(spark, [("publish", 1, "1", 1), ("publish", 2, "2", 2)])
    ledger = spark.createDataFrame([(0, 1, 1, START, "cancel", 0), (1, 1, 2, START, "ack", 0)], LEDGER)
    done = F.lit(2)
    again = queue.redeliveries(log, ledger, done, F.lit(START + timedelta(seconds=1)))
    assert rows(again, "id", "next_delivery") == [(1, 2)]
    assert queue.pending_at_most_once(log, ledger).collect() == []
    assert rows(queue.pending(log, queue.acknowledged(ledger, done)), "id") == [(1,)]
    assert queue.acknowledged(ledger, F.lit(1)).collect() == []


def test_queue_statuses_partition_the_messages(spark):
    t = START
    log = make_log(spark, [("publish", i, str(i), i) for i in range(6)])
    ledger = spark.createDataFrame(
        [(0, 1, 1, t, "ack", 0), (1, 1, 1, t, "none", 0), (2, 1, 1, t + timedelta(seconds=100), "none", 0),
         *[(3, n, 1, t, "cancel", 0) for n in (1, 2, 3)], (4, 1, 9, t, "ack", 0)], LEDGER)
    now = F.lit(t + timedelta(seconds=110))
    rules = QueueRules(lease_s=30, ttl_s=3600)
    out = queue.status(log, ledger, F.lit(5), now, rules)
    assert rows(out, "bookmark", "status") == [
        (0, "done"), (1, "pending"), (2, "leased"), (3, "failed"), (4, "pending"), (5, "pending")]
    late = queue.status(log, ledger, F.lit(5), F.lit(datetime(2025, 1, 1)), rules)
    assert {r.status for r in late.collect()} == {"done", "failed", "expired"}
    assert rows(queue.lapsed_leases(ledger, F.lit(5), now, 30), "bookmark") == [(1,)]


def test_backlog_counts_messages_in_flight(spark):
    waiting = spark.createDataFrame([(i, i % 2) for i in range(10)], "bookmark BIGINT, consumer BIGINT")
    flying = spark.createDataFrame([(100, 0)], "bookmark BIGINT, consumer BIGINT")
    out = queue.backlog_window(waiting, flying, 2)
    assert rows(out, "consumer", "bookmark") == [(0, 0), (1, 1), (1, 3)]
    assert queue.backlog_window(waiting, flying, 1).count() == 1
