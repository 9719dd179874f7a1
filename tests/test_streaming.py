"""Streams in several micro-batches against the batch operators."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from helpers import START
from tidelog.operators import aggregate, changes, sequence, state
from tidelog.plans.sequences import coin
from tidelog.session import scratch_folder
from tidelog.sources import indexed, synthetic, topics
from tidelog.streaming import jobs, keyed, sinks

FIELDS = list(topics.FIELDS)


@pytest.fixture(scope="module")
def topic(spark):
    """The small event log as a topic of three files, oldest first."""
    folder = scratch_folder(spark, "test-topic")
    log = topics.event_log(spark, "/root/testdata/sf0.001").drop("data", "flag")
    for part in range(3):
        (log.filter(F.floor(F.col("bookmark") / 340) == part).coalesce(1)
         .write.mode("append").parquet(folder))
    return log, folder


def stream(spark, topic):
    log, folder = topic
    return topics.stream_topics(spark, folder, log.schema, files_per_trigger=1)


def same(a, b):
    key = lambda r: tuple(str(v) for v in r)
    columns = sorted(a.columns)
    assert sorted(map(tuple, a.select(columns).collect()), key=key) == sorted(
        map(tuple, b.select(columns).collect()), key=key)


def test_latest_state(spark, topic):
    got = jobs.latest_state(spark, stream(spark, topic), ["id"], FIELDS, scratch_folder(spark, "t"))
    same(got, state.state_at(topic[0], ["id"], FIELDS))


def test_view(spark, topic):
    got = jobs.continuous_view(spark, stream(spark, topic), scratch_folder(spark, "t"))
    want = state.grouped_view(state.state_at(topic[0], ["id"], FIELDS))
    same(got.selectExpr("grp", "round(double(sum_ask), 6) a", "round(double(sum_bid), 6) b", "n"),
         want.selectExpr("grp", "round(coalesce(sum_ask, 0), 6) a", "round(coalesce(sum_bid, 0), 6) b", "n"))


def test_deltas(spark, topic):
    same(jobs.delta_stream(stream(spark, topic), FIELDS, scratch_folder(spark, "t")),
         changes.delta_subscribe(topic[0], ["id"], FIELDS))


HISTORY = ["id", "bookmark", "command", "had", *[f"prev_{f}" for f in FIELDS], *FIELDS]


@pytest.mark.parametrize("expires", [False, True])
def test_record_changes_agree_with_the_batch(spark, topic, expires):
    want = changes.history(topic[0], ["id"], FIELDS, expires=expires).select(HISTORY)
    got = jobs.stored(keyed.record_changes(stream(spark, topic), ["id"], FIELDS, expires=expires),
                      scratch_folder(spark, "t"))
    if expires:  # the stream also tells of records that no later message finds gone
        at_end = state.with_expiry(topic[0], ["id"], FIELDS).filter("expired")
        assert want.filter("command = 'expired'").count() > 0
        want = want.unionByName(at_end.selectExpr(
            "id", "bookmark", "'expired' AS command", "true AS had", *[f"{f} AS prev_{f}" for f in FIELDS],
            *[f"CASE WHEN false THEN {f} END AS {f}" for f in FIELDS]))
    same(got.select(HISTORY), want)


def test_state_is_read_back_after_a_restart(spark, topic):
    log, _ = topic
    folder = scratch_folder(spark, "restart-state")
    for part in (F.col("bookmark") < 300, F.col("bookmark").between(300, 699), F.col("bookmark") >= 700):
        log.filter(part).coalesce(1).write.mode("append").parquet(f"{folder}/topic")
        rows = topics.stream_topics(spark, f"{folder}/topic", log.schema)
        got = jobs.stored(keyed.record_changes(rows, ["id"], FIELDS), folder)
    same(got.select(HISTORY), changes.history(log, ["id"], FIELDS).select(HISTORY))


def written(spark, rows, folder):
    """Log rows (command, id, num, second, expiration) as one file behind the others."""
    full = [(i, START + timedelta(seconds=t), c, k, n, e) for i, c, k, n, t, e in rows]
    made = spark.createDataFrame(full, TIMED)
    made.coalesce(1).write.mode("append").parquet(folder)


TIMED = "bookmark BIGINT, ts TIMESTAMP, command STRING, id BIGINT, num BIGINT, expiration_s INT"


def test_an_expired_record_leaves_without_a_message_of_its_key(spark):
    folder = scratch_folder(spark, "timers")
    batches = [[(0, "publish", 1, 5, 0, 10), (1, "publish", 2, 6, 1, None), (2, "publish", 3, 7, 2, 0)],
               [(3, "publish", 4, 8, 9, 100)],
               [(4, "delta_publish", 2, None, 10, 5)],  # the clock reaches the end of key 1
               [(5, "delta_publish", 1, None, 12, None), (6, "publish", 4, 9, 13, 1)],
               [(7, "delta_publish", 4, None, 16, None), (8, "sow_delete", 2, None, 16, None)]]
    for rows in batches:
        written(spark, rows, f"{folder}/topic")
        source = topics.stream_topics(spark, f"{folder}/topic", TIMED, files_per_trigger=1)
        got = jobs.stored(keyed.record_changes(source, ["id"], ["num"], expires=True), folder)
    found = {tuple(r) for r in got.select("bookmark", "id", "command", "num", "prev_num", "had").collect()}
    assert found == {
        (0, 1, "publish", 5, None, False), (1, 2, "publish", 6, None, False), (2, 3, "publish", 7, None, False),
        (2, 3, "expired", None, 7, True), (3, 4, "publish", 8, None, False), (4, 2, "delta_publish", 6, 6, True),
        (0, 1, "expired", None, 5, True), (5, 1, "delta_publish", None, None, False), (6, 4, "publish", 9, 8, True),
        (6, 4, "expired", None, 9, True), (7, 4, "delta_publish", None, None, False),
        (4, 2, "expired", None, 6, True), (8, 2, "sow_delete", None, None, False)}
    log = spark.read.parquet(f"{folder}/topic")
    same(jobs.out_of_focus_stream(topics.stream_topics(spark, f"{folder}/topic", TIMED, 1), ["num"], "/num > 5",
                                  scratch_folder(spark, "oof"), expires=True),
         changes.out_of_focus(log, ["id"], ["num"], "/num > 5", expires=True))


@pytest.mark.parametrize("now, live", [(9, {1, 2, 3}), (10, {2, 3}), (12, {2})])
def test_one_rule_of_expiry(spark, now, live):
    rows = [(0, "publish", 1, 5, 0, 10), (1, "publish", 2, 6, 1, None), (2, "publish", 3, 7, 2, 10), (3, "publish", 2, 6, now, -1)]
    folder = scratch_folder(spark, "rule")
    written(spark, rows, folder)
    log = spark.read.parquet(folder)
    moment = F.lit(START + timedelta(seconds=now))
    assert {r["id"] for r in state.state_at(log, ["id"], ["num"], expires=True).collect()} == live
    assert {r["id"] for r in state.with_expiry(log, ["id"], ["num"], moment).filter("NOT expired").collect()} == live
    grid = state.history_grid(log, ["id"], ["num"], start=moment, step_s=1, points=1, expires=True)
    assert {r["id"] for r in grid.collect()} == live
    left = changes.out_of_focus(log, ["id"], ["num"], "/num > 0", expires=True).collect()
    assert {(r["id"], r["reason"]) for r in left} == {(k, "expired") for k in {1, 2, 3} - live}
    assert {r["id"] for r in state.state_at(log, ["id"], ["num"]).collect()} == {1, 2, 3}


# A topic with a position index.


@pytest.fixture(scope="module")
def blocks(spark):
    folder = scratch_folder(spark, "blocks")
    log = topics.event_log(spark, "/root/testdata/sf0.001").select("topic", "bookmark", "ts", "command", "id", *FIELDS)
    for low in (0, 400, 800):
        indexed.append(log.filter(F.col("bookmark").between(low, low + 399)), folder, 100)
    return log, folder


@pytest.mark.parametrize("start", ["", "0", "437", "999", "20240110T000000Z", "[20240105T000000:20240110T000000)", "(200:300]"])
def test_reads_open_only_blocks_that_can_match(spark, blocks, start):
    from tidelog.functions.positions import after

    log, folder = blocks
    got, want = indexed.read(spark, folder, log.schema, start), log.filter(after(start))
    same(got, want)
    opened = {f.split("block=")[1].split("/")[0] for f in got.select(F.input_file_name().alias("f")).distinct().toPandas()["f"]}
    can = {r[0] for r in want.select(F.expr("string(bookmark div 100)")).distinct().collect()}
    assert opened <= can | ({"4"} if start == "437" else set())
    streamed = jobs.copy_stream(indexed.stream(spark, folder, log.schema, start), scratch_folder(spark, "t"))
    same(streamed, want)


def test_up_to_a_point(spark, blocks):
    log, folder = blocks
    same(indexed.read(spark, folder, log.schema, end="449"), log.filter("bookmark <= 449"))
    same(indexed.read(spark, folder, log.schema, "100", end="20240110T000000Z"),
         log.filter("bookmark > 100 AND ts <= TIMESTAMP '2024-01-10'"))


def test_a_stream_behind_a_point_reads_nothing_before_it(spark, blocks):
    log, folder = blocks
    source = indexed.stream(spark, folder, log.schema, "499")
    query = sinks.run_to_end(source, checkpoint=scratch_folder(spark, "c"), path=scratch_folder(spark, "rows"))
    assert sum(p.numInputRows for p in query.recentProgress) == log.filter("bookmark >= 500").count()


def test_a_live_tail_gives_new_messages_only(spark, blocks):
    log, _ = blocks
    folder, out = scratch_folder(spark, "tail"), scratch_folder(spark, "tail-out")
    indexed.append(log.filter("bookmark < 350"), folder, 100)
    start = indexed.newest(spark, folder)
    assert start == "349"
    indexed.append(log.filter("bookmark BETWEEN 350 AND 700"), folder, 100)
    same(jobs.copy_stream(indexed.stream(spark, folder, log.schema, start), out), log.filter("bookmark BETWEEN 350 AND 700"))
    indexed.append(log.filter("bookmark > 700"), folder, 100)
    same(jobs.copy_stream(indexed.stream(spark, folder, log.schema, start), out), log.filter("bookmark > 349"))


@pytest.mark.parametrize("as_deltas, top", [(False, None), (True, None), (False, 3)])
def test_snapshot_hand_over(spark, blocks, as_deltas, top):
    log, folder = blocks[0].withColumn("topic", F.lit("all")), scratch_folder(spark, "in-order")
    for low in range(0, 1000, 200):
        indexed.append(log.filter(F.col("bookmark").between(low, low + 199)), folder, 200)
    seen = F.col("bookmark") <= 450
    snapshot = state.state_at(indexed.read(spark, folder, log.schema, end="450"), ["id"], FIELDS)
    got = jobs.snapshot_and_changes(snapshot, indexed.stream(spark, folder, log.schema, "450", maxFilesPerTrigger="1"), FIELDS,
                                    scratch_folder(spark, "t"), as_deltas=as_deltas, top=top)
    if as_deltas:
        want = changes.sow_and_delta_subscribe(log, ["id"], FIELDS, seen)
    else:
        want = changes.sow_and_subscribe(log, ["id"], FIELDS, seen, top=top)
    same(got, want)


def test_changelog(spark, topic):
    one, cents = F.lit(1).cast("bigint"), F.coalesce((aggregate.exact("bid", "decimal(18,2)") * 100).cast("bigint"), F.lit(0).cast("bigint"))
    got = jobs.changelog_stream(stream(spark, topic).withColumns({"n": one, "cents": cents}),
                                ["n", "cents"], scratch_folder(spark, "t"))
    same(got, changes.aggregate_changelog(topic[0], ["id"], "bookmark", {"n": one, "cents": cents}))


def test_command_memory(spark, topic):
    rows = topic[0].select("id", "bookmark")
    got = jobs.command_stream(stream(spark, topic).select("id", "bookmark"), coin("bookmark"),
                              scratch_folder(spark, "t"))
    same(got, sequence.choose_commands(rows, ["id"], "bookmark", coin("bookmark")))


def test_windows_update_and_append(spark, topic):
    want = aggregate.price_windows(topic[0], "topic", "ts", "1 hour")
    update = jobs.window_totals(spark, stream(spark, topic), "topic", "1 hour", scratch_folder(spark, "t"))
    assert update.count() == want.count()
    same(update.selectExpr("topic", "window_start", "records", "round(bid_sum, 2) b"),
         want.selectExpr("topic", "window_start", "records", "round(bid_sum, 2) b"))
    # append only hands on windows the watermark has passed
    appended = jobs.window_totals(spark, stream(spark, topic), "topic", "1 hour",
                                  scratch_folder(spark, "t"), mode="append")
    last = topic[0].agg(F.max("ts")).first()[0]
    same(appended.select("topic", "window_start", "records"),
         want.filter(F.col("window_end") <= F.lit(last)).select("topic", "window_start", "records"))


def test_late_rows_are_dropped_as_the_batch_form_says(spark):
    rnd = random.Random(5)
    moments = [(a, START + timedelta(seconds=max(0, a * 10 - rnd.choice([0, 0, 5, 600])))) for a in range(60)]
    rows = spark.createDataFrame(moments, "arrival BIGINT, ts TIMESTAMP")
    folder = scratch_folder(spark, "late")
    for batch in range(3):
        rows.filter(F.floor(F.col("arrival") / 20) == batch).coalesce(1).write.mode("append").parquet(folder)
    late = sequence.late_rows(rows, "arrival", "ts", 20, 60)
    kept = rows.join(late.select("arrival"), "arrival", "left_anti")
    windows = aggregate.tumbling(topics.stream_topics(spark, folder, rows.schema, 1), [], "ts", "60 seconds",
                                 {"n": F.count("*")}, ascending=True)
    out = scratch_folder(spark, "late-out")
    sinks.run_to_end(windows, checkpoint=f"{out}/c", mode="update", each=sinks.idempotent_append(f"{out}/u"))
    got = sinks.newest_per_key(sinks.read_batches(spark, f"{out}/u", windows.schema),
                               ["window_start", "window_end"])
    assert late.count() > 0
    same(got.select("window_start", "n"),
         aggregate.tumbling(kept, [], "ts", "60 seconds", {"n": F.count("*")}).select("window_start", "n"))


def test_restart_goes_on_after_the_last_message(spark, topic):
    log, _ = topic
    folder = scratch_folder(spark, "restart")
    for part in (F.col("bookmark") < 400, F.col("bookmark") >= 400):
        log.filter(part).write.mode("append").parquet(f"{folder}/topic")
        sinks.run_to_end(topics.stream_topics(spark, f"{folder}/topic", log.schema),
                         checkpoint=f"{folder}/c", path=f"{folder}/rows")
    same(spark.read.parquet(f"{folder}/rows"), log)


def test_repeated_batch_leaves_no_copies_and_marks_are_kept(spark, topic):
    log, _ = topic
    folder = scratch_folder(spark, "repeat")
    write = sinks.idempotent_append(folder)
    for _ in range(2):
        write(log, 7)
    assert sinks.read_batches(spark, folder, log.schema).count() == log.count()
    rows = log.select(F.lit("w").alias("writer"), "bookmark")
    marks = spark.createDataFrame([("w", 499)], "writer STRING, high_water BIGINT")
    out = scratch_folder(spark, "marks")
    sinks.resuming_append(out, "writer", "bookmark", marks)(rows, 0)
    assert sinks.read_batches(spark, out, rows.schema).agg(F.min("bookmark")).first()[0] == 500


def test_a_reader_of_a_repeated_batch_sees_old_or_new_rows(spark, topic, monkeypatch):
    """Reads between every step of a repeated write: never none, never both."""
    log, _ = topic
    folder = scratch_folder(spark, "commits")
    write = sinks.idempotent_append(folder)
    assert sinks.read_batches(spark, folder, log.schema).count() == 0
    write(log.filter("bookmark < 100"), 3)
    seen = []

    def put(*args):
        seen.append(sinks.read_batches(spark, folder, log.schema).count())
        return real(*args)

    real = sinks.commits.put
    monkeypatch.setattr(sinks.commits, "put", put)
    write(log.filter("bookmark < 50"), 3)
    during = sinks.read_batches(spark, folder, log.schema)  # planned before the files that it reads are replaced
    write(log.filter("bookmark < 60"), 3)
    assert seen == [100, 50] and during.count() == 50
    assert sinks.read_batches(spark, folder, log.schema).count() == 60
    sinks.drop_replaced(spark, folder)
    got = sinks.read_batches(spark, folder, log.schema)
    assert got.count() == 60 and {r["batch_id"] for r in got.select("batch_id").distinct().collect()} == {3}


def test_a_failed_attempt_is_not_read(spark, topic):
    log, _ = topic
    folder = scratch_folder(spark, "half")
    write = sinks.idempotent_append(folder)
    write(log.filter("bookmark < 10"), 0)
    log.write.parquet(f"{folder}/run_id=none/batch_id=1/attempt=dead")
    assert sinks.read_batches(spark, folder, log.schema).count() == 10


def totals_table(path, buckets=8):
    from pyspark.sql.types import StructType

    from tidelog.streaming.table import KeyedTable

    return KeyedTable(path, ["id"], StructType.fromDDL("id BIGINT, n BIGINT"), [F.sum("n").alias("n")], buckets)


def test_a_batch_rewrites_only_the_buckets_it_touches(spark):
    from tidelog.streaming import commits

    path = scratch_folder(spark, "table")
    table = totals_table(path)
    rows = spark.range(200).selectExpr("id", "id AS n")
    table.upsert(rows, 0)
    before = table._version(spark)["folders"]
    table.upsert(spark.createDataFrame([(7, 1), (7, 2), (None, 5)], "id BIGINT, n BIGINT"), 1)
    after = table._version(spark)["folders"]
    assert len(before) == 8 and 1 <= sum(before[b] != after[b] for b in before) <= 2
    want = {**{i: i for i in range(200)}, 7: 10, None: 5}
    assert {r["id"]: r["n"] for r in table.read(spark).collect()} == want
    table.upsert(rows, 1)  # a repeated batch
    assert {r["id"]: r["n"] for r in table.read(spark).collect()} == want
    open_read = table.read(spark)
    table.upsert(spark.createDataFrame([(i, -i) for i in range(100)], "id BIGINT, n BIGINT"), 2, keep="n <> 0")
    assert {r["id"] for r in open_read.collect()} == set(want)  # its version's files are still there
    assert {r["id"] for r in table.read(spark).collect()} == {7, None, *range(100, 200)}
    for batch in range(3, 9):
        table.upsert(spark.createDataFrame([(5, 1)], "id BIGINT, n BIGINT"), batch)
    assert len(commits.names(spark, f"{path}/versions")) == 3
    assert table.read(spark).filter("id = 5").first()["n"] == 6
    assert table.read(spark).count() == 103
    assert totals_table(scratch_folder(spark, "none")).read(spark).count() == 0


def test_a_writer_without_its_turn_is_refused(spark):
    from tidelog.streaming import commits

    folder = scratch_folder(spark, "turns")
    commits.put(spark, folder, "1", {"a": 1})
    with pytest.raises(RuntimeError, match="another writer"):
        commits.put(spark, folder, "1", {"a": 2})
    assert commits.entries(spark, folder) == [{"a": 1}]


def test_publish_guarantees(spark, topic):
    rows = stream(spark, topic).select(F.lit("w").alias("writer"), "bookmark")
    for guarantee, extra in (("at_least_once", {}), ("exactly_once", dict(writer="writer", ts="bookmark"))):
        out = scratch_folder(spark, "guarantee")
        sinks.publish_stream(rows, f"{out}/rows", f"{out}/c", guarantee, **extra)
        assert spark.read.parquet(f"{out}/rows").count() == topic[0].count()
    with pytest.raises(ValueError):
        sinks.publish_stream(rows, "x", "y", "exactly_once")
    with pytest.raises(ValueError):
        sinks.publish_stream(rows, "x", "y", "perhaps")


def test_generators_repeat_and_stay_in_range(spark):
    made = synthetic.market_data(synthetic.numbers(spark, 2000, 3))
    again = synthetic.market_data(synthetic.numbers(spark, 2000, 7))
    same(made, again)
    facts = made.agg(F.countDistinct("symbol"), F.min("bid"), F.max("bid"), F.max(F.length("data"))).first()
    assert facts[0] == 49 and 0 <= facts[1] < facts[2] < 1000 and facts[3] == 450
    breaks = synthetic.block_breaks(synthetic.numbers(spark, 5000))
    share = {r.playerId: r.s for r in breaks.groupBy("playerId").agg(
        F.avg(F.col("isDiamond").cast("int")).alias("s")).collect()}
    assert share[0] > 0.4 and max(v for k, v in share.items() if k) < 0.1
    assert synthetic.ticking_numbers(spark, 5).isStreaming


def test_counters_are_taken_in_passing(spark, topic):
    seen = Observation("io")
    aggregate.observe_io(topic[0].withColumn("data", F.lit("four")), seen).write.format("noop").mode(
        "overwrite").save()
    assert seen.get == {"records": topic[0].count(), "bytes": 4 * topic[0].count()}


# Jobs that keep running.


def test_two_queries_run_at_once_and_end_together(spark, topic):
    from tidelog.streaming.running import Job

    folder = scratch_folder(spark, "pair")
    rows = stream(spark, topic).select("topic", "bookmark")
    with Job(spark) as job:
        slow = job.start(rows, f"{folder}/a", path=f"{folder}/rows-a")
        fast = job.start(rows, f"{folder}/b", path=f"{folder}/rows-b")
        job.drain(slow)
        job.drain(fast)
        assert slow.isActive and fast.isActive
        # both go on with what comes later
        topic[0].limit(5).withColumn("bookmark", F.col("bookmark") + 10_000).coalesce(1).write.mode("append").parquet(f"{folder}/more")
    assert not slow.isActive and not fast.isActive
    assert spark.read.parquet(f"{folder}/rows-a").count() == spark.read.parquet(f"{folder}/rows-b").count() == topic[0].count()


def test_failure_of_one_query_ends_the_job(spark, topic):
    from tidelog.streaming.running import Job

    def fails(batch, batch_id):
        raise RuntimeError("no more")

    folder = scratch_folder(spark, "failing")
    rows = stream(spark, topic).select("bookmark")
    with pytest.raises(Exception, match="no more"), Job(spark) as job:
        good = job.start(rows, f"{folder}/a", path=f"{folder}/rows")
        job.start(rows, f"{folder}/b", each=fails)
        job.wait(lambda: False)
    assert not good.isActive


def test_a_processing_time_trigger_takes_what_comes_later(spark, topic):
    from tidelog.streaming.running import Job

    folder, log = scratch_folder(spark, "later"), topic[0].select("topic", "bookmark")
    log.filter("bookmark < 100").coalesce(1).write.parquet(f"{folder}/topic")
    with Job(spark) as job:
        query = job.start(topics.stream_topics(spark, f"{folder}/topic", log.schema), f"{folder}/c", path=f"{folder}/rows",
                          every="200 milliseconds")
        job.drain(query)
        assert spark.read.parquet(f"{folder}/rows").count() == 100
        log.filter("bookmark >= 100").coalesce(1).write.mode("append").parquet(f"{folder}/topic")
        job.drain(query)
        assert spark.read.parquet(f"{folder}/rows").count() == log.count()


def test_counters_of_a_running_job_and_its_failure(spark, topic):
    from tidelog.streaming.running import Counters, Job

    folder = scratch_folder(spark, "counted")
    counters = Counters(f"{folder}/log")
    rows = stream(spark, topic).withColumn("data", F.lit("four"))

    def fails(batch, batch_id):
        raise RuntimeError("refused")

    with counters, Job(spark) as job:
        query = job.start(counters.watched(rows, "all"), f"{folder}/c", path=f"{folder}/rows", every=None)
        job.wait(lambda: not query.isActive)
        counters.settled(query)
        bad = job.start(rows, f"{folder}/d", each=fails, every=None)
        with pytest.raises(Exception, match="refused"):
            job.wait(lambda: False)
        counters.settled(bad)
    found = counters.table(spark).collect()
    good = [r for r in found if r["error"] is None]
    assert sorted(r["batch"] for r in good) == [0, 1, 2] and {r["name"] for r in good} == {"all"}
    assert sum(r["records"] for r in good) == topic[0].count() and sum(r["bytes"] for r in good) == 4 * topic[0].count()
    assert ["refused" in r["error"] for r in found if r["error"]] == [True]


def test_counters_of_a_session_that_is_not_the_active_one(spark, topic):
    from tidelog.streaming.running import Counters, Job

    other, folder = spark.newSession(), scratch_folder(spark, "other-session")
    counters = Counters(f"{folder}/log")
    with counters, Job(other) as job:
        rows = stream(other, topic).withColumn("data", F.lit("four"))
        query = job.start(counters.watched(rows, "all"), f"{folder}/c", path=f"{folder}/rows", every=None)
        job.wait(lambda: not query.isActive)
        counters.settled(query, 20)
    assert [tuple(r) for r in counters.table(other).groupBy("name").agg(F.sum("records")).collect()] == [("all", topic[0].count())]


def test_answers_of_a_queue(spark):
    from tidelog.streaming import queues

    folder = scratch_folder(spark, "queue")
    sent = [[(1, 1, 0), (2, 1, 5), (3, 1, 6)], [(4, 1, 40), (2, 2, 41)], [(5, 1, 100)], [(6, 1, 200)]]
    told = [[(1, 1, 10, "ack"), (3, 1, 11, "cancel")], [(2, 1, 45, "ack"), (4, 1, 50, "ack")], [(9, 9, 101, "ack")], [(9, 9, 201, "ack")]]
    schemas = ("bookmark BIGINT, delivery BIGINT, delivered_at TIMESTAMP",
               "bookmark BIGINT, delivery BIGINT, answered_at TIMESTAMP, outcome STRING")
    streams = []
    for name, batches, schema in zip(("sent", "told"), (sent, told), schemas):
        for rows in batches:
            made = [(b, n, START + timedelta(seconds=t), *rest) for b, n, t, *rest in rows]
            spark.createDataFrame(made, schema).coalesce(1).write.mode("append").parquet(f"{folder}/{name}")
        streams.append(spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(f"{folder}/{name}"))
    got = jobs.stored(queues.again(queues.answered(*streams, 30)), f"{folder}/out")
    # the answer to (2, 1) came 40 s later and counts for nothing; (5, 1) has lapsed, (6, 1) is still out
    assert sorted(tuple(r) for r in got.collect()) == [(2, 1, "lapsed", 2), (2, 2, "lapsed", 3), (3, 1, "cancelled", 2), (5, 1, "lapsed", 2)]


# User code.


def test_user_code_gets_a_window_batch_by_batch(spark):
    from pyspark.sql.types import StructType

    from tidelog.functions import custom

    seen_batches = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        rows = spark.range(1000).selectExpr("id % 2 AS k", "timestamp_seconds(id div 500 * 60) AS ts", "id")

        def work(key, batches):
            sizes = [b.num_rows for b in batches]
            yield key[0], key[1], len(sizes), sum(sizes)

        got = custom.per_window(rows, ["k"], "ts", "1 minute", work,
                                StructType.fromDDL("k BIGINT, start TIMESTAMP, batches BIGINT, n BIGINT")).collect()
        assert len(got) == 4 and {r["n"] for r in got} == {250} and {r["batches"] for r in got} == {3}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", seen_batches)
    empty = custom.per_window(rows.limit(0), ["k"], "ts", "1 minute", work, StructType.fromDDL("k BIGINT"))
    assert empty.count() == 0


def test_user_code_takes_many_keys_in_one_exchange(spark):
    """Nulls and NaN are keys, keys go on over batches, rows may be left unread; a key has no group of its own in the plan."""
    from pyspark.sql.types import StructType

    from tidelog.functions import custom

    class Numbered:
        def __init__(self):
            self.n = 0

        def eval(self, row):
            self.n += 1
            yield row["k"], row["id"], self.n

    seen_batches = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = spark.range(300).selectExpr(
            "id", "CASE id % 5 WHEN 0 THEN NULL WHEN 1 THEN double('NaN') WHEN 2 THEN -0.0D WHEN 3 THEN 0.0D ELSE 1.0D END AS k",
            "timestamp_seconds(id div 50 * 60) AS ts")
        numbered = custom.rows_per_key(rows, Numbered, "k DOUBLE, id BIGINT, n BIGINT", ["k"], "id")
        counts = sorted(r["n"] for r in numbered.groupBy("k").agg(F.max("n").alias("n")).collect())
        assert counts == [60, 60, 60, 120] and numbered.count() == 300

        def first(key, batches):
            yield key[1], next(batches).num_rows > 0

        windows = custom.per_window(rows, ["k"], "ts", "1 minute", first, StructType.fromDDL("start TIMESTAMP, any BOOLEAN"))
        assert windows.count() == 6 * 4
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", seen_batches)
    for made in (numbered, windows):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "MapInArrow" in plan and "FlatMapGroups" not in plan and "UDTF" not in plan
