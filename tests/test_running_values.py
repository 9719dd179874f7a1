"""Ordered per-key values against a row-by-row model, with limits small enough to cut hot keys."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import make_log, walk
from tidelog.functions.segments import SEGMENT, previous, running, running_row_number, split_hot_keys
from tidelog.operators import changes, read, sequence

FIELDS = ["data", "num"]
LIMITS = [dict(hot=1 << 20, width=1 << 16), dict(hot=5, width=3), dict(hot=0, width=1), dict(hot=20, width=7)]


def random_rows(seed, n=240, keys=6):
    """A third or more of all rows belong to key 0, some to no key."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        key = 0 if rnd.random() < 0.4 else None if rnd.random() < 0.1 else rnd.randrange(1, keys)
        command = rnd.choices(["publish", "delta_publish", "sow_delete"], [4, 5, 2])[0]
        out.append((command, key, rnd.choice([None, "a", "b"]), rnd.choice([None, 1, 2, 3])))
    return out


@pytest.fixture(scope="module")
def sample(spark):
    rows = random_rows(1)
    log = make_log(spark, rows).repartition(5, "num").persist()
    yield rows, log
    log.unpersist()


@pytest.mark.parametrize("limits", LIMITS)
def test_history_matches_walking_the_log(sample, limits):
    rows, log = sample
    _, expected = walk(rows)
    got = {r.bookmark: r for r in changes.history(log, ["id"], FIELDS, **limits).collect()}
    assert len(got) == len(rows)
    for i, (before, after) in enumerate(expected):
        r = got[i]
        assert r.had == (before is not None)
        assert (r.prev_data, r.prev_num) == (before or (None, None)) or not r.had
        if after is not None:
            assert (r.data, r.num) == after


@pytest.mark.parametrize("limits", LIMITS)
def test_out_of_focus_matches(sample, limits):
    rows, log = sample
    _, expected = walk(rows)
    want = sorted(
        (i, "deleted" if after is None else "match") for i, (before, after) in enumerate(expected)
        if before and (before[1] or 0) > 1 and (after is None or not (after[1] or 0) > 1))
    out = changes.out_of_focus(log, ["id"], FIELDS, "/num > 1", **limits)
    assert sorted((r.bookmark, r.reason) for r in out.collect()) == want


@pytest.mark.parametrize("limits", LIMITS)
def test_running_sum_max_last_and_row_number(sample, limits):
    rows, log = sample
    out = running(log, ["id"], "bookmark", sums={"s": "num"}, maxes={"m": "num"}, lasts={"l": "data"}, **limits)
    numbered = running_row_number(log, ["id"], "bookmark", "rn", **limits)
    rn = {r.bookmark: r.rn for r in numbered.collect()}
    seen = {}
    for r in sorted(out.collect(), key=lambda r: r.bookmark):
        s, m, last, n = seen.get(r.id, (None, None, None, 0))
        assert (r.s__before, r.m__before, r.l__before) == (s, m, last)
        if r.num is not None:
            s, m = (s or 0) + r.num, max(m or 0, r.num)
        last, n = r.data if r.data is not None else last, n + 1
        assert (r.s, r.m, r.l, rn[r.bookmark]) == (s, m, last, n)
        seen[r.id] = (s, m, last, n)


@pytest.mark.parametrize("limits", LIMITS)
def test_previous_is_lag_even_of_nulls(sample, limits):
    rows, log = sample
    out = previous(log, ["id"], "bookmark", {"p": "num", "at": "bookmark"}, **limits).collect()
    last = {}
    for r in sorted(out, key=lambda r: r.bookmark):
        assert (r.p, r.at) == last.get(r.id, (None, None))
        last[r.id] = (r.num, r.bookmark)


@pytest.mark.parametrize("limits", LIMITS)
def test_changelog(sample, limits):
    rows, log = sample
    out = changes.aggregate_changelog(log, ["id"], "bookmark", {"n": F.lit(1).cast("bigint"),
                                                               "s": F.coalesce("num", F.lit(0))}, **limits)
    want, totals = [], {}
    for i, (_, key, _, num) in enumerate(rows):
        old = totals.get(key)
        new = ((old[0] if old else 0) + 1, (old[1] if old else 0) + (num or 0))
        want += [(str(key), i, "+I", *new)] if not old else [(str(key), i, "-U", *old), (str(key), i, "+U", *new)]
        totals[key] = new
    assert sorted((str(r.id), r.bookmark, r.op, r.n, r.s) for r in out.collect()) == sorted(want)


@pytest.mark.parametrize("limits", LIMITS)
def test_batched_changelog_ends_where_the_full_one_does(sample, limits):
    rows, log = sample
    measures = {"n": F.lit(1).cast("bigint")}
    out = changes.aggregate_changelog_batched(log, ["id"], "bookmark", measures, 10, **limits).collect()
    last = {}
    for r in sorted(out, key=lambda r: (r.batch, r.op == "+U")):
        if r.op == "-U":
            assert last[r.id] == r.n
        else:
            last[r.id] = r.n
    counts = {}
    for _, key, *_ in rows:
        counts[key] = counts.get(key, 0) + 1
    assert last == counts


@pytest.mark.parametrize("limits", LIMITS)
def test_command_choice(sample, limits):
    rows, log = sample
    out = sequence.choose_commands(log.drop("command"), ["id"], "bookmark",
                                   F.coalesce(F.col("num"), F.lit(0)) > 1, **limits)
    known = set()
    for r in sorted(out.collect(), key=lambda r: r.bookmark):
        want = "publish" if r.id not in known else "sow_delete" if (r.num or 0) > 1 else "delta_publish"
        assert r.command == want, r.bookmark
        known.discard(r.id) if want == "sow_delete" else known.add(r.id)


@pytest.mark.parametrize("limits", LIMITS)
def test_gaps_rates_and_late_rows_without_keys(spark, limits):
    numbers = [n for n in range(200) if n % 7 and n != 50]
    df = spark.createDataFrame([(n,) for n in numbers], "num BIGINT")
    gone = sorted(n for n in range(200) if n not in numbers and n - 2 in numbers)
    ends = {max(n for n in numbers if n % 2 == c) + 2 for c in (0, 1)}
    want = [g for g in gone if g not in ends]
    assert sorted(r.missing for r in sequence.missing_numbers(df, "num", 2).collect()) == want
    arrived = sorted(numbers, key=lambda n: (n % 7, n))
    order = spark.createDataFrame(list(enumerate(arrived)), "arrival BIGINT, num BIGINT")
    blocks = sequence.outstanding_per_block(order, "arrival", "num", 10, **limits).collect()
    assert {r.block: (r.highest, r.outstanding) for r in blocks} == {
        k: (max(arrived[:10 * k]), max(arrived[:10 * k]) + 1 - 10 * k) for k in range(1, len(arrived) // 10 + 1)}
    log = make_log(spark, [("publish", i, "x", i) for i in range(23)])
    paced = read.rate_schedule(log, 5, **limits).collect()
    assert all(r.emit_second == r.bookmark // 5 for r in paced)
    late = sequence.late_rows(log.withColumn("arrival", (F.col("bookmark") * 7) % 23), "arrival", "ts", 4, 2,
                              **limits).collect()
    arrivals = sorted(((b * 7) % 23, b) for b in range(23))
    want_late, mark, seen = set(), None, {}
    for a, b in arrivals:
        seen.setdefault(a // 4, []).append(b)
    for batch in sorted(seen):
        want_late |= {b for b in seen[batch] if mark is not None and b // 2 * 2 + 2 <= mark}
        mark = max([*seen[batch], *([] if mark is None else [mark])])
    assert {r.bookmark for r in late} == want_late


@pytest.mark.parametrize("places", [
    "CASE WHEN id = 0 THEN 0L ELSE 1000000000000 + id END",  # one early message
    "(id div 500) * 1000000000 + id % 500"])  # bursts
def test_bursts_and_outliers_are_cut_too(spark, places):
    df = spark.range(3000).selectExpr("1 AS key", f"{places} AS pos").union(spark.sql("SELECT 1, -1L"))
    tagged = split_hot_keys(df, ["key"], "pos", hot=100, width=50)
    sizes = [r["count"] for r in tagged.groupBy("key", SEGMENT).count().collect()]
    assert max(sizes) <= 101
    out = sorted(running_row_number(df, ["key"], "pos", "rn", hot=100, width=50).collect(), key=lambda r: r.pos)
    assert [r.rn for r in out] == list(range(1, 3002))


@pytest.mark.parametrize("spacing", [1, 1_000_000_007])
def test_segments_hold_their_share_at_any_spacing(spark, spacing):
    df = spark.range(3000).selectExpr("id % 3 AS key", f"id * {spacing}L AS pos").union(
        spark.sql("SELECT 0L, -1L"))
    tagged = split_hot_keys(df, ["key"], "pos", hot=100, width=50)
    sizes = [r["count"] for r in tagged.groupBy("key", SEGMENT).count().collect()]
    assert max(sizes) <= 100 and len(sizes) <= 3 * 21 + 1
    out = running_row_number(df, ["key"], "pos", "rn", hot=100, width=50).collect()
    assert all(r.rn == (r.pos // spacing // 3 + 1 + (r.key == 0) if r.pos >= 0 else 1) for r in out)


@pytest.mark.parametrize("order", ["id", "id * 1000000007", "id + CASE WHEN id > 900 THEN 1000000000000 ELSE 0 END", "id - 500"])
def test_one_sequence_is_cut_by_its_rows_not_by_its_positions(spark, order):
    rows = spark.range(1000).selectExpr(f"{order} AS at", "id")
    from tidelog.functions.segments import SEGMENT, running, split_hot_keys

    sizes = [r["count"] for r in split_hot_keys(rows, [], "at", width=50).groupBy(SEGMENT).count().collect()]
    assert len(sizes) <= 45 and max(sizes) <= 101
    out = running(rows, [], "at", sums={"n": "1L"}, maxes={"top": "id"}, width=50).collect()
    assert sorted((r["id"], r["n"], r["top"]) for r in out) == [(i, i + 1, i) for i in range(1000)]


def test_one_sequence_of_no_rows_and_of_one(spark):
    from tidelog.functions.segments import running

    rows = spark.range(1).selectExpr("id AS at")
    assert [tuple(r) for r in running(rows, [], "at", sums={"n": "1L"}).select("at", "n").collect()] == [(0, 1)]
    assert running(rows.filter("false"), [], "at", sums={"n": "1L"}).collect() == []
