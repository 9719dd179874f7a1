"""The plans that matter at scale: what reaches the scan, what shuffles, what is bounded."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registered
from tidelog.functions.segments import running
from tidelog.operators import read, state
from tidelog.operators.read import Split
from tidelog.plans import catalog
from tidelog.sources import topics

SF = "/root/testdata/sf0.001"
FIELDS = list(topics.FIELDS)


@pytest.fixture(autouse=True)
def whole_plan_text(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(read.subscribe(topics.event_log(spark, SF), ["view"], start="20240116T000000Z").select("bookmark"))
    assert "GreaterThanOrEqual(ts,2024-01-16" in text and "EqualTo(event_type,view)" in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp,event_type:string>" in text
    assert "Exchange" not in text


def test_splits_scan_once(spark):
    splits = {str(i): Split(content_filter=f"/num MOD 4 = {i}") for i in range(4)}
    text = plan(read.read_splits(topics.event_log(spark, SF), splits).select("split_id", "bookmark"))
    assert text.count("FileScan") == 1 and "Exchange" not in text


def test_state_aggregates_before_its_only_shuffle(spark):
    text = plan(state.state_at(topics.event_log(spark, SF), ["id"], FIELDS))
    assert text.count("Exchange") == 1 and "partial_max" in text and "Window" not in text


def test_numeric_state_is_a_hash_aggregate(spark):
    text = plan(state.state_at(topics.event_log(spark, SF), ["id"], ["num", "bid", "ask"]))
    assert "HashAggregate" in text and "SortAggregate" not in text


def test_page_and_split_limits_are_bounded(spark):
    log = topics.event_log(spark, SF)
    assert "TakeOrderedAndProject" in plan(state.page(state.state_at(log, ["id"], FIELDS), ["id"], 5, 2))
    text = plan(read.top_per_split(log.withColumn("split_id", F.col("topic")), 5).select("split_id", "bookmark"))
    assert text.count("WindowGroupLimit") == 2


def test_windows_of_a_hot_key_are_cut(spark):
    log = topics.event_log(spark, SF)
    df = running(log, ["topic"], "bookmark", sums={"n": "1L"}, hot=50, width=100)
    rows = df.select("topic", "bookmark", "n")
    assert rows.count() == log.count()
    text = plan(rows)
    assert "BroadcastHashJoin" in text and "windowspecdefinition(topic" in text and "__segment" in text


def test_no_hot_keys_means_one_shuffle_of_the_rows(spark):
    df = running(topics.event_log(spark, SF), ["id"], "bookmark", sums={"n": "1L"}).select("id", "n")
    df.collect()
    final = plan(df).split("Initial Plan")[0]
    assert "Union" not in final and "BroadcastHashJoin" not in final


@pytest.mark.parametrize("name", [n for n in catalog.QUERIES
                                  if not n.startswith("stream_") and n not in (
                                      "bounded_equals_stream", "at_least_once", "exactly_once_resume")])
def test_no_query_crosses_tables(spark, name):
    text = plan(registered.queries()[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
