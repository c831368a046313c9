"""Shape of physical plans."""

import pytest
from pyspark.sql import functions as F

from conftest import plan
from tillsight.llm.base import prepare
from tillsight.operators import joins as J
from tillsight.operators import ranking as W
from tillsight.operators.aggregates import average_ticket, member_profile
from tillsight.operators.filters import trailing_window
from tillsight.session import tune
from tillsight.workload.views import Views

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def v(spark):
    return Views(spark, FOLDER)


def test_rankings_are_cut_in_the_map_stage(v):
    ranked = plan(W.top_n(v.sku, ["mobile"], "qty", ["item"], 5))
    assert ranked.count("WindowGroupLimit") == 2
    salted = plan(W.top_n(v.sku, ["mobile"], "qty", ["item"], 5000))
    assert "salt" in salted


def test_latest_points_and_line_maximum_use_no_window(v):
    for df in (W.latest_points(v.txn), W.max_line_amount(v.sku), W.scale_scores(v.purchases, "user", "qty")):
        assert "Window" not in plan(df)


def test_gap_window_runs_over_grouped_dates(v):
    text = plan(member_profile(v.txn))
    window = text.index("Window [")
    assert "HashAggregate(keys=[mobile" in text[window:]


def test_distinct_bills_shuffle_on_member_and_bill(v, no_broadcast):
    assert "hashpartitioning(mobile#" in plan(average_ticket(v.txn)).replace("\n", " ")
    assert any("mobile" in part and "bill" in part for part in
               [line for line in plan(average_ticket(v.txn)).splitlines() if "hashpartitioning" in line])


def test_filters_and_columns_reach_the_scan(v, spark):
    members = v.member.filter("tier = 'BUILDING'").select("mobile")
    text = plan(members)
    assert "EqualTo(c_mktsegment,BUILDING)" in text
    assert "ReadSchema: struct<c_custkey:bigint,c_mktsegment:string>" in text
    recent = plan(trailing_window(v.table("orders"), "o_orderdate", "2001-08-01", 365).select("o_orderkey"))
    assert "GreaterThan(o_orderdate" in recent or "o_orderdate" in recent.split("PushedFilters")[1]


def test_join_kinds(v):
    assert "LeftSemi" in plan(J.restrict_to_segment(v.nps, v.segments))
    assert "BroadcastHashJoin" in plan(J.member_store(v.member, v.store))


def test_hot_partition_is_split(spark):
    """A third of all rows share one key: the join splits that partition at run time."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        mobile = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("m"), F.col("id") % 2000))
        sku = spark.range(0, 300000, 1, 16).select(
            mobile.alias("mobile"), F.col("id").alias("bill"), F.rand(1).alias("net"))
        value = sku.groupBy("mobile").agg(F.count("*").alias("value"))
        joined = J.lines_with_value(sku, value)
        # the hot member still meets an aggregation on the same key afterwards
        totals = joined.groupBy("mobile").agg(F.count("*").alias("n"), F.max("value").alias("value"))
        rows = {r.mobile: (r.n, r.value) for r in totals.collect()}
        assert rows["hot"] == (100000, 100000) and sum(n for n, _ in rows.values()) == 300000
        assert "skew=true" in plan(totals).split("Initial Plan")[0]
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_retail_tasks_read_little(spark):
    """Groupings of all lines hold a multiple of what a task reads, so plans of the retail tables read less per task."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before = {name: spark.conf.get(name) for name in names}
    try:
        for name in names:
            spark.conf.unset(name)
        usual = [spark.conf.get(name) for name in names]
        tune(spark)
        assert [spark.conf.get(name) for name in names] == ["32MB", "16MB"]
        prepare(spark)  # corpus operators keep the session's own sizes
        assert [spark.conf.get(name) for name in names] == usual
        spark.conf.set(names[0], "1048576b")
        tune(spark)
        assert [spark.conf.get(name) for name in names] == ["1048576b", "16MB"]  # a smaller size is the caller's
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
