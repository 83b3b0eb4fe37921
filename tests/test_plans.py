"""Physical plans: what is pushed down, broadcast, split, and kept on the JVM."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from helpers import plan_of
from tidemart.operators import ordered
from tidemart.operators.relational import filter_gt, running_total
from tidemart.plans.registered import QUERIES, SQL, warehouse
from tidemart.plans.registered.base import orders, table


def test_filter_and_columns_reach_the_scan(spark, sf):
    plan = plan_of(filter_gt(table(spark, sf, "orders"), "o_totalprice", 100000).select("o_orderkey", "o_totalprice"))
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,100000.0)]" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan


def test_star_join_broadcasts_small_dimensions_and_follows_the_size_limit(spark, sf):
    star = lambda: entry.queries()["mart_daily_category"](spark, sf)
    assert "BroadcastHashJoin" in plan_of(star()) and "CartesianProduct" not in plan_of(star())
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(star())
        assert "BroadcastHashJoin" not in plan and "BroadcastNestedLoopJoin" not in plan and "SortMergeJoin" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


@pytest.mark.parametrize("name", ["daily_sales", "customer_sales", "mart_daily_category", "change_table", "dedup"])
def test_aggregates_reduce_before_the_shuffle(spark, sf, name):
    assert re.search(r"partial_(sum|count|max)", plan_of(entry.queries()[name](spark, sf)))


def test_no_window_runs_in_one_task_over_data(spark, sf):
    totals = orders(spark, sf).groupBy("customer_id").agg(F.sum("amount").alias("total"))
    lines = plan_of(ordered.ranks(totals, "total", group_rows=1), "simple").splitlines()
    assert not any("rank(" in line for line in lines)
    # What is brought to one task is one row per piece.
    singles = [i for i, line in enumerate(lines) if "SinglePartition" in line]
    assert singles and all("HashAggregate(keys=[_piece" in lines[i + 1] for i in singles)


def test_hot_keys_are_split_by_piece(spark, sf):
    plan = plan_of(running_total(orders(spark, sf), "status", group_rows=100))
    assert re.search(r"hashpartitioning\(_piece#\d+, status", plan)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_queries_stay_on_the_jvm(spark, sf):
    skipped = {"on_demand_pandas", "on_demand_passes_columns"}
    light = [n for n in QUERIES if n not in skipped and not n.startswith(("stream", "change_stream"))]
    for name in light:
        plan = plan_of(QUERIES[name](spark, sf), "simple")
        assert "Python" not in plan and "InPandas" not in plan, name
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["order_date", "payment_method", "total_orders", "total_revenue"] and df.count() > 0


def test_every_query_has_its_sql():
    assert set(SQL) == set(QUERIES)


def test_fact_reads_only_needed_columns(spark, sf):
    plan = plan_of(warehouse.gold.revenue_by_day(warehouse.fact(spark, sf)))
    assert "l_discount" not in plan and "o_orderstatus" not in plan
