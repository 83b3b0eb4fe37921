"""Filters, joins, subqueries and windows on the small order tables, plain and with hot keys."""

from datetime import timedelta

import pytest
from pyspark.sql import Window, functions as F

from helpers import D, day, plan_of, same, tuples
from tidemart.operators import ordered
from tidemart.operators.relational import (
    above_average_customers, all_customers, customer_rank, customers_full_orders, customers_with_orders, filter_eq,
    filter_gt, order_asc, order_desc, order_sequence, orders_right_customers, orphans, ranked_customers, recent,
    recent_orders_by_customer, revenue_per_customer, running_total, with_customer_total,
)

AS_OF = day("2026-04-03")


@pytest.fixture(scope="module")
def customers(spark):
    rows = [(1, "Nguyen Van A", "Hanoi"), (2, "Tran Thi B", "HCMC"), (3, "Le Van C", "Da Nang"), (4, "Pham Thi D", "Hanoi")]
    return spark.createDataFrame(rows, "id int, name string, city string")


@pytest.fixture(scope="module")
def orders(spark):
    rows = [(1, 1, 1, 5, "1500.00"), (2, 1, 2, 40, "50.00"), (3, 2, 3, 2, "100.00"), (4, 3, 4, 15, "300.00"), (5, 1, 4, 20, "300.00"), (6, 2, 1, 10, "1500.00")]
    dated = [(o, c, p, AS_OF - timedelta(days=d), D(a)) for o, c, p, d, a in rows]
    return spark.createDataFrame(dated, "order_id int, customer_id int, product_id int, order_date date, amount decimal(10,2)")


@pytest.fixture(scope="module")
def skewed(spark):
    """One customer with a third of the rows, ties on date, NULL keys, NULL amounts and NULL dates."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 11 == 0, None).otherwise(F.col("id") % 20)
    return spark.range(3000).select(
        F.col("id").alias("order_id"),
        key.cast("int").alias("customer_id"),
        F.when(F.col("id") % 101 != 0, F.date_add(F.lit("2026-01-01"), (F.col("id") % 17).cast("int"))).alias("order_date"),
        F.when(F.col("id") % 13 != 0, (F.col("id") % 50).cast("decimal(10,2)")).alias("amount"),
    )


def test_filters(orders):
    assert tuples(filter_gt(orders, "amount", 100), "order_id") == [(1,), (4,), (5,), (6,)]
    assert tuples(recent(orders, "order_date", 30, AS_OF), "order_id") == [(1,), (3,), (4,), (5,), (6,)]
    assert tuples(recent(orders, "order_date", 40, AS_OF), "order_id")[1] == (2,)
    assert tuples(filter_eq(orders, customer_id=1), "order_id") == [(1,), (2,), (5,)]
    assert [r.order_id for r in order_desc(orders, "order_date").collect()] == [3, 1, 6, 4, 5, 2]
    assert [r.order_id for r in order_asc(orders, "order_date").collect()] == [2, 5, 4, 6, 1, 3]


def test_joins(customers, orders):
    assert customers_with_orders(customers, orders).count() == 6
    for joined in (all_customers(customers, orders), orders_right_customers(orders, customers), customers_full_orders(customers, orders)):
        got = tuples(joined, "name", "order_id", "amount")
        assert len(got) == 7 and ("Pham Thi D", None, None) in got
    assert tuples(recent_orders_by_customer(customers, orders, AS_OF), "name", "order_id")[0] == ("Le Van C", 4)


@pytest.mark.parametrize("how", ["left", "right", "full"])
def test_outer_joins_with_hot_keys_equal_the_plain_join(spark, skewed, how):
    customers = spark.createDataFrame([(i, f"c{i}") for i in [1, 2, 3, 7, 99]] + [(None, "none")], "id int, name string")
    on = customers["id"] == skewed["customer_id"]
    if how == "right":
        same(orders_right_customers(skewed, customers, group_rows=100), skewed.join(customers, on, "right"))
    elif how == "left":
        same(all_customers(customers, skewed, group_rows=100), customers.join(skewed, on, "left"))
    else:
        same(customers_full_orders(customers, skewed, group_rows=100), customers.join(skewed, on, "full"))


def test_outer_join_needs_one_key_type(spark, customers, orders):
    with pytest.raises(TypeError):
        all_customers(customers, orders.withColumn("customer_id", F.col("customer_id").cast("string")))


def test_subqueries(orders):
    assert tuples(above_average_customers(orders)) == [(1, D("1850.00")), (2, D("1600.00"))]
    assert tuples(revenue_per_customer(orders)) == [(1, D("1850.00")), (2, D("1600.00")), (3, D("300.00"))]
    assert tuples(ranked_customers(orders), "customer_id", "rank") == [(1, 1), (2, 2), (3, 3)]


def test_windows(orders):
    totals = tuples(running_total(orders), "customer_id", "order_date", "running_total")
    assert [(c, int(t)) for c, _, t in totals] == [(1, 50), (1, 350), (1, 1850), (2, 1500), (2, 1600), (3, 300)]
    seq = tuples(order_sequence(orders), "customer_id", "order_sequence", "order_id")
    assert seq == [(1, 1, 2), (1, 2, 5), (1, 3, 1), (2, 1, 6), (2, 2, 3), (3, 1, 4)]
    assert tuples(customer_rank(orders), "customer_id", "customer_rank", "customer_dense_rank") == [(1, 1, 1), (2, 2, 2), (3, 3, 3)]
    assert {(r.customer_id, int(r.total_customer_amount)) for r in with_customer_total(orders).collect()} == {(1, 1850), (2, 1600), (3, 300)}


@pytest.mark.parametrize("group_rows", [100, 1_000_000])
def test_windows_with_hot_keys_equal_the_plain_window(skewed, group_rows):
    per = Window.partitionBy("customer_id")
    same(running_total(skewed, group_rows=group_rows), skewed.withColumn("running_total", F.sum("amount").over(per.orderBy(F.col("order_date").asc_nulls_last()))))
    by = per.orderBy(F.col("order_date").asc_nulls_last(), F.col("order_id").asc_nulls_last())
    same(order_sequence(skewed, group_rows=group_rows), skewed.withColumn("order_sequence", F.row_number().over(by)))
    same(with_customer_total(skewed, group_rows=group_rows), skewed.withColumn("total_customer_amount", F.sum("amount").over(per)))


def test_rank_with_ties_equals_the_plain_window(skewed):
    totals = skewed.groupBy("order_id").agg(F.sum("amount").alias("total_amount"))
    w = Window.orderBy(F.col("total_amount").desc_nulls_first())
    plain = totals.withColumn("customer_rank", F.rank().over(w).cast("long")).withColumn("customer_dense_rank", F.dense_rank().over(w).cast("long"))
    same(customer_rank(skewed, "order_id"), plain)
    same(ranked_customers(skewed, "order_id").select("order_id", "rank"), plain.select("order_id", F.col("customer_rank").alias("rank")))


def test_hot_keys_are_found(skewed):
    assert ordered.large_keys(skewed, ["customer_id"], 900).count() == 1
    assert ordered.large_keys(skewed, ["customer_id"], 5000).isEmpty()


def test_positions_are_dense_and_in_order(skewed):
    placed = ordered.global_positions(skewed, [F.col("order_date").desc(), F.col("order_id")], "at")
    assert placed.agg(F.min("at"), F.max("at"), F.count_distinct("at")).first() == (1, 3000, 3000)
    w = Window.orderBy(F.col("order_date").desc(), F.col("order_id"))
    same(placed, skewed.withColumn("at", F.row_number().over(w).cast("long")))


def test_copies_of_one_row_are_cut(spark):
    """Half of the rows are one and the same row; every route must keep all of them and spread them."""
    copies = spark.range(2000).select(
        F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("order_id"), F.lit(1).alias("customer_id"),
        F.lit("2026-01-01").cast("date").alias("order_date"), F.lit(D("1.00")).alias("amount"),
    )
    numbered = order_sequence(copies, group_rows=100)
    assert numbered.agg(F.min("order_sequence"), F.max("order_sequence"), F.count_distinct("order_sequence")).first() == (1, 2000, 2000)
    assert [r.order_id for r in numbered.orderBy("order_sequence").collect()] == sorted([0] * 1000 + list(range(1, 2000, 2)))
    pieced = ordered.sorted_pieces(ordered.stamped(copies), [F.col("order_id"), F.col("_stamp")], 8)
    assert pieced.groupBy("_piece").count().agg(F.max("count")).first()[0] < 600
    for laid in (order_desc(copies, "order_id", group_rows=100), order_asc(copies, "order_id", group_rows=100)):
        same(laid, copies)
    assert [r.order_id for r in order_desc(copies, "order_id", group_rows=100).take(2)] == [1999, 1997]


def test_pieces_follow_the_rows_not_the_smallest_large_key(spark, skewed, monkeypatch):
    assert ordered.piece_count(skewed, 3000, 100) == 4
    assert ordered.piece_count(skewed, 54_000_000, 100) == 108
    assert ordered.piece_count(skewed, 54_000_000) == 14
    counts = []
    whole = ordered.sorted_pieces
    monkeypatch.setattr(ordered, "sorted_pieces", lambda df, order, pieces=None: counts.append(pieces) or whole(df, order, pieces))
    few = order_sequence(skewed, group_rows=100)
    monkeypatch.setattr(ordered, "PIECE_ROWS", 100)
    same(few, order_sequence(skewed, group_rows=100))
    assert counts[0] == 4 and counts[1] >= 10


def test_rows_of_one_key_never_meet_in_one_task(spark, skewed, monkeypatch):
    """Without help from statistics: few large keys come to the rows, and the numbers of pieces are joined by piece."""
    off = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in off}
    parts = []
    whole = ordered.stamped
    monkeypatch.setattr(ordered, "stamped", lambda df: parts.append(plan_of(df, "simple")) or whole(df))
    try:
        for name, value in off.items():
            spark.conf.set(name, value)
        one = skewed.withColumn("customer_id", F.when(F.col("order_id") < 0, 1)).withColumn("order_id", F.col("order_id") % 70)
        got = order_sequence(one, group_rows=100)
        assert "BroadcastHashJoin" in parts[0] and "hashpartitioning" not in parts[0]
        assert got.select(F.spark_partition_id()).distinct().count() > 1
        assert sorted(r.order_sequence for r in got.collect()) == list(range(1, 3001))
        by = Window.partitionBy("customer_id").orderBy(F.col("order_date").asc_nulls_last(), "order_id")
        assert got.withColumn("_n", F.rank().over(by)).filter("order_sequence < _n").isEmpty()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_orphans(spark, customers, orders):
    stray = orders.union(spark.createDataFrame([(9, 77, 1, AS_OF, D("1.00")), (10, None, 1, AS_OF, D("1.00"))], orders.schema))
    assert tuples(orphans(stray, customers, "customer_id", "id"), "order_id") == [(9,)]
