"""Star schema, dimensions with history, keys, mart and dashboard queries."""

import pytest
from pyspark.sql import functions as F

from helpers import D, day, same, tuples
from tidemart.functions.scalars import with_defaults
from tidemart.operators.dimensions import (
    Tracking, assign_keys, date_dim, date_dim_of, dim_history, refused_changes, scd1, scd2, scd6,
)
from tidemart.operators.gold import revenue_by_customer, revenue_by_day, star_orders
from tidemart.plans.warehouse import build_mart, load_dimension, start_dimension
from tidemart.sources.tables import add_rows, fold, publish, read_table
from tidemart.sources.writers import append, create_table_as, create_zones, drop_tables

TRACK = Tracking(previous={"city": "previous_city"}, current={"city": "current_city"})
DIM = (
    "customer_key int, customer_id int, full_name string, city string, segment string, effective_date date, "
    "end_date date, current_flag boolean, previous_city string, current_city string"
)
START = day("2026-01-01")


@pytest.fixture(scope="module")
def dim(spark):
    rows = [(1, 101, "Alice Nguyen", "Hanoi", "Retail"), (2, 102, "Bao Tran", "Danang", "Retail"), (3, 103, "Chi Le", "HCMC", "Corporate")]
    return spark.createDataFrame([(*r, START, None, True, None, r[3]) for r in rows], DIM)


@pytest.fixture(scope="module")
def products(spark):
    rows = [(1, 1001, "Notebook", "Stationery", D("15.50")), (2, 1002, "Pen Set", "Stationery", D("20.00")), (3, 1003, "Desk Lamp", "Home Office", D("12.00"))]
    return spark.createDataFrame(rows, "product_key int, product_id int, product_name string, category string, unit_price decimal(12,2)")


@pytest.fixture(scope="module")
def fact(spark):
    rows = [(1, 20260301, 1, 1, 2, D("31.00")), (2, 20260301, 2, 2, 1, D("20.00")), (3, 20260302, 1, 3, 3, D("36.00")), (4, 20260303, 3, 1, 5, D("77.50"))]
    return spark.createDataFrame(rows, "order_id int, date_key int, customer_key int, product_key int, quantity int, gross_amount decimal(12,2)")


def change(spark, key, city, start=None):
    return spark.createDataFrame([(key, city, day(start) if start else None)], "customer_id int, city string, effective_date date")


def apply_all(spark, dim):
    dim = scd1(dim, change(spark, 101, "Haiphong"), ["city"], TRACK)
    dim = scd2(dim, change(spark, 102, "Hue", "2026-04-01"), ["city"], TRACK)
    return scd6(dim, change(spark, 103, "Vung Tau", "2026-07-01"), ["city"], TRACK)


def test_three_kinds_of_change(spark, dim):
    got = dim_history(apply_all(spark, dim), TRACK).select(
        "customer_key", "customer_id", "city", "effective_date", "end_date", "current_flag", "previous_city", "current_city"
    )
    assert [tuple(r) for r in got.collect()] == [
        (1, 101, "Haiphong", START, None, True, None, "Haiphong"),
        (2, 102, "Danang", START, day("2026-03-31"), False, None, "Danang"),
        (4, 102, "Hue", day("2026-04-01"), None, True, "Danang", "Hue"),
        (3, 103, "HCMC", START, day("2026-06-30"), False, None, "Vung Tau"),
        (5, 103, "Vung Tau", day("2026-07-01"), None, True, "HCMC", "Vung Tau"),
    ]


def test_applying_changes_again_changes_nothing(spark, dim):
    once = apply_all(spark, dim)
    same(apply_all(spark, once), once)


def test_history_stays_consistent_over_many_changes(spark, dim):
    for i, (key, city) in enumerate([(101, "A"), (102, "B"), (101, "C"), (103, "D"), (101, "A")]):
        apply = scd2 if i % 2 else scd6
        dim = apply(dim, change(spark, key, city, f"2026-0{i + 2}-01"), ["city"], TRACK)
    rows = dim_history(dim, TRACK).collect()
    assert sorted(r.customer_key for r in rows) == list(range(1, len(rows) + 1))
    for key in (101, 102, 103):
        mine = [r for r in rows if r.customer_id == key]
        assert [r.current_flag for r in mine] == [False] * (len(mine) - 1) + [True]
        for before, after in zip(mine, mine[1:]):
            assert (after.effective_date - before.end_date).days == 1
            assert after.previous_city == before.city
    assert {r.current_city for r in rows if r.customer_id == 101} == {"A"}


def test_dimension_loads(spark, dim, tmp_path):
    path = str(tmp_path / "dim")
    start_dimension(dim.drop("customer_key"), path, TRACK)
    load_dimension(spark, path, change(spark, 101, "Haiphong"), ["city"], TRACK, 1)
    load_dimension(spark, path, change(spark, 102, "Hue", "2026-04-01"), ["city"], TRACK, 2)
    load_dimension(spark, path, change(spark, 103, "Vung Tau", "2026-07-01"), ["city"], TRACK, 6)
    same(read_table(spark, path), apply_all(spark, dim))


def test_type_6_leaves_keys_without_an_open_row_alone(spark, dim):
    closed = dim.withColumn("current_flag", F.col("customer_id") != 101)
    same(scd6(closed, change(spark, 101, "X", "2026-04-01"), ["city"], TRACK), closed)


def test_unknown_and_repeated_changes(spark, dim):
    changes = change(spark, 999, "Nowhere", "2026-04-01").union(change(spark, 101, "X", "2026-04-01")).union(change(spark, 101, "Y", "2026-05-01"))
    got = scd2(dim, changes, ["city"], TRACK)
    assert tuples(got.filter("customer_id = 101"), "city", "effective_date", "end_date", "current_flag", "previous_city") == [
        ("Hanoi", START, day("2026-03-31"), False, None), ("X", day("2026-04-01"), day("2026-04-30"), False, "Hanoi"),
        ("Y", day("2026-05-01"), None, True, "X"),
    ]
    assert got.count() == 5 and got.select("customer_key").distinct().count() == 5
    assert tuples(refused_changes(dim, changes, ["city"], TRACK), "customer_id", "reason") == [(999, "no open version")]


def test_changes_out_of_order_are_applied_in_order_or_refused(spark, dim):
    changes = change(spark, 101, "C", "2026-06-01").union(change(spark, 101, "B", "2026-04-01")).union(change(spark, 101, "B", "2026-05-01"))
    early = change(spark, 102, "Old", "2019-01-01").union(change(spark, 102, "No date", None))
    for apply in (scd2, scd6):
        got = apply(dim, changes.union(early), ["city"], TRACK)
        assert [r.city for r in dim_history(got.filter("customer_id = 101"), TRACK).collect()][1:] == ["B", "C"]
        assert got.filter("customer_id = 102").count() == 1
        assert got.filter("end_date < effective_date").isEmpty()
    assert {r.current_city for r in got.filter("customer_id = 101").collect()} == {"C"}
    assert sorted(r.reason for r in refused_changes(dim, changes.union(early), ["city"], TRACK).collect()) == ["before the open version", "no date"]


def test_other_column_names(spark):
    other = spark.createDataFrame(
        [(1, 1, "Alice", "HCM", START, None, True)],
        "customer_key int, customer_id int, customer_name string, city string, effective_from date, effective_to date, is_current boolean",
    )
    track = Tracking(start="effective_from", end="effective_to", flag="is_current")
    got = scd2(other, change(spark, 1, "HN", "2026-02-01"), ["city"], track)
    assert tuples(got, "customer_key", "city", "effective_to", "is_current") == [
        (1, "HCM", day("2026-01-31"), False), (2, "HN", None, True),
    ]


def test_date_dimension(spark):
    got = date_dim(spark, "2026-03-01", "2026-03-03")
    assert tuples(got)[0] == (20260301, day("2026-03-01"), 2026, 1, 3, "March", 1)
    assert got.count() == 3
    dates = spark.createDataFrame([(day("2025-12-30"),), (day("2026-01-02"),)], "d date")
    assert [r.date_key for r in date_dim_of(dates, "d").collect()] == [20251230, 20251231, 20260101, 20260102]


def test_keys_are_dense_and_in_order(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("customer_id"))
    got = assign_keys(df, ["customer_id"], "customer_key", 11)
    assert got.filter(F.col("customer_key") != F.col("customer_id") + 11).isEmpty() and got.count() == 1000


def test_star_join_and_mart(spark, fact, dim, products, tmp_path):
    dates = date_dim(spark, "2026-03-01", "2026-03-03")
    assert tuples(star_orders(fact, dates, dim, products)) == [
        (1, day("2026-03-01"), "Alice Nguyen", "Notebook", 2, D("31.00")),
        (2, day("2026-03-01"), "Bao Tran", "Pen Set", 1, D("20.00")),
        (3, day("2026-03-02"), "Alice Nguyen", "Desk Lamp", 3, D("36.00")),
        (4, day("2026-03-03"), "Chi Le", "Notebook", 5, D("77.50")),
    ]
    mart = build_mart(fact, dates, products, str(tmp_path / "mart"))
    assert [tuple(r) for r in mart.collect()] == [
        (day("2026-03-01"), "Stationery", 3, D("51.00")),
        (day("2026-03-02"), "Home Office", 3, D("36.00")),
        (day("2026-03-03"), "Stationery", 5, D("77.50")),
    ]


def test_past_reports_survive_a_type_2_change(spark, fact, dim, products):
    dates = date_dim(spark, "2026-03-01", "2026-03-03")
    changed = apply_all(spark, dim)
    same(star_orders(fact, dates, dim, products), star_orders(fact, dates, changed, products))


def test_dashboard_queries(spark):
    customers = spark.createDataFrame(
        [(1, 1, "Alice", False), (3, 1, "Alice", True), (2, 2, "Bob", True)],
        "customer_key int, customer_id int, customer_name string, is_current boolean",
    )
    fact = spark.createDataFrame(
        [(1001, day("2026-04-01"), 1, 1, D("1500.00")), (1002, day("2026-04-01"), 2, 2, D("50.00")), (1003, day("2026-04-02"), 3, 1, D("25.00"))],
        "order_id int, order_date date, customer_key int, quantity int, revenue decimal(12,2)",
    )
    assert tuples(revenue_by_day(fact)) == [(day("2026-04-01"), D("1550.00")), (day("2026-04-02"), D("25.00"))]
    by_customer = revenue_by_customer(fact, customers).collect()
    assert [(r.customer_name, r.total_quantity, r.total_revenue) for r in by_customer] == [("Alice", 2, D("1525.00")), ("Bob", 2, D("50.00"))]


def test_defaults_only_fill_absent_columns(spark):
    df = spark.createDataFrame([(1, None)], "k int, current_flag boolean")
    assert with_defaults(df, {"current_flag": True}).first().current_flag is None
    assert with_defaults(df.select("k"), {"current_flag": True}).first().current_flag is True


def test_versions_and_added_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    assert read_table(spark, path) is None
    publish(spark.createDataFrame([(1, "a")], "k int, v string"), path)
    assert add_rows(spark.createDataFrame([(2, "b")], "k int, v string"), path, "stream", 0) == 1
    # A repeated batch is there already; the same batch number of another stream is new.
    assert add_rows(spark.createDataFrame([(2, "b")], "k int, v string"), path, "stream", 0) is None
    assert tuples(read_table(spark, path)) == [(1, "a"), (2, "b")]
    fold(spark, path, lambda df: df.withColumn("v", F.upper("v")))
    assert tuples(read_table(spark, path)) == [(1, "A"), (2, "B")]
    assert add_rows(spark.createDataFrame([(3, "c")], "k int, v string"), path, "stream 2", 0) == 2
    assert add_rows(spark.createDataFrame([(3, "d")], "k int, v string"), path) == 3
    # A delta without a commit row is not read, and the next one takes its place.
    spark.createDataFrame([(8, "torn")], "k int, v string").write.parquet(f"{path}/deltas/d=4")
    assert tuples(read_table(spark, path)) == [(1, "A"), (2, "B"), (3, "c"), (3, "d")]
    assert add_rows(spark.createDataFrame([(4, "e")], "k int, v string"), path) == 4
    fold(spark, path, lambda df: df.filter("k < 3").withColumn("v", F.replace("v", F.lit("B"), F.lit("C"))))
    # An unfinished version leaves the current one in place.
    spark.createDataFrame([(9, "z")], "k int, v string").write.parquet(f"{path}/base/v=4")
    assert tuples(read_table(spark, path)) == [(1, "A"), (2, "C")]
    publish(spark.createDataFrame([(4, "d")], "k int, v string"), path)
    assert tuples(read_table(spark, path)) == [(4, "d")]


def test_zones_tables_and_append(spark, tmp_path):
    create_zones(spark, str(tmp_path), ["zone_gold"])
    df = spark.createDataFrame([(1,)], "k int")
    create_table_as(df, str(tmp_path / "t"), "zone_gold.t")
    append(spark.createDataFrame([(2,)], "k int"), str(tmp_path / "t"))
    spark.catalog.refreshTable("zone_gold.t")
    assert tuples(spark.table("zone_gold.t")) == [(1,), (2,)]
    drop_tables(spark, ["zone_gold.t", "zone_gold.never_there"])
    assert not spark.catalog.tableExists("zone_gold.t")
    spark.sql("DROP SCHEMA zone_gold")
