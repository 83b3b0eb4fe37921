"""Batch layers, lake tables, cleaning and ingest on the recorded inputs."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from helpers import day, plan_of, tuples
from tidemart.operators.cleaning import (
    INGEST_HEADER, bronze_to_silver, clean_orders, dedup, filter_field_positive, to_silver,
)
from tidemart.operators.gold import customer_sales, daily_revenue, daily_sales
from tidemart.operators.layout import cluster
from tidemart.operators.quality import MissingColumns
from tidemart.operators.relational import grep_lines, keep_castable, project_fields
from tidemart.plans.ingest import ingest_orders, run_etl
from tidemart.plans.medallion import RAW_ORDERS, run_batch, run_lake, run_layout
from tidemart.sources.readers import (
    InvalidHeader, MissingInput, read_csv, read_lines, require_header, stored_bytes,
)

RAW = """order_id,order_timestamp,quantity,unit_price,order_status,payment_method
1,2026-04-01 10:15:00,5,15.5,COMPLETED,CREDIT_CARD
2,2026-04-01 11:20:00,2,25.0,PENDING,PAYPAL
3,2026-04-02 09:05:00,10,12.0,COMPLETED,CREDIT_CARD
4,2026-04-02 14:30:00,1,100.0,CANCELLED,CASH
5,2026-04-02 16:45:00,3,45.5,COMPLETED,CREDIT_CARD
"""
GOLD = [
    (day("2026-04-01"), "credit_card", 1, 77.5),
    (day("2026-04-01"), "paypal", 1, 50.0),
    (day("2026-04-02"), "cash", 1, 100.0),
    (day("2026-04-02"), "credit_card", 2, 256.5),
]


@pytest.fixture
def raw(tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "orders.csv").write_text(RAW)
    return str(tmp_path / "raw")


def test_batch_job(spark, raw, tmp_path):
    out = run_batch(spark, raw, str(tmp_path / "lake"))
    assert [tuple(r) for r in out["daily_sales"].collect()] == GOLD
    assert tuples(out["silver"], "order_id", "order_status", "payment_method", "gross_amount")[0] == (
        1, "completed", "credit_card", 77.5,
    )
    by_day = out["daily_revenue"]
    assert dict(by_day.dtypes)["order_date"] == "date" and by_day.columns[-1] == "order_date"
    assert tuples(by_day, "order_date", "payment_method", "total_revenue") == [(d, m, r) for d, m, _, r in GOLD]
    assert "PartitionFilters: [isnotnull(order_date" in plan_of(by_day.filter(F.col("order_date") == "2026-04-01"))


def test_batch_job_inferred_schema_gives_the_same_gold(spark, raw, tmp_path):
    out = run_batch(spark, raw, str(tmp_path / "lake"), schema=None)
    assert [tuple(r) for r in out["daily_sales"].collect()] == GOLD


def test_silver_keeps_bad_values_as_null_and_drops_missing_keys(spark):
    rows = [
        ("1", "not a time", "x", "2.5", " Paid ", "CASH"),
        (None, "2026-04-01 10:00:00", "1", "1", "paid", "cash"),
        ("2", "2026-04-01 10:00:00", "-3", "y", None, "cash"),
    ]
    raw = spark.createDataFrame(rows, "order_id string, order_timestamp string, quantity string, unit_price string, order_status string, payment_method string")
    got = tuples(to_silver(raw), "order_id", "order_timestamp", "quantity", "unit_price", "order_status", "gross_amount")
    assert got[0][:1] + got[0][1:] == ("1", None, None, 2.5, "paid", None)
    assert got[1][0] == "2" and got[1][2:] == (-3, None, None, None)


def test_layout_keeps_rows(spark, raw, tmp_path):
    out = run_batch(spark, raw, str(tmp_path / "lake"))
    silver = str(tmp_path / "lake" / "silver" / "orders")
    laid = run_layout(spark, silver, str(tmp_path / "lake"), files=2)
    for df in laid.values():
        assert tuples(df) == tuples(out["silver"])
    assert stored_bytes(spark, str(tmp_path / "lake/silver/orders_compacted"))[1] <= 2
    assert stored_bytes(spark, str(tmp_path / "lake/silver/orders_clustered"))[1] <= 2
    assert stored_bytes(spark, str(tmp_path / "lake/silver/orders_many_small_files"))[1] >= 2


def test_clustering_cuts_a_frequent_value(spark, tmp_path):
    copies = spark.range(4000).select(F.when(F.col("id") % 4 > 0, "cash").otherwise("card").alias("payment_method"), F.lit(1).alias("x"))
    laid = cluster(copies, ["payment_method"], str(tmp_path / "c"), files=4, group_rows=100)
    per_file = laid.groupBy(F.input_file_name()).count().collect()
    assert len(per_file) == 4 and max(r["count"] for r in per_file) < 2000
    assert tuples(laid.groupBy("payment_method").count()) == [("card", 1000), ("cash", 3000)]


def test_lake(spark, tmp_path):
    (tmp_path / "bronze").mkdir()
    (tmp_path / "bronze" / "part.csv").write_text(
        "1,101,150.5,2026-01-01\n2,102,bad_amount,2026-01-02\n3,101,250.0,2026-01-03\n"
    )
    out = run_lake(spark, str(tmp_path / "bronze"), str(tmp_path / "lake"))
    assert out["bronze"].count() == 3
    assert tuples(out["silver"]) == [(1, 101, 150.5, day("2026-01-01")), (3, 101, 250.0, day("2026-01-03"))]
    assert tuples(out["gold"]) == [(101, 2, 400.5)]


def test_bronze_to_silver_keeps_a_bad_date_and_fails_on_a_bad_id(spark):
    schema = "order_id string, customer_id string, amount string, order_date string"
    ok = spark.createDataFrame([("1", "7", "2.5", "soon"), ("2", "7", None, "2026-01-01")], schema)
    assert tuples(bronze_to_silver(ok)) == [(1, 7, 2.5, None)]
    bad = spark.createDataFrame([("one", "7", "2.5", "2026-01-01")], schema)
    with pytest.raises(PySparkException):
        bronze_to_silver(bad).collect()


def test_etl(spark, tmp_path):
    source = tmp_path / "orders.csv"
    source.write_text(
        INGEST_HEADER + "\n1,101,2026-01-01,100.5,paid\n2,102,2026-01-02,,paid\n3,103,bad_date,250,pending\n"
        "4,101,2026-01-03,-50,refund\n5,104,2026-01-04,300.75,paid\n"
    )
    log = str(tmp_path / "log")
    clean = run_etl(spark, str(source), str(tmp_path / "clean"), log)
    assert tuples(clean) == [
        ("1", "101", day("2026-01-01"), 100.5, "paid", "2026-01"),
        ("5", "104", day("2026-01-04"), 300.75, "paid", "2026-01"),
    ]
    assert spark.read.parquet(log).select("level", "rows").collect()[0] == ("INFO", 2)
    with pytest.raises(MissingInput):
        run_etl(spark, str(tmp_path / "nothing.csv"), str(tmp_path / "x"))


def test_etl_names_missing_columns(spark):
    df = spark.createDataFrame([("1", "2")], "order_id string, amount string")
    with pytest.raises(MissingColumns, match="customer_id, order_date, status"):
        clean_orders(df)


LINES = "1,101,2024-01-15,120,completed\n2,102,2024-01-16,0,cancelled\n3,101,2024-02-02,250,completed\n4,103,2023-12-28,300,completed\n5,104,2024-03-05,180,pending\n"


def test_ingest(spark, tmp_path):
    source, log = tmp_path / "orders.csv", str(tmp_path / "log")
    source.write_text(INGEST_HEADER + "\n" + LINES)
    assert ingest_orders(spark, str(source), str(tmp_path / "out"), log) == 4
    written = spark.read.text(str(tmp_path / "out")).collect()
    assert {r.value for r in written} == {INGEST_HEADER, *[x for i, x in enumerate(LINES.split("\n")[:5]) if i != 1]}

    other = tmp_path / "other.csv"
    other.write_text("order_id,customer_id,amount,order_date,status\n" + LINES)
    with pytest.raises(InvalidHeader):
        ingest_orders(spark, str(other), str(tmp_path / "out"), log)
    with pytest.raises(MissingInput):
        ingest_orders(spark, str(tmp_path / "none.csv"), str(tmp_path / "out"), log)
    assert spark.read.text(str(tmp_path / "out")).count() >= 5
    levels = sorted(r.level for r in spark.read.parquet(log).collect())
    assert levels == ["ERROR", "ERROR", "INFO"]


def test_header_is_checked_in_every_file(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text(INGEST_HEADER + "\n" + LINES)
    (folder / "b.csv").write_text(INGEST_HEADER + "\n" + LINES)
    require_header(spark, str(folder), INGEST_HEADER)
    (folder / "c.csv").write_text(LINES)
    with pytest.raises(InvalidHeader, match="c.csv"):
        require_header(spark, str(folder), INGEST_HEADER)
    empty = tmp_path / "empty"
    empty.mkdir()
    (empty / "a.csv").write_text("")
    with pytest.raises(InvalidHeader, match="empty"):
        require_header(spark, str(empty), INGEST_HEADER)


def test_line_tools(spark, tmp_path):
    path = tmp_path / "orders.csv"
    path.write_text(INGEST_HEADER + "\n" + LINES)
    lines = read_lines(spark, str(path))
    assert [r.value[0] for r in grep_lines(lines, "2024").collect()] == ["1", "2", "3", "5"]
    fields = project_fields(lines, [2, 4], INGEST_HEADER)
    assert [r.value for r in fields.collect()] == ["101 120", "102 0", "101 250", "103 300", "104 180"]
    table = spark.createDataFrame([("1",), ("0",), ("x",), (None,), ("nan",), ("-1",)], "amount string")
    assert tuples(filter_field_positive(table, "amount")) == [("1",)]
    assert tuples(keep_castable(table.filter("amount != 'nan'"), "amount", "double")) == [("-1",), ("0",), ("1",)]


def test_gold_counts(spark):
    df = spark.createDataFrame(
        [(1, None, 2.0), (1, 5, 3.0), (2, 6, None)], "customer_id int, order_id int, amount double"
    )
    assert tuples(customer_sales(df)) == [(1, 1, 5.0), (2, 1, None)]
    silver = spark.createDataFrame([(None, "cash", 1.0)], "order_timestamp timestamp, payment_method string, gross_amount double")
    assert tuples(daily_sales(silver)) == [(None, "cash", 1, 1.0)]
    assert tuples(daily_revenue(silver)) == [(None, "cash", 1.0)]


def test_dedup_keeps_the_newest(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1), (2, "d", 1)], "k int, v string, at int")
    assert tuples(dedup(df, ["k"], ["at"])) == [(1, "b", 2), (2, "d", 1)]


def test_explicit_schema_reads_what_inference_reads(spark, raw):
    given, guessed = read_csv(spark, raw, RAW_ORDERS), read_csv(spark, raw)
    assert given.columns == guessed.columns and given.count() == guessed.count() == 5
