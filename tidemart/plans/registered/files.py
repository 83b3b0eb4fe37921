"""File formats and layout: what is written must be read back whole."""

from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from tidemart.functions.scalars import as_text
from tidemart.operators.layout import cluster, cluster_together, compact, pack_small_files, read_live, read_ranges, write_files
from tidemart.plans.ingest import ingest_orders, run_etl
from tidemart.plans.medallion import run_batch, run_lake
from tidemart.plans.registered.base import orders, query, table
from tidemart.plans.registered.sales import bronze_events, raw_orders
from tidemart.sources.partitions import replace_partitions
from tidemart.sources.readers import read_csv, read_lines, read_parquet
from tidemart.sources.scratch import scratch_path
from tidemart.sources.store import Store
from tidemart.sources.writers import append, write_csv, write_parquet

_ORDERS = """SELECT order_id, customer_id, CAST(order_date AS VARCHAR) AS order_date, CAST(amount AS DOUBLE) AS amount, status FROM {orders}"""


@query(_ORDERS)
def csv_round_trip(spark, sf):
    rows, path = orders(spark, sf), scratch_path(spark, "csv")
    write_csv(rows, path)
    return read_csv(spark, path, rows.schema)


@query(_ORDERS + " WHERE status = 'F'")
def partition_read(spark, sf):
    path = write_parquet(orders(spark, sf), scratch_path(spark, "partitioned"), ["status"])
    return read_parquet(spark, path).filter("status = 'F'")


@query(_ORDERS)
def appended(spark, sf):
    rows, path = orders(spark, sf), scratch_path(spark, "appended")
    append(rows.filter("status = 'F'"), path)
    append(rows.filter("status <> 'F'"), path)
    return read_parquet(spark, path)


@query(_ORDERS)
def compacted(spark, sf):
    many = scratch_path(spark, "many")
    write_files(orders(spark, sf), many, 20)
    return compact(spark, many, scratch_path(spark, "compacted"))


@query(_ORDERS)
def clustered(spark, sf):
    return cluster(orders(spark, sf), ["status", "order_date"], scratch_path(spark, "clustered"))


@query("""SELECT order_id, customer_id, CAST(order_date AS VARCHAR) AS order_date, CAST(amount AS DOUBLE) AS amount, status FROM {orders}
 WHERE amount BETWEEN 20000 AND 60000 AND order_date BETWEEN DATE '1994-03-01' AND DATE '1995-06-30'""")
def clustered_together(spark, sf):
    """A filter on two columns, of files that are narrow in both."""
    path = scratch_path(spark, "z-order")
    rows = orders(spark, sf)
    cluster_together(rows, ["order_date", "amount"], path, files=32)
    return read_ranges(spark, path, {"amount": (Decimal(20000), Decimal(60000)), "order_date": (date(1994, 3, 1), date(1995, 6, 30))}, rows.schema)


@query(_ORDERS)
def packed_small_files(spark, sf):
    """One large file, many small ones, and one that is added after they were packed."""
    path, rows = scratch_path(spark, "small-files"), orders(spark, sf)
    part = F.col("order_id") % 10
    rows.filter(part < 6).coalesce(1).write.mode("append").parquet(path)
    rows.filter((part >= 6) & (part < 9)).repartition(12).write.mode("append").parquet(path)
    largest = max(size for _, size in Store(spark, path).files(path))
    pack_small_files(spark, path, largest)
    rows.filter(part == 9).coalesce(1).write.mode("append").parquet(path)
    return read_live(spark, path, rows.schema)


@query("""SELECT order_id, customer_id, CAST(order_date AS VARCHAR) AS order_date, CAST(CASE WHEN m = '1995-03' THEN amount + 1 ELSE amount END AS DOUBLE) AS amount,
 status, m AS month FROM (SELECT *, strftime(order_date, '%Y-%m') AS m FROM {orders}) t WHERE m <> '1995-03' OR order_id % 2 = 0""")
def partition_replaced(spark, sf):
    """Late data for one month takes the place of that month; the same load again, with other rows, changes nothing."""
    path = scratch_path(spark, "months")
    rows = orders(spark, sf).withColumn("month", F.date_format("order_date", "yyyy-MM"))
    replace_partitions(rows, path, ["month"], "orders", 0)
    late = rows.filter("month = '1995-03' AND order_id % 2 = 0").withColumn("amount", (F.col("amount") + 1).cast("decimal(18,2)"))
    replace_partitions(late, path, ["month"], "orders", 1)
    replace_partitions(rows.filter("month < '1995-01'").limit(5), path, ["month"], "orders", 1)
    return spark.read.schema(rows.schema).parquet(path)


@query("""SELECT user_id AS customer_id, count(*) AS total_orders, round(sum(value), 2) AS total_revenue
 FROM events WHERE event_type <> 'error' GROUP BY 1""")
def lake_tables(spark, sf):
    """Bronze text files to silver and gold tables."""
    bronze = scratch_path(spark, "bronze")
    bronze_events(spark, sf).write.csv(bronze)
    gold = run_lake(spark, bronze, scratch_path(spark, "lake"))["gold"]
    return gold.withColumn("total_revenue", F.round("total_revenue", 2))


_ACCOUNTS = "(SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment FROM customer)"


def _ingested(spark, sf):
    source, target, log = (scratch_path(spark, f"ingest-{part}") for part in ("in", "out", "log"))
    accounts = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("order_id"), F.col("c_nationkey").alias("customer_id"),
        F.lit("2024-01-01").alias("order_date"), F.col("c_acctbal").alias("amount"), F.col("c_mktsegment").alias("status"),
    )
    write_csv(accounts, source)
    ingest_orders(spark, source, target, log)
    return target, log


@query(f"SELECT c_custkey AS order_id, c_nationkey AS customer_id, c_acctbal AS amount, c_mktsegment AS status FROM {_ACCOUNTS} a WHERE c_acctbal > 0")
def ingested(spark, sf):
    target, _ = _ingested(spark, sf)
    written = read_csv(spark, target, "order_id long, customer_id long, order_date string, amount double, status string")
    return written.drop("order_date")


@query("SELECT 'ingest_orders' AS job, 'INFO' AS level, count(*) AS rows FROM customer WHERE c_acctbal > 0")
def ingest_log(spark, sf):
    _, log = _ingested(spark, sf)
    return spark.read.parquet(log).select("job", "level", "rows")


_TEXT = "concat_ws('|', CAST(o_orderkey AS VARCHAR), o_orderpriority)"


@query(f"SELECT {_TEXT} AS value FROM orders")
def raw_lines(spark, sf):
    path = scratch_path(spark, "lines")
    table(spark, sf, "orders").select(F.concat_ws("|", "o_orderkey", "o_orderpriority").alias("value")).write.text(path)
    return read_lines(spark, path)


@query("SELECT o_orderkey AS id, o_orderpriority AS value FROM orders")
def binary_as_text(spark, sf):
    body = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.encode("o_orderpriority", "UTF-8").alias("value"))
    return body.select("id", as_text("value").alias("value"))


_RAW = """(SELECT CAST(o_orderdate AS DATE) AS day, lower(o_orderpriority) AS payment_method, CAST(l_quantity AS INTEGER) * l_extendedprice AS gross
 FROM orders JOIN lineitem ON o_orderkey = l_orderkey)"""


@query(f"""SELECT CAST(day AS VARCHAR) AS order_date, payment_method, count(*) AS total_orders, round(sum(gross), 2) AS total_revenue
 FROM {_RAW} r GROUP BY 1, 2""")
def batch_job(spark, sf):
    """Raw CSV to silver and gold files; the daily sales table."""
    raw = scratch_path(spark, "raw-orders")
    rows = raw_orders(spark, sf, text_time=True).filter("quantity IS NOT NULL")
    write_csv(rows.select(*[F.trim(c).alias(c) if t == "string" else F.col(c) for c, t in rows.dtypes]), raw)
    daily = run_batch(spark, raw, scratch_path(spark, "batch"))["daily_sales"]
    return daily.withColumn("total_revenue", F.round("total_revenue", 2))


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date,
 o_totalprice AS amount, o_orderstatus AS status, strftime(o_orderdate, '%Y-%m') AS year_month FROM orders WHERE o_orderstatus = 'O'""")
def etl_job(spark, sf):
    """A file of orders in which finished ones have no readable date and pending ones no readable amount."""
    source, status = scratch_path(spark, "etl-in"), F.col("o_orderstatus")
    write_csv(table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.when(status == "F", "soon").otherwise(F.col("o_orderdate").cast("date").cast("string")).alias("order_date"),
        F.when(status == "P", "-1").otherwise(F.col("o_totalprice").cast("string")).alias("amount"), status.alias("status"),
    ), source)
    return run_etl(spark, source, scratch_path(spark, "etl-out"))
