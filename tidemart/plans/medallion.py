"""The batch job raw -> silver -> gold, and the lake tables bronze -> silver -> gold."""

from pyspark.sql import DataFrame, SparkSession

from tidemart.operators.cleaning import bronze_to_silver, to_silver
from tidemart.operators.gold import customer_sales, daily_revenue, daily_sales
from tidemart.operators.layout import cluster, compact, write_files
from tidemart.sources.readers import read_bronze_text, read_csv, read_parquet
from tidemart.sources.writers import create_table_as, write_parquet

# Columns of the raw order file and of the bronze table.
RAW_ORDERS = (
    "order_id int, order_timestamp string, quantity int, unit_price double, "
    "order_status string, payment_method string"
)
BRONZE_ORDERS = ("order_id", "customer_id", "amount", "order_date")


def run_batch(spark: SparkSession, raw: str, root: str, schema: str | None = RAW_ORDERS) -> dict[str, DataFrame]:
    """Raw CSV to silver and both gold tables under `root`; each layer is read back from its files."""
    silver = create_table_as(to_silver(read_csv(spark, raw, schema)), f"{root}/silver/orders")
    daily = create_table_as(daily_sales(silver), f"{root}/gold/daily_sales")
    by_day = write_parquet(daily_revenue(silver), f"{root}/gold/daily_sales_partitioned", ["order_date"])
    return {"silver": silver, "daily_sales": daily, "daily_revenue": read_parquet(spark, by_day)}


def run_layout(
    spark: SparkSession, silver: str, root: str, small_files: int = 20, files: int | None = None
) -> dict[str, DataFrame]:
    """The silver table as many small files, compacted, and clustered by payment method and time."""
    orders = read_parquet(spark, silver)
    many = f"{root}/silver/orders_many_small_files"
    scattered = write_files(orders, many, small_files)
    compacted = compact(spark, many, f"{root}/silver/orders_compacted", files)
    clustered = cluster(orders, ["payment_method", "order_timestamp"], f"{root}/silver/orders_clustered", files)
    return {"small": scattered, "compacted": compacted, "clustered": clustered}


def run_lake(spark: SparkSession, bronze: str, root: str) -> dict[str, DataFrame]:
    """All-text bronze files to the silver and gold tables under `root`."""
    raw = read_bronze_text(spark, bronze, BRONZE_ORDERS)
    silver = create_table_as(bronze_to_silver(raw), f"{root}/silver/orders_clean")
    gold = create_table_as(customer_sales(silver), f"{root}/gold/customer_sales")
    return {"bronze": raw, "silver": silver, "gold": gold}
