"""Registration, table loaders and the plain column types results are compared in."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    ByteType, DateType, DecimalType, FloatType, IntegerType, ShortType, TimestampNTZType, TimestampType,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def portable(df: DataFrame) -> DataFrame:
    """The same values in types every engine prints alike: long, double, string, boolean.

    Dates become ISO text, timestamps microseconds since 1970.
    """
    columns = []
    for f in df.schema:
        col = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (TimestampType, TimestampNTZType)):
            col = F.unix_micros(col.cast("timestamp"))
        elif isinstance(f.dataType, DateType):
            col = col.cast("string")
        elif isinstance(f.dataType, (DecimalType, FloatType)):
            col = col.cast("double")
        elif isinstance(f.dataType, (ByteType, ShortType, IntegerType)):
            col = col.cast("long")
        columns.append(col.alias(f.name))
    return df.select(*columns)


def query(sql: str | None = None):
    """Register a function under its name. `sql` is the reference query, `{name}` parts from `PARTS`."""

    def add(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return portable(fn(spark, sf))

        QUERIES[fn.__name__] = run
        if sql is not None:
            SQL[fn.__name__] = " ".join(expand(sql).split())
        return fn

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
        F.col("o_orderstatus").alias("status"),
    )


def customers(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))


def events(spark: SparkSession, sf: str) -> DataFrame:
    """Events with `ts` as a timestamp."""
    df = table(spark, sf, "events")
    return df.withColumn("ts", F.col("ts").cast("timestamp"))


PARTS = {
    "orders": "(SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date, "
              "CAST(o_totalprice AS DECIMAL(18,2)) AS amount, o_orderstatus AS status FROM orders)",
    "customers": "(SELECT c_custkey AS id, c_name AS name FROM customer)",
}


def expand(sql: str) -> str:
    for name, text in PARTS.items():
        sql = sql.replace("{" + name + "}", text)
    return sql
