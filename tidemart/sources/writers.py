"""Sinks and table definition."""

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> str:
    """Write Parquet, by default replacing the whole directory.

    With `partition_by`, rows are first rebalanced on those columns: each value lands in few files,
    and AQE splits a value that holds too much for one task.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(name) for name in partition_by])
        df.write.mode(mode).partitionBy(*partition_by).parquet(path)
    else:
        df.write.mode(mode).parquet(path)
    return path


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    return write_parquet(df, path, partition_by, mode="append")


def create_table_as(df: DataFrame, path: str, table: str | None = None) -> DataFrame:
    """Write a query's rows as Parquet at `path` and read them back; `table` registers it too."""
    write_parquet(df, path)
    if table:
        spark = df.sparkSession
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} USING parquet LOCATION '{path}'")
        spark.catalog.refreshTable(table)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_csv(df: DataFrame, path: str) -> int:
    """Write CSV files, each with a header, and return the number of rows, counted while writing."""
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.mode("overwrite").option("header", True).csv(path)
    return seen.get["rows"]


def create_zones(spark: SparkSession, root: str, names: Sequence[str] = ("bronze", "silver", "gold")) -> None:
    """One schema per zone, stored under `root/<zone>`."""
    for name in names:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name} LOCATION '{root}/{name}'")


def drop_tables(spark: SparkSession, names: Sequence[str]) -> None:
    """Drop tables that exist, in the given order: dependents first."""
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


RUN_LOG = "job string, level string, message string, rows long, at timestamp"


def log_run(spark: SparkSession, path: str, job: str, level: str, message: str, rows: int | None = None) -> None:
    """Append one run record."""
    record = [(job, level, message, rows, datetime.now(timezone.utc))]
    spark.createDataFrame(record, RUN_LOG).coalesce(1).write.mode("append").parquet(path)
