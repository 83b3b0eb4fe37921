"""File ingest jobs: check the input, clean it, write it, leave a run record."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from tidemart.operators.cleaning import INGEST_HEADER, clean_orders, filter_field_positive
from tidemart.sources.readers import InvalidHeader, MissingInput, read_csv, require_header, require_path
from tidemart.sources.writers import log_run, write_csv


def _text_schema(header: str) -> StructType:
    return StructType([StructField(name, StringType()) for name in header.split(",")])


def ingest_orders(spark: SparkSession, source: str, target: str, log: str) -> int:
    """Keep the orders with a positive amount. A missing file or another header fails before any write."""
    try:
        require_path(spark, source)
        require_header(spark, source, INGEST_HEADER)
    except (MissingInput, InvalidHeader) as error:
        log_run(spark, log, "ingest_orders", "ERROR", str(error))
        raise
    rows = filter_field_positive(read_csv(spark, source, _text_schema(INGEST_HEADER)), "amount")
    written = write_csv(rows, target)
    log_run(spark, log, "ingest_orders", "INFO", "ETL success", written)
    return written


def run_etl(spark: SparkSession, source: str, target: str, log: str | None = None) -> DataFrame:
    """Clean an order file to CSV; columns are read as text and coerced, so one bad value costs one row."""
    require_path(spark, source)
    # Only the header decides the columns here; no pass over the data to infer types.
    raw = spark.read.option("header", True).csv(source)
    clean = clean_orders(raw)
    written = write_csv(clean, target)
    if log:
        log_run(spark, log, "run_etl", "INFO", f"Wrote {written} rows to {target}", written)
    return read_csv(spark, target, clean.schema)
