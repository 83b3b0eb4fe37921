"""Cleaning steps between raw and silver."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType

from tidemart.functions.scalars import (
    TIMESTAMP_PATTERN, lenient, lenient_date, lenient_int, normalise, parse_ts, strict, year_month,
)
from tidemart.operators.ordered import latest_per_key
from tidemart.operators.quality import require_columns

# The columns and header line an order file must have.
CLEAN_ORDERS_COLUMNS = ("order_id", "customer_id", "order_date", "amount", "status")
INGEST_HEADER = "order_id,customer_id,order_date,amount,status"


def to_silver(raw: DataFrame) -> DataFrame:
    """Typed and normalised order rows with `gross_amount`; rows without a key are dropped.

    Values that do not parse become NULL and their row is kept.
    """
    time = F.col("order_timestamp")
    if isinstance(raw.schema["order_timestamp"].dataType, StringType):
        time = parse_ts(time, TIMESTAMP_PATTERN)
    text_quantity = isinstance(raw.schema["quantity"].dataType, StringType)
    typed = {
        "order_timestamp": time.cast("timestamp"),
        "quantity": lenient_int("quantity") if text_quantity else lenient("quantity", "int"),
        "unit_price": lenient("unit_price", "double"),
        "order_status": normalise("order_status"),
        "payment_method": normalise("payment_method"),
    }
    kept = raw.filter(F.col("order_id").isNotNull())
    return kept.withColumns(typed).withColumn("gross_amount", F.col("quantity") * F.col("unit_price"))


def clean_orders(raw: DataFrame) -> DataFrame:
    """Orders with a valid date and a positive amount, plus `year_month`."""
    require_columns(raw, CLEAN_ORDERS_COLUMNS)
    text_date = isinstance(raw.schema["order_date"].dataType, StringType)
    coerced = raw.withColumns({
        "amount": lenient("amount", "double"),
        "order_date": lenient_date("order_date") if text_date else F.col("order_date").cast("date"),
    })
    return (
        coerced.dropna(subset=["amount", "order_date"])
        .filter((F.col("amount") > 0) & ~F.isnan("amount"))
        .withColumn("year_month", year_month("order_date"))
    )


def filter_field_positive(df: DataFrame, col: str) -> DataFrame:
    """Rows whose text field is a number above zero; the field itself stays as it was."""
    number = lenient(col, "double")
    return df.filter((number > 0) & ~F.isnan(number))


def bronze_to_silver(bronze: DataFrame) -> DataFrame:
    """All-text bronze rows to typed ones.

    Ids must be integers or the query fails; a bad amount drops the row; a bad date becomes NULL.
    """
    amount = lenient("amount", "double")
    return bronze.filter(amount.isNotNull()).select(
        strict("order_id", "int").alias("order_id"),
        strict("customer_id", "int").alias("customer_id"),
        amount.alias("amount"),
        lenient_date("order_date").alias("order_date"),
    )


def dedup(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the one with the largest `order_by`."""
    return latest_per_key(df, list(keys), list(order_by))
