"""Warehouse loads: dimensions kept as versioned tables, and the mart built from a star schema."""

from collections.abc import Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from tidemart.operators.dimensions import Tracking, assign_keys, scd1, scd2, scd6
from tidemart.operators.gold import mart_daily_category_sales
from tidemart.sources.tables import publish, read_table
from tidemart.sources.writers import create_table_as


def start_dimension(rows: DataFrame, path: str, tracking: Tracking, order_by: Sequence[str] | None = None) -> DataFrame:
    """First version of a dimension: rows with every column but the surrogate key, numbered from 1."""
    keyed = assign_keys(rows, order_by or [tracking.key, tracking.start], tracking.surrogate)
    return publish(keyed, path)


def load_dimension(
    spark: SparkSession, path: str, changes: DataFrame, cols: Sequence[str], tracking: Tracking, kind: int = 2,
    backdated: bool = False,
) -> DataFrame:
    """Apply changes of type 1, 2 or 6 to the dimension at `path` and publish the next version.

    With `backdated`, changes of type 2 and 6 may lie before the open version.

    Readers of the version before are not disturbed, and a load that fails leaves it current.
    """
    apply = {1: scd1, 2: partial(scd2, backdated=backdated), 6: partial(scd6, backdated=backdated)}[kind]
    return publish(apply(read_table(spark, path), changes, cols, tracking), path)


def build_mart(fact: DataFrame, dates: DataFrame, products: DataFrame, path: str) -> DataFrame:
    """Daily sales per category, written at `path`."""
    return create_table_as(mart_daily_category_sales(fact, dates, products), path)
