"""Feature definitions for driver statistics."""

from datetime import timedelta

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, LongType, StructField, StructType

from tidemart.operators.features import (
    Entity, FeatureRepo, FeatureService, FeatureSource, FeatureView, OnDemandView, RequestSource, Selection,
)

# Names, types and time-to-live of the driver features.
DRIVER = Entity("driver", ("driver_id",))
STATS = StructType([
    StructField("conv_rate", FloatType()),
    StructField("acc_rate", FloatType()),
    StructField("avg_daily_trips", LongType()),
])
REQUEST = RequestSource("vals_to_add", StructType([
    StructField("val_to_add", LongType()),
    StructField("val_to_add_2", LongType()),
]))
RATES = StructType([
    StructField("conv_rate_plus_val1", DoubleType()),
    StructField("conv_rate_plus_val2", DoubleType()),
])
TTL = timedelta(days=1)
TAGS = {"team": "driver_performance"}


def driver_repo(stats_path: str | None = None, store: str | None = None, rows=None) -> FeatureRepo:
    """Views and services over hourly driver statistics, in a plain and a pushed variant."""
    hourly = FeatureSource("driver_hourly_stats_source", stats_path, rows=rows)
    pushed = FeatureSource("driver_stats_push_source", stats_path, rows=rows)
    stats = FeatureView("driver_hourly_stats", DRIVER, STATS, hourly, TTL, TAGS)
    fresh = FeatureView("driver_hourly_stats_fresh", DRIVER, STATS, pushed, TTL, TAGS)
    rates = {
        "conv_rate_plus_val1": F.col("conv_rate") + F.col("val_to_add"),
        "conv_rate_plus_val2": F.col("conv_rate") + F.col("val_to_add_2"),
    }
    on_stats = OnDemandView("transformed_conv_rate", (stats, REQUEST), RATES, rates)
    on_fresh = OnDemandView("transformed_conv_rate_fresh", (fresh, REQUEST), RATES, rates)
    services = (
        FeatureService(
            "driver_activity_v1", (Selection(stats, ("conv_rate",)), on_stats), f"{store}/served" if store else None
        ),
        FeatureService("driver_activity_v2", (stats, on_stats)),
        FeatureService("driver_activity_v3", (fresh, on_fresh)),
    )
    return FeatureRepo((stats, fresh, on_stats, on_fresh), services, store)
