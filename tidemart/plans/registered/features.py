"""Training sets, latest values and pushes; views are the features, purchases the entities."""

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tidemart.operators import features as f
from tidemart.operators.asof import StoredLookup, point_in_time_join, point_in_time_stored, store_history
from tidemart.plans.registered.base import events, query
from tidemart.plans.registered.relational import SPLIT_ROWS
from tidemart.sources.scratch import scratch_path

# How long a view stays valid, and the two ends of the incremental load.
TTL = timedelta(hours=6)
FIRST_END = datetime(2024, 1, 15)
LAST_END = datetime(2025, 1, 1)

USER = f.Entity("user", ("user_id",))
SEEN = StructType([StructField("seen_value", DoubleType()), StructField("seen_props", StringType())])
REQUEST = f.RequestSource("request", StructType([StructField("paid", DoubleType())]))
SUMS = StructType([StructField("seen_plus_paid", DoubleType())])


def seen(spark, sf, kind: str = "view") -> DataFrame:
    return events(spark, sf).filter(F.col("event_type") == kind).select(
        "user_id", F.col("ts").alias("event_timestamp"), F.col("ts").alias("created"),
        F.col("value").alias("seen_value"), F.col("props").alias("seen_props"),
    )


def purchases(spark, sf) -> DataFrame:
    return events(spark, sf).filter("event_type = 'purchase'").select(
        "event_id", "user_id", F.col("ts").alias("event_timestamp"), F.col("value").alias("paid")
    )


def _sums(inputs):
    return (inputs["seen_value"] + inputs["paid"]).to_frame("seen_plus_paid")


def repo(spark, sf, ttl=TTL, store=None, pandas=False) -> f.FeatureRepo:
    view = f.FeatureView("seen", USER, SEEN, f.FeatureSource("view_events", rows=seen(spark, sf)), ttl)
    how = {"pandas_fn": _sums} if pandas else {"exprs": {"seen_plus_paid": F.col("seen_value") + F.col("paid")}}
    sums = f.OnDemandView("sums", (view, REQUEST), SUMS, **how)
    return f.FeatureRepo((view, sums), (f.FeatureService("spend", (f.Selection(view, ("seen_value",)), sums)),), store)


_ASOF = """(SELECT e.event_id, e.user_id, e.ts, e.value AS paid, CASE WHEN e.ts - v.ts <= INTERVAL 6 HOUR THEN v.value END AS seen_value,
 CASE WHEN e.ts - v.ts <= INTERVAL 6 HOUR THEN v.props END AS seen_props
 FROM (SELECT * FROM events WHERE event_type = 'purchase') e
 ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') v ON e.user_id = v.user_id AND e.ts >= v.ts)"""


@query(f"""SELECT event_id, user_id, epoch_us(ts) AS event_timestamp, paid, seen_value, seen_props,
 seen_value + paid AS seen_plus_paid FROM {_ASOF} a""")
def historical_features(spark, sf):
    refs = ["seen:seen_value", "seen:seen_props", "sums:seen_plus_paid"]
    return f.historical_features(spark, purchases(spark, sf), refs, repo(spark, sf))


def stored_seen(spark, sf, **more):
    """The view's history in buckets of users."""
    path = scratch_path(spark, "history")
    return store_history(seen(spark, sf), path.rpartition("/")[2].replace("-", "_"), path, ["user_id"], created="created", buckets=8, **more)


@query(f"""SELECT event_id, user_id, epoch_us(ts) AS event_timestamp, paid, seen_value, seen_props,
 seen_value + paid AS seen_plus_paid FROM {_ASOF} a""")
def historical_features_stored(spark, sf):
    """The training set on a history that was laid out once: only the purchases are shuffled."""
    view = f.FeatureView("seen", USER, SEEN, f.FeatureSource("view_events", stored=stored_seen(spark, sf)), TTL)
    sums = f.OnDemandView("sums", (view, REQUEST), SUMS, exprs={"seen_plus_paid": F.col("seen_value") + F.col("paid")})
    refs = ["seen:seen_value", "seen:seen_props", "sums:seen_plus_paid"]
    return f.historical_features(spark, purchases(spark, sf), refs, f.FeatureRepo((view, sums)))


@query(f"SELECT event_id, seen_value FROM {_ASOF} a")
def point_in_time_stored_hot(spark, sf):
    """The same with users of many events stored in ranges of time next to the buckets."""
    rows = SPLIT_ROWS // 10
    lookup = StoredLookup(stored_seen(spark, sf, group_rows=rows), ["seen_value"], TTL)
    return point_in_time_stored(purchases(spark, sf), [lookup], group_rows=rows).select("event_id", "seen_value")


@query(f"SELECT event_id, seen_value + paid AS seen_plus_paid FROM {_ASOF} a")
def on_demand_pandas(spark, sf):
    got = f.historical_features(spark, purchases(spark, sf), ["sums:seen_plus_paid"], repo(spark, sf, pandas=True))
    # pandas has no NULL doubles: they come back as NaN.
    return got.select("event_id", F.when(~F.isnan("seen_plus_paid"), F.col("seen_plus_paid")).alias("seen_plus_paid"))


@query(f"SELECT event_id, seen_value FROM {_ASOF} a")
def point_in_time_hot(spark, sf):
    """The same join with users of many events taking the route for large keys."""
    joined = point_in_time_join(
        purchases(spark, sf), seen(spark, sf), ["user_id"], ["seen_value"], created="created", ttl=TTL,
        group_rows=SPLIT_ROWS // 10,
    )
    return joined.select("event_id", "seen_value")


_LAST = """(SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC) AS n FROM events
 WHERE event_type {kinds}) t WHERE n = 1)"""


@query(f"""SELECT e.event_id, v.value AS seen_value FROM (SELECT * FROM events WHERE event_type = 'purchase') e
 LEFT JOIN {_LAST.format(kinds="= 'view'")} v ON v.user_id = e.user_id""")
def scoring_features(spark, sf):
    service = repo(spark, sf, ttl=None)
    scored = f.historical_features(spark, purchases(spark, sf), ["seen:seen_value"], service, as_of=LAST_END)
    return scored.select("event_id", "seen_value")


def _loaded(spark, sf) -> f.FeatureRepo:
    loaded = repo(spark, sf, ttl=None, store=scratch_path(spark, "features"))
    for end in (FIRST_END, LAST_END):
        f.materialize_incremental(spark, loaded, end)
    return loaded


@query(f"""SELECT user_id, epoch_us(ts) AS event_timestamp, epoch_us(ts) AS created, value AS seen_value, props AS seen_props
 FROM {_LAST.format(kinds="= 'view'")} v""")
def materialized_features(spark, sf):
    loaded = _loaded(spark, sf)
    view = loaded.view("seen")
    return f.compact_latest(spark, f"{loaded.store}/latest/{view.name}", USER.join_keys, view.order)


@query(f"""SELECT k.user_id, k.paid, v.value AS seen_value, v.value + k.paid AS seen_plus_paid FROM
 (SELECT user_id, max(value) AS paid FROM events GROUP BY user_id) k LEFT JOIN {_LAST.format(kinds="= 'view'")} v ON v.user_id = k.user_id""")
def latest_features(spark, sf):
    loaded = _loaded(spark, sf)
    asked = events(spark, sf).groupBy("user_id").agg(F.max("value").alias("paid"))
    return f.latest_features(spark, asked, loaded.service("spend"), loaded)


@query(f"""SELECT k.user_id, v.value AS seen_value FROM (SELECT DISTINCT user_id FROM events) k
 LEFT JOIN {_LAST.format(kinds="IN ('view', 'click')")} v ON v.user_id = k.user_id""")
def pushed_features(spark, sf):
    loaded = _loaded(spark, sf)
    f.push(spark, loaded, "view_events", seen(spark, sf, "click"))
    asked = events(spark, sf).select("user_id").distinct()
    return f.latest_features(spark, asked, ["seen:seen_value"], loaded)


@query(f"""SELECT event_id, user_id, CASE WHEN event_id % 3 > 0 THEN 9007199254740993 + event_id END AS whole,
 seen_value + paid AS seen_plus_paid FROM {_ASOF} a""")
def on_demand_passes_columns(spark, sf):
    """Columns that the pandas function does not read stay as they are: whole numbers above 2^53, with NULLs."""
    whole = F.when(F.col("event_id") % 3 > 0, F.lit(9007199254740993) + F.col("event_id"))
    asked = purchases(spark, sf).withColumn("whole", whole)
    got = f.historical_features(spark, asked, ["sums:seen_plus_paid"], repo(spark, sf, pandas=True))
    seen_plus_paid = F.when(~F.isnan("seen_plus_paid"), F.col("seen_plus_paid")).alias("seen_plus_paid")
    return got.select("event_id", "user_id", "whole", seen_plus_paid)


@query(f"SELECT event_id, seen_value FROM {_ASOF} a")
def features_from_files(spark, sf):
    """A view on Parquet files in which every row has an older copy of the same event time; the later `created` wins."""
    path = scratch_path(spark, "view-files")
    rows = seen(spark, sf)
    older = rows.withColumns({"created": F.expr("created - INTERVAL 1 HOUR"), "seen_value": F.col("seen_value") + 1})
    rows.unionByName(older).write.parquet(path)
    view = f.FeatureView("seen", USER, SEEN, f.FeatureSource("view_files", path=path), TTL)
    got = f.historical_features(spark, purchases(spark, sf), ["seen:seen_value"], f.FeatureRepo((view,), (), None))
    return got.select("event_id", "seen_value")


@query(f"""SELECT k.user_id, v.value AS seen_value FROM (SELECT DISTINCT user_id FROM events) k
 LEFT JOIN {_LAST.format(kinds="= 'view'")} v ON v.user_id = k.user_id""")
def served_log(spark, sf):
    """What a service with a log served, read from the log."""
    loaded, log = _loaded(spark, sf), scratch_path(spark, "served")
    service = f.FeatureService("seen_only", (f.Selection(loaded.view("seen"), ("seen_value",)),), log)
    f.latest_features(spark, events(spark, sf).select("user_id").distinct(), service, loaded)
    return spark.read.parquet(f"{log}/seen_only").drop("served_at")
