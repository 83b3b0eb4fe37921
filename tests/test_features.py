"""Point-in-time joins, on-demand features, services, latest values and pushes."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from helpers import same, tuples
from tidemart.operators import asof, ordered
from tidemart.operators.asof import Lookup, point_in_time_join, point_in_time_joins
from tidemart.operators.features import (
    FeatureService, OnDemandView, compact_latest, historical_features, latest_features, materialize_incremental,
    parse_ref, push, read_latest, view_history,
)
from tidemart.plans.driver_features import RATES, REQUEST, driver_repo

T = datetime.fromisoformat
STATS = "driver_id long, event_timestamp timestamp, created timestamp, conv_rate float, acc_rate float, avg_daily_trips long"
REFS = [
    "driver_hourly_stats:conv_rate", "driver_hourly_stats:acc_rate", "driver_hourly_stats:avg_daily_trips",
    "transformed_conv_rate:conv_rate_plus_val1", "transformed_conv_rate:conv_rate_plus_val2",
]


@pytest.fixture(scope="module")
def stats(spark):
    rows = [
        # exact time, and a later row that must not be used
        (1001, T("2021-04-12 10:59:42"), T("2021-04-12 11:00:00"), 0.5, 0.1, 10),
        (1001, T("2021-04-12 10:59:43"), T("2021-04-12 11:00:00"), 0.9, 0.9, 99),
        # one time, two creation times; a NULL value in the newer one
        (1002, T("2021-04-12 08:00:00"), T("2021-04-12 08:30:00"), 0.25, 0.2, 20),
        (1002, T("2021-04-12 08:00:00"), T("2021-04-12 09:00:00"), 0.75, None, 21),
        # older than a day
        (1003, T("2021-04-11 16:40:25"), T("2021-04-11 17:00:00"), 0.3, 0.3, 30),
    ]
    return spark.createDataFrame(rows, STATS)


@pytest.fixture(scope="module")
def entities(spark):
    rows = [
        (1001, T("2021-04-12 10:59:42"), 1, 1, 10), (1002, T("2021-04-12 08:12:10"), 5, 2, 20),
        (1003, T("2021-04-12 16:40:26"), 3, 3, 30), (1004, T("2021-04-12 16:40:26"), 2, 4, 40),
    ]
    return spark.createDataFrame(rows, "driver_id long, event_timestamp timestamp, label_driver_reported_satisfaction int, val_to_add long, val_to_add_2 long")


def test_training_set(spark, stats, entities):
    got = historical_features(spark, entities, REFS, driver_repo(rows=stats))
    assert got.columns == [*entities.columns, "conv_rate", "acc_rate", "avg_daily_trips", "conv_rate_plus_val1", "conv_rate_plus_val2"]
    rows = {r.driver_id: r for r in got.collect()}
    assert rows[1001].conv_rate == 0.5 and rows[1001].conv_rate_plus_val1 == 1.5 and rows[1001].conv_rate_plus_val2 == 10.5
    assert rows[1002].conv_rate == 0.75 and rows[1002].acc_rate is None and rows[1002].avg_daily_trips == 21
    assert rows[1003].conv_rate is None and rows[1003].conv_rate_plus_val1 is None
    assert rows[1004].conv_rate is None and rows[1004].label_driver_reported_satisfaction == 2
    assert dict(got.dtypes)["conv_rate_plus_val1"] == "double" and dict(got.dtypes)["conv_rate"] == "float"


def test_time_to_live_includes_its_limit(spark, stats):
    asked = spark.createDataFrame([(1003, T("2021-04-12 16:40:25"))], "driver_id long, event_timestamp timestamp")
    got = point_in_time_join(asked, stats, ["driver_id"], ["conv_rate"], created="created", ttl=timedelta(days=1))
    assert got.first().conv_rate == pytest.approx(0.3)


def test_scoring_stamps_every_row(spark, stats, entities):
    got = historical_features(spark, entities, REFS[:1], driver_repo(rows=stats), as_of=T("2021-04-12 12:00:00"))
    assert dict(tuples(got, "driver_id", "conv_rate"))[1001] == pytest.approx(0.9)
    assert got.select("event_timestamp").distinct().count() == 1


def brute(asked, facts, ttl):
    out = []
    for key, at, label in asked:
        hits = [f for f in facts if f[0] == key and key is not None and at is not None and f[1] <= at]
        best = max(hits, key=lambda f: (f[1], f[2]), default=None)
        out.append((key, at, label, best[3] if best and at - best[1] <= ttl else None))
    return out


@pytest.mark.parametrize("group_rows", [150, 1_000_000])
def test_point_in_time_join_equals_brute_force(spark, group_rows):
    rng = random.Random(11)
    base = T("2024-01-01 00:00:00")
    key = lambda: rng.choice([7, 7, 7, 8, 1, 2, 3, None])
    moment = lambda: base + timedelta(minutes=rng.randint(0, 300))
    facts, seen = [], set()
    for i in range(400):
        f = (key(), moment(), base + timedelta(seconds=i), rng.choice([None, float(i)]))
        facts.append(f)
    asked = [(key(), rng.choice([None] + [moment() for _ in range(20)]), i) for i in range(400)]
    asked += asked[:50]
    ttl = timedelta(minutes=4)
    f = spark.createDataFrame(facts, "k int, at timestamp, made timestamp, v double")
    e = spark.createDataFrame(asked, "k int, asked_at timestamp, label int")
    got = point_in_time_join(e, f, ["k"], ["v"], "asked_at", "at", "made", ttl, group_rows)
    expected = spark.createDataFrame(brute(asked, facts, ttl), "k int, asked_at timestamp, label int, v double")
    same(got, expected)


def test_many_large_keys_share_few_pieces(spark, monkeypatch):
    """Each of 200 keys is large; what the last pieces carry over is the same for any number of them."""
    start = T("2021-04-12 10:00:00")
    facts = spark.createDataFrame([(i % 200, start + timedelta(seconds=7 * i), i) for i in range(4000)], "k long, at timestamp, v long")
    asked = spark.createDataFrame([(i % 200, start + timedelta(seconds=13 * i)) for i in range(2000)], "k long, asked_at timestamp")
    counts = []
    whole = asof.sorted_pieces
    monkeypatch.setattr(asof, "sorted_pieces", lambda df, order, pieces: counts.append(pieces) or whole(df, order, pieces))
    few = point_in_time_join(asked, facts, ["k"], ["v"], "asked_at", "at", group_rows=10)
    monkeypatch.setattr(ordered, "PIECE_ROWS", 100)
    same(few, point_in_time_join(asked, facts, ["k"], ["v"], "asked_at", "at", group_rows=10))
    same(few, point_in_time_join(asked, facts, ["k"], ["v"], "asked_at", "at"))
    assert counts[0] == 4 and counts[1] > 30


@pytest.mark.parametrize("group_rows", [100, 1_000_000])
def test_two_lookups_on_one_timeline_equal_two_joins(spark, group_rows):
    rng = random.Random(5)
    base = T("2024-01-01 00:00:00")
    rows = lambda n: [(rng.choice([7, 7, 8, 9]), base + timedelta(minutes=rng.randint(0, 200)), float(i)) for i in range(n)]
    a = spark.createDataFrame(rows(200), "k int, at timestamp, v double")
    b = spark.createDataFrame(rows(200), "k int, seen timestamp, w double")
    e = spark.createDataFrame(rows(200), "k int, event_timestamp timestamp, label double")
    limits = timedelta(minutes=3), timedelta(minutes=30)
    both = point_in_time_joins(e, [Lookup(a, ["v"], "at", None, limits[0]), Lookup(b, ["w"], "seen", None, limits[1])], ["k"], group_rows=group_rows)
    first = point_in_time_join(e, a, ["k"], ["v"], feature_ts="at", ttl=limits[0])
    same(both, point_in_time_join(first, b, ["k"], ["w"], feature_ts="seen", ttl=limits[1]))


def test_no_entities(spark, stats):
    none = spark.createDataFrame([], "driver_id long, event_timestamp timestamp")
    assert point_in_time_join(none, stats, ["driver_id"], ["conv_rate"]).count() == 0


def test_pandas_function_gives_what_expressions_give(spark, stats, entities):
    repo = driver_repo(rows=stats)
    view = repo.view("driver_hourly_stats")

    def rates(inputs):
        return inputs.assign(
            conv_rate_plus_val1=inputs["conv_rate"].astype("float64") + inputs["val_to_add"],
            conv_rate_plus_val2=inputs["conv_rate"].astype("float64") + inputs["val_to_add_2"],
        )[["conv_rate_plus_val1", "conv_rate_plus_val2"]]

    by_pandas = OnDemandView("by_pandas", (view, REQUEST), RATES, pandas_fn=rates)
    service = FeatureService("s", (view, by_pandas))
    fill = lambda df: df.select(*[F.nanvl(c, F.lit(None)).alias(c) if t in ("float", "double") else c for c, t in df.dtypes])
    same(fill(historical_features(spark, entities, service, repo)), fill(historical_features(spark, entities, repo.service("driver_activity_v2"), repo)))


def test_references_and_selections(stats):
    assert parse_ref("view:feature") == ("view", "feature")
    for bad in ("view", "view:", ":feature", "a:b:c"):
        with pytest.raises(ValueError):
            parse_ref(bad)
    repo = driver_repo(rows=stats)
    with pytest.raises(KeyError):
        repo.select(["nothing:here"])
    with pytest.raises(ValueError, match="no feature"):
        repo.select(["driver_hourly_stats:speed"])
    with pytest.raises(ValueError, match="share a name"):
        repo.select(["driver_hourly_stats:conv_rate", "driver_hourly_stats_fresh:conv_rate"])


def test_request_columns_are_checked(spark, stats, entities):
    repo = driver_repo(rows=stats)
    with pytest.raises(ValueError, match="val_to_add"):
        historical_features(spark, entities.drop("val_to_add"), REFS, repo)
    with pytest.raises(TypeError, match="bigint"):
        historical_features(spark, entities.withColumn("val_to_add", F.lit("1")), REFS, repo)


def test_latest_values_and_push(spark, stats, tmp_path):
    repo = driver_repo(store=str(tmp_path / "store"), rows=stats)
    asked = spark.createDataFrame([(1001, 1000, 2000), (1002, 1001, 2002), (1005, 1, 1)], "driver_id long, val_to_add long, val_to_add_2 long")
    assert latest_features(spark, asked, ["driver_hourly_stats:acc_rate"], repo).filter("acc_rate is not null").isEmpty()

    first_end = T("2021-04-12 10:59:42")
    used = materialize_incremental(spark, repo, first_end)
    assert used["driver_hourly_stats"] == (first_end - timedelta(days=1), first_end)
    v1 = repo.service("driver_activity_v1")
    got = latest_features(spark, asked, v1, repo)
    assert got.columns == [*asked.columns, "conv_rate", "conv_rate_plus_val1", "conv_rate_plus_val2"]
    assert tuples(got, "driver_id", "conv_rate", "conv_rate_plus_val1") == [(1001, 0.5, 1000.5), (1002, 0.75, 1001.75), (1005, None, None)]
    assert spark.read.parquet(str(tmp_path / "store/served/driver_activity_v1")).count() == 3

    later = T("2021-04-13 00:00:00")
    assert materialize_incremental(spark, repo, later)["driver_hourly_stats"] == (first_end, later)
    rate = lambda view: dict(tuples(latest_features(spark, asked, [f"{view}:conv_rate"], repo), "driver_id", "conv_rate"))
    assert rate("driver_hourly_stats")[1001] == pytest.approx(0.9)
    materialize_incremental(spark, repo, later)
    assert rate("driver_hourly_stats")[1001] == pytest.approx(0.9)

    now = T("2021-04-14 00:00:00")
    pushed = spark.createDataFrame([(1001, now, now, 1.0, 1.0, 1000)], STATS)
    push(spark, repo, "driver_stats_push_source", pushed, batch=1)
    before = view_history(spark, repo.view("driver_hourly_stats_fresh"), repo).count()
    push(spark, repo, "driver_stats_push_source", pushed, batch=1)  # a retry
    assert view_history(spark, repo.view("driver_hourly_stats_fresh"), repo).count() == before
    assert rate("driver_hourly_stats_fresh")[1001] == 1.0
    assert rate("driver_hourly_stats")[1001] == pytest.approx(0.9)
    v3 = latest_features(spark, asked, repo.service("driver_activity_v3"), repo)
    assert dict(tuples(v3, "driver_id", "conv_rate_plus_val1"))[1001] == 1001.0
    entity = spark.createDataFrame([(1001, now)], "driver_id long, event_timestamp timestamp")
    history = historical_features(spark, entity, ["driver_hourly_stats_fresh:avg_daily_trips"], repo)
    assert history.first().avg_daily_trips == 1000

    # An old row never replaces a newer one, and folding the table changes nothing.
    old = spark.createDataFrame([(1001, T("2021-04-01 00:00:00"), now, 0.0, 0.0, 0)], STATS)
    push(spark, repo, "driver_stats_push_source", old, to="latest")
    assert rate("driver_hourly_stats_fresh")[1001] == 1.0
    view = repo.view("driver_hourly_stats_fresh")
    path = str(tmp_path / "store/latest/driver_hourly_stats_fresh")
    before = read_latest(spark, path, ["driver_id"], view.order)
    rows = tuples(before)
    assert tuples(compact_latest(spark, path, ["driver_id"], view.order)) == rows
    assert rate("driver_hourly_stats_fresh")[1001] == 1.0
