"""Point-in-time joins on stored histories."""

import random
import re
import uuid
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from helpers import plan_of, same, tuples
from tidemart.operators import asof
from tidemart.operators.features import Entity, FeatureRepo, FeatureSource, FeatureView, historical_features, push
from tidemart.operators.asof import Lookup, StoredLookup, point_in_time_join, point_in_time_joins, point_in_time_stored, store_history

START = datetime(2026, 1, 1)


def frames(spark, seed=3, users=12):
    rng = random.Random(seed)
    at = lambda: START + timedelta(minutes=rng.randrange(2000))
    facts = [(rng.choice([*range(users), None]), at(), at(), rng.choice((None, i)), f"t{i}") for i in range(600)]
    asked = [(i, rng.choice([*range(users + 3), None]), at()) for i in range(200)]
    return (
        spark.createDataFrame(facts, "user_id long, event_timestamp timestamp, created timestamp, v long, w string"),
        spark.createDataFrame(asked, "row long, user_id long, event_timestamp timestamp"),
    )


def stored(df, tmp_path, **more):
    name = f"history_{uuid.uuid4().hex}"
    return store_history(df, name, str(tmp_path / name), ["user_id"], created="created", **more)


def above_scan(plan, table):
    """The operators between the scan of a table and the top of a plan, from the tree that `explain` draws."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if "FileScan" in line and table in line)
    depth, out = len(re.match(r"[\s:+\-*()\d]*", lines[at]).group()), []
    for line in reversed(lines[:at]):
        own = len(re.match(r"[\s:+\-*()\d]*", line).group())
        if own < depth:
            depth = own
            out.append(line.strip(" :+-*()0123456789"))
    return out


@pytest.mark.parametrize("ttl", [None, timedelta(minutes=90)])
def test_stored_history_gives_the_same_rows(spark, tmp_path, ttl):
    facts, asked = frames(spark)
    history = stored(facts, tmp_path, buckets=5)
    got = point_in_time_stored(asked, [StoredLookup(history, ["v", "w"], ttl)])
    assert got.columns == [*asked.columns, "v", "w"]
    same(got, point_in_time_join(asked, facts, ["user_id"], ["v", "w"], created="created", ttl=ttl))


def test_no_exchange_above_the_history(spark, tmp_path):
    facts, asked = frames(spark)
    history = stored(facts, tmp_path, buckets=5)
    got = point_in_time_stored(asked, [StoredLookup(history, ["v"])])
    path = above_scan(plan_of(got, "simple"), history.table)
    assert any("Union" in x for x in path) and any("Window" in x for x in path)
    assert not any("Exchange" in x for x in path)
    # also when the semi join with the entities' keys is too large to broadcast
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wide = point_in_time_stored(asked, [StoredLookup(history, ["v"])])
        assert not any("Exchange" in x for x in above_scan(plan_of(wide, "simple"), history.table))
        same(wide, got)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("group_rows", [10, 45])
def test_large_keys_take_the_other_route(spark, tmp_path, group_rows):
    facts, asked = frames(spark)
    heavy = facts.withColumn("user_id", F.when(F.col("v") % 2 == 0, F.lit(1)).otherwise(F.col("user_id")))
    asked = asked.withColumn("user_id", F.when(F.col("row") % 3 == 0, F.lit(2)).otherwise(F.col("user_id")))
    history = stored(heavy, tmp_path, buckets=3, group_rows=group_rows)
    assert history.wide is not None and (1,) in tuples(spark.read.parquet(history.hot))
    got = point_in_time_stored(asked, [StoredLookup(history, ["v", "w"])], group_rows=group_rows)
    same(got, point_in_time_join(asked, heavy, ["user_id"], ["v", "w"], created="created"))
    same(history.rows(spark), heavy.dropna(subset=["user_id"]))


def test_many_large_keys_of_a_history_share_few_pieces(spark, tmp_path, monkeypatch):
    facts, asked = frames(spark)
    counts = []
    whole = asof.sorted_pieces
    monkeypatch.setattr(asof, "sorted_pieces", lambda df, order, pieces: counts.append(pieces) or whole(df, order, pieces))
    history = stored(facts, tmp_path, buckets=3, group_rows=5)
    got = point_in_time_stored(asked, [StoredLookup(history, ["v", "w"])], group_rows=5)
    same(got, point_in_time_join(asked, facts, ["user_id"], ["v", "w"], created="created"))
    assert counts == [4]


def test_large_keys_of_a_history_are_found_once(spark, tmp_path, monkeypatch):
    """The entity rows of the large keys are picked by literal keys, not by counting and uniting them in every use."""
    facts, asked = frames(spark)
    picked = []
    whole = asof.point_in_time_joins
    monkeypatch.setattr(asof, "point_in_time_joins", lambda rows, *rest: picked.append(plan_of(rows, "simple")) or whole(rows, *rest))
    history = stored(facts, tmp_path, buckets=3, group_rows=5)
    got = point_in_time_stored(asked, [StoredLookup(history, ["v", "w"])], group_rows=5)
    assert "Union" not in picked[0] and "Aggregate" not in picked[0] and "BroadcastHashJoin" in picked[0]
    same(got, point_in_time_join(asked, facts, ["user_id"], ["v", "w"], created="created"))


def test_several_histories_and_wrong_layouts(spark, tmp_path):
    facts, asked = frames(spark)
    other = frames(spark, seed=9)[0].select("user_id", "event_timestamp", "created", F.col("v").alias("x"))
    one, two = stored(facts, tmp_path, buckets=4), stored(other, tmp_path, buckets=4)
    got = point_in_time_stored(asked, [StoredLookup(one, ["v"]), StoredLookup(two, ["x"], timedelta(hours=1))])
    same(got, point_in_time_joins(
        asked, [Lookup(facts, ["v"], created="created"), Lookup(other, ["x"], created="created", ttl=timedelta(hours=1))], ["user_id"]
    ))
    with pytest.raises(ValueError, match="same keys and buckets"):
        point_in_time_stored(asked, [StoredLookup(one, ["v"]), StoredLookup(stored(other, tmp_path, buckets=3), ["x"])])
    assert point_in_time_stored(asked.limit(0), [StoredLookup(one, ["v"])]).isEmpty()


def test_views_on_stored_histories(spark, tmp_path):
    facts, asked = frames(spark)
    schema = StructType([StructField("v", DoubleType())])
    user = Entity("user", ("user_id",))
    laid = FeatureView("seen", user, schema, FeatureSource("facts", stored=stored(facts, tmp_path, buckets=4)), timedelta(hours=2))
    plain = FeatureView("seen", user, schema, FeatureSource("facts", rows=facts), timedelta(hours=2))
    sets = [historical_features(spark, asked, ["seen:v"], FeatureRepo((v,), store=str(tmp_path / "store"))) for v in (laid, plain)]
    assert sets[0].schema["v"].dataType == DoubleType()
    same(*sets)
    repo = FeatureRepo((laid,), store=str(tmp_path / "store"))
    new = spark.createDataFrame([(1, START, START, 77, "x")], facts.schema)
    push(spark, repo, "facts", new, to="history")
    ask = spark.createDataFrame([(1, 1, START)], asked.schema)
    assert historical_features(spark, ask, ["seen:v"], repo).first()["v"] == 77.0
