"""Profiles that merge, and uniqueness of a load against a table's keys."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from helpers import tuples
from tidemart.operators import quality as q
from tidemart.operators.sketches import distribution_from, merge_sketches, profile_of, sketch, volume_from
from tidemart.operators.uniques import KeyIndex, doubtful, fold_index, new_rows, remember, repeated_keys
from tidemart.sources.tables import read_table


def rows(spark, count=3000):
    rng = random.Random(8)
    data = [
        (i, i % 7, rng.gauss(1e6, 2.0) if i % 11 else None, rng.choice(("a", "b", None)), date(2026, 1, 1) + timedelta(days=rng.randrange(300)),
         datetime(2026, 1, 1) + timedelta(seconds=rng.randrange(10**6)), i % 2 == 0, float("nan") if i % 100 == 0 else 1.0, None)
        for i in range(count)
    ]
    return spark.createDataFrame(data, "id long, part int, x double, s string, d date, t timestamp, b boolean, f double, none int")


def test_merged_sketches_equal_one_pass(spark, tmp_path):
    df = rows(spark)
    sketch(df, ["part"]).write.parquet(str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    halves = merge_sketches(stored.withColumn("half", F.col("part") % 2).drop("part"), ["half"])
    merged = {r["column"]: r for r in profile_of(merge_sketches(halves.drop("half")), [0.1, 0.5]).collect()}
    exact = {r["column"]: r for r in q.profile(df.drop("part"), exact=True).collect()}
    assert merged.keys() == exact.keys()
    for c, r in merged.items():
        e = exact[c]
        assert (r["rows"], r["nulls"], r["smallest"], r["largest"]) == (e["rows"], e["nulls"], e["smallest"], e["largest"])
        assert abs(r["distinct_values"] - e["distinct_values"]) <= 0.08 * e["distinct_values"] + 1
    mean, sd = df.agg(F.avg("x"), F.stddev("x")).first()
    assert merged["x"]["mean"] == pytest.approx(mean, rel=1e-12) and merged["x"]["deviation"] == pytest.approx(sd, rel=1e-6)
    low, mid = merged["id"]["quantiles"]
    assert abs(low - 300) < 150 and abs(mid - 1500) < 150
    assert merged["f"]["mean"] == 1.0 and merged["s"]["mean"] is None and merged["none"]["quantiles"] is None


def test_sketches_of_nothing(spark):
    empty = merge_sketches(sketch(rows(spark).limit(0)))
    assert {(r["rows"], r["nulls"], r["distinct_values"]) for r in profile_of(empty).collect()} == {(0, 0, 0)}


def test_rules_that_read_sketches_only(spark):
    df = rows(spark).select("id", "x")
    past, now = df.filter("id < 2000"), df.filter("id >= 2000")
    kept = sketch(past.withColumn("part", F.col("id") % 3), ["part"]).drop("part")
    results = lambda rules, data: [tuple(r)[:5] for r in q.validate(data, rules).collect()]
    for data in (now, now.withColumn("x", F.col("x") + 100), now.limit(0)):
        assert results([distribution_from("x", kept, 1.0)], data) == results([q.distribution("x", past, 1.0)], data)
        assert results([volume_from(kept, 0.5)], data) == results([q.volume(past, 0.5)], data)


def test_uniqueness_against_earlier_loads(spark, tmp_path):
    rng = random.Random(6)
    index = KeyIndex(str(tmp_path / "i"), ("a", "b"), buckets=8, bits=1 << 18)
    known: set = set()
    for load in range(4):
        keys = [(rng.randrange(60) if rng.random() < 0.95 else None, rng.choice("xyz")) for _ in range(80)]
        df = spark.createDataFrame([(*k, i) for i, k in enumerate(keys)], "a int, b string, row int")
        count = {k: keys.count(k) for k in keys if None not in k}
        expected = sorted((*k, n, k in known) for k, n in count.items() if n > 1 or k in known)
        assert tuples(repeated_keys(df, index), "a", "b", "rows", "in_table") == expected
        fresh = sorted(i for i, k in enumerate(keys) if None in k or (count[k] == 1 and k not in known))
        assert sorted(r["row"] for r in new_rows(df, index).collect()) == fresh
        for _ in range(2):  # a repeated load is remembered once
            remember(df, index, "loads", load)
        known |= count.keys()
        if load == 1:
            fold_index(spark, index)
            assert read_table(spark, index.keys_path).count() == len(known)


def test_only_doubtful_buckets_are_read(spark, tmp_path):
    index = KeyIndex(str(tmp_path / "i"), ("a",), buckets=16, bits=1 << 22)
    remember(spark.range(1000).select(F.col("id").alias("a")), index)
    fold_index(spark, index)
    load = spark.createDataFrame([(5,), (5000,), (6000,), (7000,), (7000,)], "a long")
    asked = doubtful(load, index)
    assert tuples(asked) == [(5,)]  # the others' bits are not set
    assert len(read_table(spark, index.keys_path, asked).inputFiles()) == 1
    assert tuples(repeated_keys(load, index)) == [(5, 1, True), (7000, 2, False)]
    small = KeyIndex(str(tmp_path / "small"), ("a",), buckets=4, bits=32768)
    remember(spark.range(30000).select(F.col("id").alias("a")), small)  # a crowded bitmap gives more doubt, not other results
    assert doubtful(load, small).count() >= 1
    assert tuples(repeated_keys(load, small)) == [(5, 1, True), (5000, 1, True), (6000, 1, True), (7000, 2, True)]
    assert doubtful(load, KeyIndex(str(tmp_path / "none"), ("a",))).isEmpty()
