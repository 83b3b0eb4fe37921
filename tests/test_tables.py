"""Tables with a commit log and buckets of keys."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import plan_of, same, tuples
from tidemart.operators.ordered import latest_per_key
from tidemart.sources.store import Store
from tidemart.sources.tables import (
    BUCKET, KEPT_COMMITS, State, add_rows, bucket_of, fold, publish, read_reduced, read_table, table_state, touched_buckets, vacuum,
)

SCHEMA = "k long, t long, v string"


def newest(rows):
    return latest_per_key(rows, ["k"], ["t"])


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def base_files(spark, path):
    return {p.rpartition("/base/")[2] for p, _ in Store(spark, path).files(f"{path}/base")}


def test_a_fold_rewrites_only_touched_buckets(spark, tmp_path):
    path = str(tmp_path / "t")
    add_rows(frame(spark, [(i, 0, "a") for i in range(300)]), path, keys=["k"], buckets=8)
    fold(spark, path, newest)
    before = base_files(spark, path)
    assert len({f.split("/")[1] for f in before}) == 8
    one = frame(spark, [(7, 1, "b"), (7, 2, "c")])
    hit = one.select(bucket_of(["k"], 8)).first()[0]
    add_rows(one, path)
    assert touched_buckets(spark, path) == {hit}
    same(newest(read_table(spark, path)), read_reduced(spark, path, newest))
    fold(spark, path, newest)
    after = base_files(spark, path)
    assert before <= after  # files of untouched buckets keep their names
    assert {f.split("/")[1] for f in after - before} == {f"{BUCKET}={hit}"}
    assert tuples(read_table(spark, path).filter("k IN (7, 8)")) == [(7, 2, "c"), (8, 0, "a")]
    assert read_table(spark, path).count() == 300
    gone = vacuum(spark, path)
    assert any(f"{BUCKET}={hit}" in g for g in gone) and any("/deltas/" in g for g in gone)
    assert read_table(spark, path).count() == 300 and vacuum(spark, path) == []


def test_a_read_of_keys_opens_only_their_buckets(spark, tmp_path):
    path = str(tmp_path / "t")
    add_rows(frame(spark, [(i, 0, "a") for i in range(300)]), path, keys=["k"], buckets=8)
    fold(spark, path, newest)
    add_rows(frame(spark, [(i, 1, "b") for i in range(100)]), path)
    asked = spark.createDataFrame([(5,)], "k int")  # of another type than the table's
    buckets = {frame(spark, [(5, 0, "")]).select(bucket_of(["k"], 8)).first()[0]}
    got = read_reduced(spark, path, newest, asked)
    assert {int(f.split(f"{BUCKET}=")[1].split("/")[0]) for f in got.inputFiles()} == buckets
    assert tuples(got.filter("k = 5")) == [(5, 1, "b")]


def test_settled_buckets_are_not_aggregated(spark, tmp_path):
    path = str(tmp_path / "t")
    add_rows(frame(spark, [(i, 0, "a") for i in range(50)]), path, keys=["k"], buckets=4)
    fold(spark, path, newest)
    settled = read_reduced(spark, path, newest)
    assert "Exchange" not in plan_of(settled) and "Aggregate" not in plan_of(settled)


def test_many_loads_equal_one(spark, tmp_path):
    rng = random.Random(5)
    path, rows = str(tmp_path / "t"), []
    for load in range(6):
        part = [(rng.randrange(40) if rng.random() < 0.9 else None, len(rows) + i, rng.choice("abc")) for i in range(30)]
        rows += part
        assert add_rows(frame(spark, part), path, "loads", load, keys=["k"], buckets=5) is not None
        assert add_rows(frame(spark, part), path, "loads", load) is None  # a repeat
        if load % 2:
            fold(spark, path, newest)
    same(read_reduced(spark, path, newest), newest(frame(spark, rows)))
    assert table_state(spark, path).batches == {"loads": [[0, 5]]}


def test_commits_stay_few_and_unfinished_work_does_not_count(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(KEPT_COMMITS + 4):
        add_rows(frame(spark, [(i, i, "x")]), path)
    names = Store(spark, path).names(f"{path}/commits")
    assert len(names) == KEPT_COMMITS
    number = table_state(spark, path).last + 1
    frame(spark, [(99, 99, "half")]).write.parquet(f"{path}/deltas/d={number}")  # a writer that died before its commit
    assert read_table(spark, path).count() == KEPT_COMMITS + 4
    assert add_rows(frame(spark, [(100, 100, "whole")]), path) == number
    assert read_table(spark, path).filter("k >= 99").count() == 1


def test_layout_is_fixed_by_the_first_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    assert read_table(spark, path) is None and fold(spark, path, newest) is None
    add_rows(frame(spark, []), path, keys=["k"], buckets=3)
    assert read_table(spark, path).count() == 0 and fold(spark, path, newest).count() == 0
    add_rows(spark.createDataFrame([("1", "2", 3)], "v string, t string, k int").select("t", "v", "k"), path)
    assert tuples(read_table(spark, path), "k", "t", "v") == [(3, 2, "1")]
    with pytest.raises(ValueError, match="keys"):
        add_rows(frame(spark, []), path, keys=["t"])
    published = publish(frame(spark, [(1, 1, "p")]), path)
    assert tuples(published) == [(1, 1, "p")] and table_state(spark, path).keys == ("k",)


def test_batches_are_kept_as_ranges():
    state = State()
    for batch in (0, 1, 3, 2, None, 7):
        assert not state.holds("s", batch)
        state = state.with_batch("s", batch)
        assert state.holds("s", batch) and not state.holds("other", batch)
    assert state.batches["s"] == [[-1, 3], [7, 7]]


def test_store_notes(spark, tmp_path):
    store, path = Store(spark, str(tmp_path)), str(tmp_path / "notes/a")
    assert store.names(str(tmp_path / "none")) == []
    store.create(path, "één")
    assert store.read(path) == "één" and store.names(str(tmp_path / "notes")) == ["a"]
    with pytest.raises(FileExistsError):
        store.create(path, "two")
    assert store.read(path) == "één"
    frame(spark, [(1, 1, "a")]).coalesce(1).write.partitionBy("k").parquet(str(tmp_path / "p"))
    assert [p.rpartition("/")[2].startswith("part-") for p, size in store.files(str(tmp_path / "p")) if size] == [True]
