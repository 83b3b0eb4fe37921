"""Clustering by several columns, packing of small files, replacing partitions."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import plan_of, same, tuples
from tidemart.operators.layout import bins, cluster_together, live_files, pack_small_files, read_live, read_ranges, z_value
from tidemart.sources.partitions import replace_partitions, replaced_loads
from tidemart.sources.store import Store


def grid(spark):
    rng = random.Random(1)
    rows = [(i, rng.randrange(1000), rng.choice((None, "a", "b")) if i % 50 == 0 else f"s{rng.randrange(500):03d}") for i in range(4000)]
    return spark.createDataFrame(rows, "id long, x int, s string")


def test_a_filter_on_either_column_opens_a_part_of_the_files(spark, tmp_path):
    path, rows = str(tmp_path / "z"), grid(spark)
    written = cluster_together(rows, ["x", "s"], path, files=16)
    same(written, rows)
    files = len(written.inputFiles())
    assert files == 16
    for wanted, condition in (({"x": (100, 160)}, "x BETWEEN 100 AND 160"), ({"s": ("s100", "s130")}, "s BETWEEN 's100' AND 's130'")):
        got = read_ranges(spark, path, wanted, rows.schema)
        assert len(got.inputFiles()) <= files // 2  # a sort by x alone would open all files for s
        same(got, rows.filter(condition))
    both = read_ranges(spark, path, {"x": (0, 99), "s": ("s000", "s050")}, rows.schema)
    assert len(both.inputFiles()) <= 4
    assert read_ranges(spark, path, {"x": (5000, 6000)}, rows.schema).isEmpty()
    same(read_ranges(spark, path, {"id": (5, 9)}), rows.filter("id BETWEEN 5 AND 9"))  # a column without ranges


def test_one_frequent_combination_fills_several_files(spark, tmp_path):
    rows = spark.range(3000).select("id", F.lit(7).alias("x"), F.lit("a").alias("s"))
    written = cluster_together(rows, ["x", "s"], str(tmp_path / "z"), files=6, group_rows=100)
    assert len(written.inputFiles()) > 3
    same(written, rows)
    assert cluster_together(rows.limit(0), ["x", "s"], str(tmp_path / "empty")).isEmpty()
    with pytest.raises(ValueError, match="bits"):
        cluster_together(rows, ["x", "s", "id"], str(tmp_path / "wide"), bits=30)


def test_z_value_takes_bits_in_turn(spark):
    df = spark.createDataFrame([(0b101, 0b011), (0, 0), (7, 7)], "a long, b long")
    assert [r[0] for r in df.select(z_value([F.col("a"), F.col("b")], 3)).collect()] == [0b011011, 0, 63]


def test_bins_fill_up_to_the_target():
    rng = random.Random(2)
    sizes = [(f"f{i}", rng.randrange(1, 60)) for i in range(80)]
    groups = bins(sizes, 100)
    size = dict(sizes)
    assert sorted(n for g in groups for n in g) == sorted(size)
    assert all(sum(size[n] for n in g) <= 100 for g in groups)
    assert len(groups) <= sum(size.values()) // 100 + 3


def test_large_files_are_left_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(3000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v"))
    rows.filter("id < 2000").coalesce(1).write.parquet(path)
    large = live_files(spark, path)
    rows.filter("id >= 2000 AND id < 2900").repartition(9).write.mode("append").parquet(path)
    before = Store(spark, path).files(path)
    target = large[0][1]
    groups = pack_small_files(spark, path, target)
    assert groups and all(large[0][0] not in g for g in groups)
    assert Store(spark, path).files(path) == before  # nothing is removed or changed while it may be read
    after = live_files(spark, path)
    assert large[0] in after and len(after) == 1 + len(groups)
    same(read_live(spark, path), rows.filter("id < 2900"))
    assert pack_small_files(spark, path, target) == [] or len(live_files(spark, path)) < len(after)
    rows.filter("id >= 2900").repartition(2).write.mode("append").parquet(path)
    same(read_live(spark, path), rows)
    pack_small_files(spark, path, target * 10, small=0.01)
    same(read_live(spark, path), rows)


def test_packing_does_not_shuffle(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).repartition(5).write.parquet(path)
    names = [n for n, _ in live_files(spark, path)]
    one = spark.read.parquet(*[f"{path}/{n}" for n in names]).coalesce(1)
    assert "Exchange" not in plan_of(one)
    assert pack_small_files(spark, path, 1 << 20) == [sorted(names, key=lambda n: (-dict(live_files(spark, path)).get(n, 0), n))] or len(live_files(spark, path)) == 1
    assert read_live(spark, path).count() == 100


def months(spark, rows):
    return spark.createDataFrame(rows, "id int, v string, year int, month string")


def test_only_the_partitions_of_a_load_are_replaced(spark, tmp_path):
    path = str(tmp_path / "p")
    first = [(1, "a", 2026, "01"), (2, "b", 2026, "02"), (3, "c", 2025, "02"), (4, "d", 2026, None)]
    assert len(replace_partitions(months(spark, first), path, ["year", "month"], "src", 0)) == 4
    files = dict(Store(spark, path).files(path))
    late = [(20, "x", 2026, "02"), (21, "y", 2026, "02"), (30, "z", 2027, "01")]
    assert replace_partitions(months(spark, late), path, ["year", "month"], "src", 1) == [
        {"year": 2026, "month": "02"}, {"year": 2027, "month": "01"},
    ]
    read = spark.read.schema(months(spark, first).schema).parquet(path)
    assert tuples(read, "id") == [(1,), (3,), (4,), (20,), (21,), (30,)]
    kept = {n for n in files if n in dict(Store(spark, path).files(path))}
    assert {n.rsplit("/", 1)[0] for n in files} - {n.rsplit("/", 1)[0] for n in kept} == {n.rsplit("/", 1)[0] for n in files if "year=2026/month=02" in n}
    # a repeat changes nothing, whatever it brings; another source counts its batches itself
    assert replace_partitions(months(spark, first), path, ["year", "month"], "src", 1) == []
    assert replace_partitions(months(spark, [(5, "e", 2026, "01")]), path, ["year", "month"], "other", 1) != []
    assert tuples(spark.read.schema(read.schema).parquet(path), "id") == [(3,), (4,), (5,), (20,), (21,), (30,)]
    assert [(r["source"], r["batch"], len(r["partitions"])) for r in replaced_loads(spark, path)] == [("src", 0, 4), ("other", 1, 1), ("src", 1, 2)]
    assert replace_partitions(months(spark, []), path, ["year", "month"], "src", 2) == []


def test_a_load_that_broke_off_is_repeated(spark, tmp_path):
    path = str(tmp_path / "p")
    rows = months(spark, [(1, "a", 2026, "01")])
    rows.write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy("year", "month").parquet(path)
    assert replaced_loads(spark, path) == []
    assert replace_partitions(rows, path, ["year", "month"], "src", 0) == [{"year": 2026, "month": "01"}]
    assert spark.read.parquet(path).count() == 1
