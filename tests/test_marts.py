"""Marts kept up from changes, against the aggregate of the final rows."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import D, tuples
from tidemart.operators.marts import Mart, fold_mart, read_mart, signed, update_mart
from tidemart.sources.tables import read_table

ROW = "struct<day:string,kind:string,qty:int,price:decimal(12,2)>"
CHANGE = f"lsn long, before {ROW}, after {ROW}"
MEASURES = {"rows": ("rows", None), "priced": ("count", "price"), "qty": ("sum", "qty"), "revenue": ("sum", "price"), "avg_qty": ("avg", "qty")}


def mart(path, **more):
    return Mart(str(path), ("day", "kind"), MEASURES, **more)


def aggregate(rows):
    groups = {}
    for day, kind, qty, price in rows:
        groups.setdefault((day, kind), []).append((qty, price))
    out = []
    for key, values in groups.items():
        qs, ps = [q for q, _ in values if q is not None], [p for _, p in values if p is not None]
        out.append((*key, len(values), len(ps), sum(qs) if qs else None, sum(ps) if ps else None, sum(qs) / len(qs) if qs else None))
    return sorted(out, key=str)


def test_random_loads_equal_the_mart_of_the_final_table(spark, tmp_path):
    rng, table, lsn = random.Random(11), {}, 0

    def row():
        return (rng.choice(("d1", "d2", "d3", None)), rng.choice("ab"), rng.choice((None, 1, 2, 5)), rng.choice((None, D("1.50"), D("-2.25"))))

    kept = mart(tmp_path / "m", buckets=4)
    for load in range(6):
        changes = []
        for _ in range(40):
            lsn += 1
            key = rng.randrange(60)
            before, after = table.get(key), (row() if rng.random() < 0.7 - 0.1 * load else None)
            changes.append((lsn, before, after))
            if after is None:
                table.pop(key, None)
            else:
                table[key] = after
        sent = changes + changes[:5]  # some changes are there twice
        rng.shuffle(sent)
        for _ in range(2):  # and so is each load
            update_mart(spark.createDataFrame(sent, CHANGE), kept, source="orders", batch=load, position="lsn")
        if load in (2, 3):
            fold_mart(spark, kept)
        got = read_mart(spark, kept)
        assert got.columns == ["day", "kind", *MEASURES]
        assert sorted((tuple(r) for r in got.collect()), key=str) == aggregate(table.values())


def test_a_group_whose_rows_are_gone_disappears(spark, tmp_path):
    kept, a, b = mart(tmp_path / "m"), ("d1", "a", 2, D("3.00")), ("d1", "b", None, None)
    update_mart(spark.createDataFrame([(1, None, a), (2, None, b)], CHANGE), kept)
    update_mart(spark.createDataFrame([(3, a, None), (4, b, a)], CHANGE), kept)
    update_mart(spark.createDataFrame([(5, a, b)], CHANGE), kept)
    assert tuples(read_mart(spark, kept)) == [("d1", "b", 1, 0, None, None, None)]
    update_mart(spark.createDataFrame([(6, b, None)], CHANGE), kept)
    assert read_mart(spark, kept).isEmpty()
    assert fold_mart(spark, kept).isEmpty() and read_table(spark, kept.path).isEmpty()


def test_loads_in_any_order(spark, tmp_path):
    a, b = ("d1", "a", 2, D("3.00")), ("d2", "a", 4, D("1.00"))
    kept = mart(tmp_path / "m")
    update_mart(spark.createDataFrame([(2, a, b)], CHANGE), kept)
    assert tuples(read_mart(spark, kept), "day", "qty") == [("d2", 4)]  # a group below nothing is not shown
    update_mart(spark.createDataFrame([(1, None, a)], CHANGE), kept)
    assert tuples(read_mart(spark, kept), "day", "qty") == [("d2", 4)]


def test_read_of_some_groups(spark, tmp_path):
    kept = mart(tmp_path / "m", buckets=8)
    rows = [(i, None, (f"d{i}", None if i % 2 else "a", i, Decimal(i))) for i in range(40)]
    update_mart(spark.createDataFrame(rows, CHANGE), kept)
    fold_mart(spark, kept)
    asked = spark.createDataFrame([("d3", None), ("d4", "a"), ("d5", "a")], "day string, kind string")
    got = read_mart(spark, kept, asked)
    assert tuples(got, "day", "qty") == [("d3", 3), ("d4", 4)]
    assert len(got.inputFiles()) < len(read_mart(spark, kept).inputFiles())


def test_dimension_shape_and_wrong_measures(spark, tmp_path):
    kept = Mart(str(tmp_path / "m"), ("name",), {"qty": ("sum", "qty")})
    names = spark.createDataFrame([("a", "x"), ("b", "x")], "kind string, name string")
    rows = [(1, None, ("d1", "a", 2, None)), (2, None, ("d1", "b", 3, None)), (3, None, ("d1", "unknown", 9, None))]
    update_mart(spark.createDataFrame(rows, CHANGE), kept, lambda deltas: deltas.join(names, "kind"), by=["kind"])
    assert tuples(read_mart(spark, kept)) == [("x", 5)]
    with pytest.raises(ValueError, match="max"):
        Mart("p", ("name",), {"most": ("max", "qty")})
    assert signed(spark.createDataFrame([(1, None, None)], CHANGE)).isEmpty()
    assert read_mart(spark, mart(tmp_path / "none")) is None


def test_doubles_and_longs_keep_their_kind(spark, tmp_path):
    kept = Mart(str(tmp_path / "m"), ("k",), {"x": ("sum", "x"), "n": ("sum", "n")})
    row = "struct<k:string,x:double,n:bigint>"
    changes = spark.createDataFrame([(None, ("a", 1.5, 2**40)), (None, ("a", 2.25, 1))], f"before {row}, after {row}")
    update_mart(changes, kept)
    update_mart(changes.select(F.col("after").alias("before"), F.col("before").alias("after")).limit(1), kept)
    assert read_mart(spark, kept).dtypes == [("k", "string"), ("x", "double"), ("n", "bigint")]
    assert read_mart(spark, kept).first()["k"] == "a"
