"""Changes before the open version, against histories worked out day by day."""

import random
from datetime import date, timedelta

from pyspark.sql import functions as F

from helpers import day, tuples
from tidemart.operators.dimensions import Tracking, refused_changes, scd2, scd6
from tidemart.plans.warehouse import load_dimension
from tidemart.sources.tables import publish

TRACK = Tracking(previous={"city": "previous_city"}, current={"city": "current_city"})
DIM = (
    "customer_key int, customer_id int, full_name string, city string, effective_date date, end_date date, "
    "current_flag boolean, previous_city string, current_city string"
)
CHANGES = "customer_id int, city string, effective_date date"
COLUMNS = ["customer_key", "city", "effective_date", "end_date", "current_flag", "previous_city"]


def versions(*rows, customer=1, first_key=1):
    """Rows of a dimension from (city, start, end)."""
    out, before = [], None
    for i, (city, start, end) in enumerate(rows):
        out.append((first_key + i, customer, "Name", city, day(start), end and day(end), end is None, before, city))
        before = city
    return out


def spliced(spark, dim, changes, how=scd2):
    dim = spark.createDataFrame(dim, DIM)
    told = spark.createDataFrame([(1, c, day(d) if d else None) for c, d in changes], CHANGES)
    return how(dim, told, ["city"], TRACK, backdated=True)


def got(spark, dim, changes, how=scd2, columns=COLUMNS):
    rows = spliced(spark, dim, changes, how).orderBy("effective_date", "customer_key").select(*columns).collect()
    return [tuple(str(v) if isinstance(v, date) else v for v in r) for r in rows]


HISTORY = versions(("A", "2026-01-01", "2026-01-31"), ("B", "2026-02-01", "2026-03-31"), ("C", "2026-04-01", None))


def test_a_change_inside_closed_history_splits_the_version(spark):
    assert got(spark, HISTORY, [("X", "2026-02-10")]) == [
        (1, "A", "2026-01-01", "2026-01-31", False, None),
        (2, "B", "2026-02-01", "2026-02-09", False, "A"),
        (4, "X", "2026-02-10", "2026-03-31", False, "B"),
        (3, "C", "2026-04-01", None, True, "X"),
    ]


def test_a_change_to_what_comes_next_lets_that_start_earlier(spark):
    assert got(spark, HISTORY, [("C", "2026-03-01")]) == [
        (1, "A", "2026-01-01", "2026-01-31", False, None),
        (2, "B", "2026-02-01", "2026-02-28", False, "A"),
        (3, "C", "2026-03-01", None, True, "B"),
    ]


def test_before_the_first_version_and_without_effect(spark):
    assert got(spark, HISTORY, [("X", "2025-12-01"), ("B", "2026-02-15"), ("C", "2026-08-01")]) == [
        (4, "X", "2025-12-01", "2025-12-31", False, None),
        (1, "A", "2026-01-01", "2026-01-31", False, "X"),
        (2, "B", "2026-02-01", "2026-03-31", False, "A"),
        (3, "C", "2026-04-01", None, True, "B"),
    ]
    assert got(spark, HISTORY, [("A", "2025-12-01")])[0] == (1, "A", "2025-12-01", "2026-01-31", False, None)


def test_several_changes_in_one_version_and_after_the_last(spark):
    assert got(spark, HISTORY, [("Y", "2026-02-20"), ("X", "2026-02-10"), ("X", "2026-02-25"), ("Z", "2026-05-01")]) == [
        (1, "A", "2026-01-01", "2026-01-31", False, None),
        (2, "B", "2026-02-01", "2026-02-09", False, "A"),
        (4, "X", "2026-02-10", "2026-02-19", False, "B"),
        (5, "Y", "2026-02-20", "2026-02-24", False, "X"),
        (6, "X", "2026-02-25", "2026-03-31", False, "Y"),
        (3, "C", "2026-04-01", "2026-04-30", False, "X"),
        (7, "Z", "2026-05-01", None, True, "C"),
    ]


def test_gaps_stay_and_closed_keys_take_no_later_change(spark):
    gap = versions(("A", "2026-01-01", "2026-01-10"), ("B", "2026-02-01", "2026-02-28"))
    assert [r[:5] for r in got(spark, gap, [("X", "2026-01-05"), ("Y", "2026-01-20"), ("Z", "2026-03-05")])] == [
        (1, "A", "2026-01-01", "2026-01-04", False),
        (3, "X", "2026-01-05", "2026-01-10", False),
        (4, "Y", "2026-01-20", "2026-01-31", False),
        (2, "B", "2026-02-01", "2026-02-28", False),
    ]
    dim = spark.createDataFrame(gap, DIM)
    told = spark.createDataFrame([(1, "Z", day("2026-03-05")), (1, "Y", None), (9, "Q", day("2026-01-01")), (1, "X", day("2026-01-05"))], CHANGES)
    assert tuples(refused_changes(dim, told, ["city"], TRACK, backdated=True), "customer_id", "reason") == [
        (1, "after the last version ended"), (1, "no date"), (9, "no version"),
    ]


def test_newest_value_on_every_version(spark):
    rows = got(spark, HISTORY, [("X", "2026-02-10")], scd6, ["city", "current_city"])
    assert rows == [("A", "C"), ("B", "C"), ("X", "C"), ("C", "C")]
    assert got(spark, HISTORY, [("X", "2026-02-10")], scd2, ["city", "current_city"])[2] == ("X", "X")


def test_other_keys_and_columns_stay(spark, tmp_path):
    dim = HISTORY + versions(("A", "2026-01-01", None), customer=2, first_key=10)
    path = str(tmp_path / "dim")
    publish(spark.createDataFrame(dim, DIM), path)
    told = spark.createDataFrame([(1, "X", day("2026-02-10"))], CHANGES)
    once = tuples(load_dimension(spark, path, told, ["city"], TRACK, 2, backdated=True))
    assert (11, 1, "Name", "X", day("2026-02-10"), day("2026-03-31"), False, "B", "X") in once
    assert (10, 2, "Name", "A", day("2026-01-01"), None, True, None, "A") in once
    assert tuples(load_dimension(spark, path, told, ["city"], TRACK, 2, backdated=True)) == once  # a repeated load


def test_any_order_of_loads_gives_the_same_days(spark):
    """Values of every day, whichever way the same changes are cut into loads. Each change has a value of its own."""
    rng = random.Random(4)
    start = date(2026, 1, 1)
    days = sorted(rng.sample(range(1, 200), 24))
    told = [(f"v{d}", str(start + timedelta(days=d))) for d in days]
    expected = got(spark, versions(("v0", "2026-01-01", None)), told, columns=COLUMNS[1:])
    for seed in range(2):
        cut = told[:]
        random.Random(seed).shuffle(cut)
        dim = spark.createDataFrame(versions(("v0", "2026-01-01", None)), DIM)
        for part in (cut[:10], cut[10:]):
            rows = spark.createDataFrame([(1, c, day(d)) for c, d in part], CHANGES)
            dim = scd2(dim, rows, ["city"], TRACK, backdated=True)
        rows = dim.orderBy("effective_date").select(*COLUMNS[1:]).collect()
        merged = [tuple(str(v) if isinstance(v, date) else v for v in r) for r in rows]
        assert by_day(merged) == by_day(expected)
        assert dim.select("customer_key").distinct().count() == dim.count()
        assert dim.filter(F.col("current_flag")).count() == 1


def by_day(rows):
    out, last = {}, date(2026, 9, 1)
    for city, start, end, flag, before in rows:
        at = day(start)
        while at <= (last if end in (None, "None") else day(end)):
            assert at not in out
            out[at] = city
            at += timedelta(days=1)
    return out
