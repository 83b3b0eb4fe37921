"""Rules, suites, the gate and profiles."""

import pytest

from helpers import D, tuples
from tidemart.operators.quality import (
    QualityGateFailed, between, completeness, distribution, foreign_key, in_set, not_null, passed, profile,
    row_count_between, unexpected_values, unique, uniqueness, validate, volume,
)
from tidemart.plans.gate import check, orders_suite, run_gated
from tidemart.plans.medallion import RAW_ORDERS
from test_batch import RAW


@pytest.fixture(scope="module")
def orders(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("q") / "orders.csv"
    path.write_text(RAW)
    return spark.read.schema(RAW_ORDERS).option("header", True).csv(str(path))


def test_orders_suite(orders):
    results = validate(orders, orders_suite())
    assert not passed(results)
    assert set(tuples(results, "rule", "column", "success", "unexpected")) == {
        ("between", "quantity", True, 0), ("between", "unit_price", True, 0), ("in_set", "order_status", False, 5),
        ("not_null", "customer_id", False, 0), ("not_null", "order_id", True, 0),
        ("row_count_between", None, True, 0), ("unique", "order_id", True, 0),
    }
    values = unexpected_values(orders, in_set("order_status", ["paid"]))
    assert tuples(values) == [("CANCELLED", 1), ("COMPLETED", 3), ("PENDING", 1)]


def verdicts(df, *rules):
    return {(r.rule, r.column): (r.success, r.checked, r.unexpected) for r in validate(df, list(rules)).collect()}


def test_rules(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 2.0), (2, None), (None, 40.0)], "k int, v double")
    parent = spark.createDataFrame([(1,), (1,)], "id int")
    got = verdicts(
        df, not_null("k"), unique("k"), between("v", 1, 2), row_count_between(5, 9), completeness("v", 0.7),
        completeness("k", 0.8), uniqueness("k", 0.3), foreign_key("k", parent, "id"),
    )
    assert got[("not_null", "k")] == (False, 4, 1)
    assert got[("unique", "k")] == (False, 3, 2)
    assert got[("between", "v")] == (False, 3, 1)
    assert got[("row_count_between", None)] == (False, 4, 0)
    assert got[("completeness", "k")] == (False, 4, 1)
    assert got[("uniqueness", "k")] == (True, 3, 2)
    assert got[("foreign_key", "k")] == (False, 3, 1)
    assert verdicts(df, completeness("v", 0.75))[("completeness", "v")] == (True, 4, 1)
    assert tuples(unexpected_values(df, unique("k"))) == [(1, 2)]


def test_rules_on_no_rows(spark):
    df = spark.createDataFrame([], "k int")
    got = verdicts(df, not_null("k"), unique("k"), between("k", 0, 1), completeness("k"), row_count_between(1, 5))
    assert [v[0] for k, v in got.items() if k[0] != "row_count_between"] == [True] * 4
    assert got[("row_count_between", None)][0] is False


def test_history_rules(spark):
    past = spark.createDataFrame([(float(v),) for v in (9, 10, 11)], "price double")
    near, far = past.selectExpr("price + 1 price"), past.selectExpr("price * 1000 price")
    assert verdicts(near, distribution("price", past, 2))[("distribution", "price")][0]
    assert not verdicts(far, distribution("price", past, 3))[("distribution", "price")][0]
    more = past.union(past)
    assert verdicts(past, volume(past))[("volume", None)][0]
    assert not verdicts(more, volume(past))[("volume", None)][0]


def test_gate_stops_before_any_write(spark, orders, tmp_path):
    steps = []

    def step(name, value):
        def run(*_):
            steps.append(name)
            return value
        return run

    with pytest.raises(QualityGateFailed, match="order_status"):
        run_gated(step("ingest", orders), step("transform", orders), step("publish", orders), orders_suite(), step("ready", None))
    assert steps == ["ready", "ingest"]
    steps.clear()
    suite = [not_null("order_id"), unique("order_id")]
    run_gated(step("ingest", orders), step("transform", orders), step("publish", orders), suite)
    assert steps == ["ingest", "transform", "publish"]
    assert check(orders, suite) is orders


def test_profile(spark):
    df = spark.createDataFrame([(1, D("2.50"), "b"), (1, None, "a"), (3, D("1.00"), "a")], "k int, v decimal(9,2), s string")
    expected = [("k", 3, 0, 2, "1", "3"), ("s", 3, 0, 2, "a", "b"), ("v", 3, 1, 2, "1.00", "2.50")]
    assert tuples(profile(df, exact=True)) == expected
    assert tuples(profile(df)) == expected
    empty = spark.createDataFrame([(None,)], "k int")
    assert tuples(profile(empty, exact=True)) == [("k", 1, 1, 0, None, None)]
