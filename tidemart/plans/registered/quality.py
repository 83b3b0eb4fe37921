"""Quality suites, unexpected values, the gate and profiles."""

from pyspark.sql import DataFrame, functions as F

from tidemart.operators import quality as q
from tidemart.operators.gold import revenue_by_day
from tidemart.operators.sketches import merge_sketches, profile_of, sketch
from tidemart.operators.uniques import KeyIndex, fold_index, remember, repeated_keys
from tidemart.plans.gate import run_gated
from tidemart.plans.registered.base import query, table
from tidemart.plans.registered.warehouse import fact
from tidemart.sources.readers import path_exists
from tidemart.sources.scratch import scratch_path

_SHOWN = ["rule", "column", "success", "checked", "unexpected"]


def _shown(results):
    return results.select(*_SHOWN).fillna({"column": "table"})


def _rule(rule, col, success, checked, unexpected, source="orders"):
    return (
        f"SELECT '{rule}' AS rule, '{col}' AS \"column\", {success} AS success, CAST({checked} AS BIGINT) AS checked, "
        f"CAST({unexpected} AS BIGINT) AS unexpected FROM {source}"
    )


_CUSTKEYS = "(SELECT count(*) AS n FROM orders GROUP BY o_custkey) g"


@query(" UNION ALL ".join([
    _rule("not_null", "o_orderkey", "count(*) = count(o_orderkey)", "count(*)", "count(*) - count(o_orderkey)"),
    _rule("unique", "o_orderkey", "count(*) = count(DISTINCT o_orderkey)", "count(*)", "0"),
    _rule("unique", "o_custkey", "count_if(n > 1) = 0", "sum(n)", "coalesce(sum(n) FILTER (WHERE n > 1), 0)", _CUSTKEYS),
    _rule("uniqueness", "o_custkey", "coalesce(sum(n) FILTER (WHERE n = 1), 0) / sum(n) >= 0.5", "sum(n)", "coalesce(sum(n) FILTER (WHERE n > 1), 0)", _CUSTKEYS),
    _rule("between", "o_totalprice", "count_if(NOT o_totalprice BETWEEN 1000 AND 300000) = 0", "count(*)", "count_if(NOT o_totalprice BETWEEN 1000 AND 300000)"),
    _rule("in_set", "o_orderstatus", "count_if(o_orderstatus NOT IN ('F', 'O')) = 0", "count(*)", "count_if(o_orderstatus NOT IN ('F', 'O'))"),
    _rule("row_count_between", "table", "count(*) BETWEEN 1 AND 100000000000", "count(*)", "0"),
    _rule("completeness", "o_custkey", "count(o_custkey) >= 0.99 * count(*)", "count(*)", "count(*) - count(o_custkey)"),
    _rule("foreign_key", "o_custkey", "count(*) = count(c_custkey)", "count(*)", "count(*) - count(c_custkey)", "orders LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal > 0"),
    "SELECT 'not_null', 'o_comment', FALSE, 0, 0",
]))
def quality_suite(spark, sf):
    # Customers in debt have a negative key here, so that their orders have no parent.
    key = F.when(F.col("c_acctbal") > 0, F.col("c_custkey")).otherwise(-F.col("c_custkey"))
    known = table(spark, sf, "customer").withColumn("c_custkey", key)
    suite = [
        q.not_null("o_orderkey"), q.unique("o_orderkey"), q.unique("o_custkey"), q.uniqueness("o_custkey", 0.5),
        q.between("o_totalprice", 1000, 300000), q.in_set("o_orderstatus", ["F", "O"]),
        q.row_count_between(1, 100_000_000_000), q.completeness("o_custkey"),
        q.foreign_key("o_custkey", known, "c_custkey"), q.not_null("o_comment"),
    ]
    return _shown(q.validate(table(spark, sf, "orders"), suite))


_PAST, _NOW = "o_orderdate < DATE '1998-01-01'", "o_orderdate >= DATE '1998-01-01'"


@query(f"""SELECT 'distribution' AS rule, 'o_totalprice' AS "column", abs(now - mean) <= sd AS success, n AS checked,
 CASE WHEN abs(now - mean) <= sd THEN 0 ELSE n END AS unexpected FROM
 (SELECT avg(o_totalprice) FILTER (WHERE {_NOW}) AS now, count(*) FILTER (WHERE {_NOW}) AS n,
 avg(o_totalprice) FILTER (WHERE {_PAST}) AS mean, stddev(o_totalprice) FILTER (WHERE {_PAST}) AS sd FROM orders) s
 UNION ALL SELECT 'volume', 'table', abs(n - p) <= 0.1 * p, n, abs(n - p) FROM
 (SELECT count(*) FILTER (WHERE {_NOW}) AS n, count(*) FILTER (WHERE {_PAST}) AS p FROM orders) t""")
def quality_history(spark, sf):
    all_orders = table(spark, sf, "orders")
    past = all_orders.filter(F.col("o_orderdate") < F.lit("1998-01-01").cast("date"))
    now = all_orders.filter(F.col("o_orderdate") >= F.lit("1998-01-01").cast("date"))
    return _shown(q.validate(now, [q.distribution("o_totalprice", past, 1.0), q.volume(past, 0.1)]))


@query("SELECT event_type AS value, count(*) AS rows FROM events WHERE event_type NOT IN ('view', 'click') GROUP BY 1")
def unexpected_values(spark, sf):
    return q.unexpected_values(table(spark, sf, "events"), q.in_set("event_type", ["view", "click"]))


@query("SELECT l_orderkey AS value, count(*) AS rows FROM lineitem GROUP BY 1 HAVING count(*) > 1")
def repeated_values(spark, sf):
    return q.unexpected_values(table(spark, sf, "lineitem"), q.unique("l_orderkey"))


def _profile_sql(source: str, columns: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) AS rows, count(*) - count({e}) AS nulls, count(DISTINCT {e}) AS distinct_values, "
        f"CAST(min({e}) AS VARCHAR) AS smallest, CAST(max({e}) AS VARCHAR) AS largest FROM {source}" for c, e in columns.items()
    )


@query(_profile_sql("lineitem", {
    "l_orderkey": "l_orderkey", "l_partkey": "l_partkey", "l_linenumber": "l_linenumber",
    "l_extendedprice": "CAST(l_extendedprice AS DECIMAL(18,2))", "l_returnflag": "l_returnflag",
    "l_shipdate": "CAST(l_shipdate AS DATE)",
}))
def profile(spark, sf):
    return q.profile(profiled_lines(spark, sf), exact=True)


def profiled_lines(spark, sf) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", F.col("l_extendedprice").cast("decimal(18,2)").alias("l_extendedprice"),
        "l_returnflag", F.col("l_shipdate").cast("date").alias("l_shipdate"),
    )


_MERGED = {"l_orderkey": "l_orderkey", "l_partkey": "l_partkey", "l_extendedprice": "CAST(l_extendedprice AS DECIMAL(18,2))",
           "l_returnflag": "l_returnflag", "l_shipdate": "CAST(l_shipdate AS DATE)"}
_NUMBERS = {"l_orderkey": "l_orderkey", "l_partkey": "l_partkey", "l_extendedprice": "l_extendedprice",
            "l_shipdate": "datediff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE))"}


@query(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) AS rows, count(*) - count({e}) AS nulls, CAST(min({e}) AS VARCHAR) AS smallest, "
    f"CAST(max({e}) AS VARCHAR) AS largest, TRUE AS distinct_near, "
    + (f"round(avg({_NUMBERS[c]}), 4) AS mean, round(stddev({_NUMBERS[c]}), 4) AS deviation, TRUE AS median_near" if c in _NUMBERS
       else "CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS deviation, CAST(NULL AS BOOLEAN) AS median_near")
    + " FROM lineitem" for c, e in _MERGED.items()
))
def profile_merged(spark, sf):
    """A profile of all lines from stored sketches per line number, in two merges; estimates are held against exact counts."""
    lines, path = profiled_lines(spark, sf), scratch_path(spark, "sketches")
    sketch(lines, ["l_linenumber"]).write.parquet(path)
    stored = spark.read.parquet(path)
    halves = merge_sketches(stored.withColumn("half", F.col("l_linenumber") % 2).drop("l_linenumber"), ["half"])
    merged = profile_of(merge_sketches(halves.drop("half")))
    exact = q.profile(lines.drop("l_linenumber"), exact=True).select("column", F.col("distinct_values").alias("exact_values"))
    medians = {r["column"]: r["quantiles"][0] for r in merged.select("column", "quantiles").collect() if r["quantiles"]}
    below = {"l_shipdate": F.datediff("l_shipdate", F.lit("1970-01-01").cast("date"))}
    shares = lines.agg(*[F.avg((below.get(c, F.col(c)) <= F.lit(m)).cast("double")).alias(c) for c, m in medians.items()])
    near = shares.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), (F.abs(F.col(c) - 0.5) < 0.05).alias("median_near")) for c in medians])))
    error = 5 * 1.04 / 2**6  # five standard errors of a sketch with 2 ** 12 cells
    return merged.join(exact, "column").join(near, "column", "left").select(
        "column", "rows", "nulls", "smallest", "largest",
        (F.abs(F.col("distinct_values") - F.col("exact_values")) <= error * F.col("exact_values") + 1).alias("distinct_near"),
        F.round("mean", 4).alias("mean"), F.round("deviation", 4).alias("deviation"), "median_near",
    )


@query("""SELECT k AS event_key, count(*) AS rows, k % 5 < 2 AS in_table FROM (SELECT event_id AS k FROM events WHERE event_id % 5 IN (1, 2)
 UNION ALL SELECT event_id FROM events WHERE event_id % 10 = 2) t GROUP BY k HAVING count(*) > 1 OR k % 5 < 2""")
def unique_increment(spark, sf):
    """A load against the keys of two earlier ones: some keys are there already, some come twice in the load."""
    ids = table(spark, sf, "events").select(F.col("event_id").alias("event_key"))
    index = KeyIndex(scratch_path(spark, "key-index"), ("event_key",), buckets=16, bits=1 << 20)
    for batch, part in enumerate((0, 1)):
        remember(ids.filter(F.col("event_key") % 5 == part), index, "events", batch)
        if batch == 0:
            fold_index(spark, index)
    load = ids.filter((F.col("event_key") % 5).isin(1, 2)).unionByName(ids.filter(F.col("event_key") % 10 == 2))
    return repeated_keys(load, index)


@query("""SELECT 'between' AS rule, 'quantity' AS "column", FALSE AS success, count(*) AS checked, count_if(l_quantity::INTEGER > 20) AS unexpected
 FROM lineitem JOIN orders ON o_orderkey = l_orderkey""")
def gate_refuses(spark, sf):
    """The gate on a load that fails: what it raises, and nothing published."""
    path = scratch_path(spark, "refused")
    try:
        run_gated(lambda: fact(spark, sf), lambda rows: rows, lambda rows: rows.write.parquet(path), [q.not_null("order_id"), q.between("quantity", 1, 20)])
    except q.QualityGateFailed as stopped:
        shown = [tuple(f[c] for c in _SHOWN) for f in stopped.failures]
        assert not path_exists(spark, path)
        return spark.createDataFrame(shown, "rule string, column string, success boolean, checked long, unexpected long")
    raise AssertionError("the gate let a bad load pass")


@query("""SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date, CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS total_revenue
 FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1""")
def gated_gold(spark, sf):
    suite = [q.not_null("order_id"), q.between("quantity", 1, 50), q.row_count_between(1, 100_000_000_000)]
    return run_gated(
        lambda: fact(spark, sf), lambda rows: rows.filter("quantity > 0"), revenue_by_day, suite,
        ready=lambda: q.require_columns(table(spark, sf, "lineitem"), ["l_orderkey", "l_quantity"]),
    )
