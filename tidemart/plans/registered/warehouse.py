"""Star schema over the order tables: joins, mart, dashboard queries and dimension history."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemart.functions.scalars import date_key, with_defaults
from tidemart.operators import dimensions as d, gold
from tidemart.operators.marts import Mart, fold_mart, read_mart, update_mart
from tidemart.plans.registered.base import query, table
from tidemart.plans.warehouse import build_mart, load_dimension
from tidemart.sources.scratch import scratch_path
from tidemart.sources.tables import publish, read_table

TRACK = d.Tracking(previous={"city": "previous_city"}, current={"city": "current_city"})


def fact(spark, sf) -> DataFrame:
    """One row per order line; dates and customers come from the order."""
    o, l = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    return o.join(l, o.o_orderkey == l.l_orderkey).select(
        F.col("o_orderkey").alias("order_id"),
        date_key("o_orderdate").alias("date_key"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_custkey").alias("customer_key"),
        F.col("l_partkey").alias("product_key"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("gross_amount"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("revenue"),
    )


def products(spark, sf) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("product_key"), F.col("p_name").alias("product_name"), F.col("p_type").alias("category")
    )


def dates(spark, sf) -> DataFrame:
    return d.date_dim_of(table(spark, sf, "orders"), "o_orderdate")


@query("""SELECT CAST(strftime(day, '%Y%m%d') AS BIGINT) AS date_key, CAST(CAST(day AS DATE) AS VARCHAR) AS full_date,
 year(day) AS year, quarter(day) AS quarter, month(day) AS month, monthname(day) AS month_name, day(day) AS day
 FROM (SELECT unnest(range(lo, hi + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS day
 FROM (SELECT min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders) b) t""")
def date_dim(spark, sf):
    return dates(spark, sf)


@query("""SELECT o_orderkey AS order_id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS full_date, c_name AS full_name,
 p_name AS product_name, CAST(l_quantity AS BIGINT) AS quantity, l_extendedprice AS gross_amount FROM lineitem
 JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN part ON p_partkey = l_partkey""")
def star_orders(spark, sf):
    people = table(spark, sf, "customer").select(F.col("c_custkey").alias("customer_key"), F.col("c_name").alias("full_name"))
    return gold.star_orders(fact(spark, sf), dates(spark, sf), people, products(spark, sf))


@query("""SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS full_date, p_type AS category,
 CAST(SUM(CAST(l_quantity AS INTEGER)) AS BIGINT) AS total_qty, CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS total_revenue
 FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey GROUP BY 1, 2 ORDER BY 1, 2""")
def mart_daily_category(spark, sf):
    return gold.mart_daily_category_sales(fact(spark, sf), dates(spark, sf), products(spark, sf))


@query("""SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS full_date, p_type AS category,
 CAST(SUM(CAST(l_quantity AS INTEGER)) AS BIGINT) AS total_qty, CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS total_revenue
 FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey GROUP BY 1, 2 ORDER BY 1, 2""")
def mart_table(spark, sf):
    """The mart as a stored table."""
    return build_mart(fact(spark, sf), dates(spark, sf), products(spark, sf), scratch_path(spark, "mart"))


@query("""SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date, CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS total_revenue
 FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1""")
def revenue_by_day(spark, sf):
    return gold.revenue_by_day(fact(spark, sf))


# --- customers whose "city" is the priority they order with -------------------------------------


def customer_dim(spark, sf) -> DataFrame:
    """One open version per customer, with the priority of the first order as city."""
    first = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("customer_id")).agg(
        F.min(F.struct("o_orderdate", "o_orderkey", "o_orderpriority")).alias("f")
    )
    base = first.join(table(spark, sf, "customer"), F.col("customer_id") == F.col("c_custkey")).select(
        "customer_id",
        F.col("c_name").alias("full_name"),
        F.col("f.o_orderpriority").alias("city"),
        F.col("c_mktsegment").alias("segment"),
        F.col("f.o_orderdate").cast("date").alias("effective_date"),
        F.lit(None).cast("date").alias("end_date"),
        F.lit(None).cast("string").alias("previous_city"),
        F.col("f.o_orderpriority").alias("current_city"),
    )
    return d.assign_keys(with_defaults(base, {"current_flag": True}), ["customer_id"], "customer_key")


def moves(spark, sf) -> DataFrame:
    """Every customer's last order, as a change of city from that day on."""
    last = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("customer_id")).agg(
        F.max(F.struct("o_orderdate", "o_orderkey", "o_orderpriority")).alias("m")
    )
    return last.select(
        "customer_id", F.col("m.o_orderpriority").alias("city"), F.col("m.o_orderdate").cast("date").alias("effective_date")
    )


_DIM = """dim AS (SELECT ROW_NUMBER() OVER (ORDER BY c_custkey) AS customer_key, c_custkey AS customer_id, c_name AS full_name,
 p AS city, c_mktsegment AS segment, CAST(o_orderdate AS DATE) AS effective_date, CAST(NULL AS DATE) AS end_date,
 TRUE AS current_flag, CAST(NULL AS VARCHAR) AS previous_city, p AS current_city FROM customer JOIN
 (SELECT o_custkey, o_orderdate, o_orderpriority AS p, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n
 FROM orders) f ON o_custkey = c_custkey AND n = 1),
 moves AS (SELECT o_custkey AS customer_id, o_orderpriority AS new_city, CAST(o_orderdate AS DATE) AS moved FROM
 (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders) l WHERE n = 1),
 paired AS (SELECT dim.*, new_city, moved, new_city <> city AS changed FROM dim JOIN moves USING (customer_id)),
 opened AS (SELECT (SELECT max(customer_key) FROM dim) + ROW_NUMBER() OVER (ORDER BY customer_id) AS customer_key, customer_id,
 full_name, new_city AS city, segment, moved AS effective_date, CAST(NULL AS DATE) AS end_date, TRUE AS current_flag,
 city AS previous_city, new_city AS current_city FROM paired WHERE changed)"""
_OUT = """customer_key, customer_id, full_name, city, segment, CAST(effective_date AS VARCHAR) AS effective_date,
 CAST(end_date AS VARCHAR) AS end_date, current_flag, previous_city, current_city"""


@query(f"WITH {_DIM} SELECT {_OUT} FROM dim")
def surrogate_keys(spark, sf):
    return customer_dim(spark, sf)


@query(f"""WITH {_DIM} SELECT {_OUT.replace('city, segment', 'new_city AS city, segment').replace('current_city', 'new_city AS current_city')} FROM paired""")
def scd1(spark, sf):
    return d.scd1(customer_dim(spark, sf), moves(spark, sf), ["city"], TRACK)


_CLOSED = """SELECT customer_key, customer_id, full_name, city, segment, effective_date,
 CASE WHEN changed THEN CAST(moved - INTERVAL 1 DAY AS DATE) END AS end_date, NOT changed AS current_flag, previous_city, {current}
 FROM paired"""


@query(f"WITH {_DIM} SELECT {_OUT} FROM ({_CLOSED.format(current='current_city')} UNION ALL SELECT * FROM opened) v")
def scd2(spark, sf):
    return d.scd2(customer_dim(spark, sf), moves(spark, sf), ["city"], TRACK)


@query(f"WITH {_DIM} SELECT {_OUT} FROM ({_CLOSED.format(current='new_city AS current_city')} UNION ALL SELECT * FROM opened) v ORDER BY customer_id, effective_date")
def scd6(spark, sf):
    return d.dim_history(d.scd6(customer_dim(spark, sf), moves(spark, sf), ["city"], TRACK), TRACK)


@query(f"WITH {_DIM} SELECT {_OUT} FROM ({_CLOSED.format(current='current_city')} UNION ALL SELECT * FROM opened) v")
def dimension_load(spark, sf):
    """The same load into a stored dimension, whose next version is published."""
    path = scratch_path(spark, "dimension")
    publish(customer_dim(spark, sf), path)
    load_dimension(spark, path, moves(spark, sf), ["city"], TRACK, 2)
    return read_table(spark, path)


def all_moves(spark, sf) -> DataFrame:
    """Every order of a customer as a change of city: many changes per key in one load, several on one day."""
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("customer_id"), F.col("o_orderpriority").alias("city"),
        F.col("o_orderdate").cast("date").alias("effective_date"),
    )


_ALL_VERSIONS = f"""{_DIM}, days AS (SELECT o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS moved, max(o_orderpriority) AS p FROM orders GROUP BY 1, 2),
 steps AS (SELECT customer_id, effective_date AS moved, city AS p, 0 AS n FROM dim
  UNION ALL SELECT customer_id, days.moved, days.p, 1 FROM days SEMI JOIN dim USING (customer_id)),
 told AS (SELECT * FROM (SELECT *, lag(p) OVER (PARTITION BY customer_id ORDER BY moved, n) AS before FROM steps) WHERE n = 0 OR p <> before),
 spans AS (SELECT *, lead(moved) OVER k AS next, last_value(p) OVER (PARTITION BY customer_id ORDER BY moved, n
  ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS newest FROM told WINDOW k AS (PARTITION BY customer_id ORDER BY moved, n)),
 versions AS (SELECT CASE WHEN n = 0 THEN dim.customer_key ELSE (SELECT max(customer_key) FROM dim) + row_number() OVER
  (PARTITION BY n ORDER BY customer_id, moved) END AS customer_key, customer_id, full_name, p AS city, segment, moved AS effective_date,
  CAST(next - INTERVAL 1 DAY AS DATE) AS end_date, next IS NULL AS current_flag, CASE WHEN n = 1 THEN before END AS previous_city,
  {{current}} AS current_city FROM spans JOIN dim USING (customer_id))"""


@query(f"WITH {_ALL_VERSIONS.format(current='p')} SELECT {_OUT} FROM versions")
def scd2_all_changes(spark, sf):
    return d.scd2(customer_dim(spark, sf), all_moves(spark, sf), ["city"], TRACK)


@query(f"WITH {_ALL_VERSIONS.format(current='newest')} SELECT {_OUT} FROM versions")
def scd6_all_changes(spark, sf):
    return d.scd6(customer_dim(spark, sf), all_moves(spark, sf), ["city"], TRACK)


@query(f"""WITH {_DIM} SELECT customer_id, new_city AS city, CAST(CAST(moved - INTERVAL 400 DAY AS DATE) AS VARCHAR) AS effective_date,
 'before the open version' AS reason FROM paired WHERE CAST(moved - INTERVAL 400 DAY AS DATE) < effective_date""")
def scd2_refused(spark, sf):
    early = moves(spark, sf).withColumn("effective_date", F.date_sub("effective_date", 400))
    return d.refused_changes(customer_dim(spark, sf), early, ["city"], TRACK)


@query("""SELECT c_custkey AS customer_id, c_name AS customer_name, CAST(SUM(CAST(l_quantity AS INTEGER)) AS BIGINT) AS total_quantity,
 CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS total_revenue FROM lineitem JOIN orders ON o_orderkey = l_orderkey
 JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2 ORDER BY total_revenue DESC""")
def revenue_by_customer(spark, sf):
    people = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("customer_key"), F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"), F.lit(True).alias("is_current"),
    )
    return gold.revenue_by_customer(fact(spark, sf), people)


# --- days with orders of a customer, told out of order ---------------------------------------------


def told_days(spark, sf) -> DataFrame:
    """A city per customer and day with orders, numbered by day in `n` of `days`."""
    days = table(spark, sf, "orders").groupBy(
        F.col("o_custkey").alias("customer_id"), F.col("o_orderdate").cast("date").alias("effective_date")
    ).agg(F.max("o_orderpriority").alias("city"))
    of = Window.partitionBy("customer_id")
    return days.select("*", F.row_number().over(of.orderBy("effective_date")).alias("n"), F.count(F.lit(1)).over(of).alias("days"))


def opening_dim(spark, sf, days: DataFrame) -> DataFrame:
    """Customers as of their second day, or the only one."""
    base = days.filter(F.col("n") == F.least(F.lit(2), "days")).join(
        table(spark, sf, "customer"), F.col("customer_id") == F.col("c_custkey")
    ).select(
        "customer_id", F.col("c_name").alias("full_name"), "city", F.col("c_mktsegment").alias("segment"), "effective_date",
        F.lit(None).cast("date").alias("end_date"), F.lit(None).cast("string").alias("previous_city"), F.col("city").alias("current_city"),
    )
    return d.assign_keys(with_defaults(base, {"current_flag": True}), ["customer_id"], "customer_key")


_TOLD = """days AS (SELECT o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS day, max(o_orderpriority) AS p FROM orders
 SEMI JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2),
 placed AS (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY day) AS n, count(*) OVER (PARTITION BY customer_id) AS cnt FROM days),
 early AS (SELECT *, n = least(2, cnt) AS base, lag(p) OVER (PARTITION BY customer_id ORDER BY day) AS before FROM placed
  WHERE n = least(2, cnt) OR (n > 2 AND n % 2 = 0)),
 first_load AS (SELECT customer_id, day, p, row_number() OVER (ORDER BY NOT base, customer_id, day) AS key FROM early WHERE base OR p <> before),
 every AS (SELECT customer_id, day, p, key FROM first_load UNION ALL
  SELECT customer_id, day, p, NULL FROM placed WHERE (n = 1 AND cnt > 1) OR (n > 2 AND n % 2 = 1)),
 marked AS (SELECT *, lag(p) OVER (PARTITION BY customer_id ORDER BY day) IS DISTINCT FROM p AS opens FROM every),
 numbered AS (SELECT *, sum(CASE WHEN opens THEN 1 ELSE 0 END) OVER (PARTITION BY customer_id ORDER BY day) AS run FROM marked),
 runs AS (SELECT customer_id, run, min(day) AS start, any_value(p) AS p, max(key) AS key FROM numbered GROUP BY 1, 2),
 versions AS (SELECT coalesce(key, (SELECT max(key) FROM first_load) + row_number() OVER (PARTITION BY key IS NULL ORDER BY customer_id, start))
   AS customer_key, customer_id, c_name AS full_name, p AS city, c_mktsegment AS segment, start AS effective_date,
   CAST(lead(start) OVER w - INTERVAL 1 DAY AS DATE) AS end_date, lead(start) OVER w IS NULL AS current_flag,
   lag(p) OVER w AS previous_city, {current} AS current_city
  FROM runs JOIN customer ON c_custkey = customer_id WINDOW w AS (PARTITION BY customer_id ORDER BY start))"""


def _backdated(spark, sf, kind: int) -> DataFrame:
    """Even days in one load, then odd days, which lie before, between and after what is there."""
    path, days = scratch_path(spark, "backdated"), told_days(spark, sf)
    publish(opening_dim(spark, sf, days), path)
    n = F.col("n")
    load_dimension(spark, path, days.filter((n > 2) & (n % 2 == 0)), ["city"], TRACK, kind)
    odd = days.filter(((n == 1) & (F.col("days") > 1)) | ((n > 2) & (n % 2 == 1)))
    return load_dimension(spark, path, odd, ["city"], TRACK, kind, backdated=True)


@query(f"WITH {_TOLD.format(current='p')} SELECT {_OUT} FROM versions")
def scd2_backdated(spark, sf):
    return _backdated(spark, sf, 2)


@query(f"WITH {_TOLD.format(current='last_value(p) OVER (PARTITION BY customer_id ORDER BY start ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)')} SELECT {_OUT} FROM versions")
def scd6_backdated(spark, sf):
    return _backdated(spark, sf, 6)


# --- a mart kept up from changes of order lines ------------------------------------------------------


def line_loads(spark, sf) -> list[DataFrame]:
    """Three loads of changes of order lines: new lines; more lines and updates; deletes."""
    rows = fact(spark, sf).select("order_id", "date_key", "product_key", "quantity", "gross_amount")
    order = F.col("order_id")
    first, updated, deleted = order % 3 < 2, (order % 3 < 2) & (order % 5 == 0), order % 7 == 0
    later = F.struct(
        order.alias("order_id"), "date_key", F.when(F.col("product_key") > 1, F.col("product_key") - 1).otherwise(F.col("product_key")).cast("long").alias("product_key"),
        F.when(F.col("quantity") > 10, F.col("quantity") + 1).alias("quantity"), (F.col("gross_amount") + 1).cast("decimal(12,2)").alias("gross_amount"),
    )
    now = F.struct(order.alias("order_id"), "date_key", F.col("product_key").cast("long").alias("product_key"), "quantity", "gross_amount")

    def load(where: Column, before: Column | None, after: Column | None) -> DataFrame:
        none = F.lit(None).cast(rows.select(now.alias("x")).schema["x"].dataType)
        return rows.filter(where).select((none if before is None else before).alias("before"), (none if after is None else after).alias("after"))

    return [
        load(first, None, now),
        load(~first, None, now).unionByName(load(updated, now, later)),
        load(deleted, F.when(updated, later).otherwise(now), None),
    ]


@query("""SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS full_date, p_type AS category, CAST(SUM(q) AS BIGINT) AS total_qty,
 CAST(SUM(g) AS DOUBLE) AS total_revenue, count(*) AS lines, count(q) AS counted, round(avg(q), 6) AS avg_qty
 FROM (SELECT *, o_orderkey % 3 < 2 AND o_orderkey % 5 = 0 AS upd,
  CASE WHEN upd THEN CASE WHEN l_quantity::INTEGER > 10 THEN l_quantity::INTEGER + 1 END ELSE l_quantity::INTEGER END AS q,
  CAST(l_extendedprice AS DECIMAL(12,2)) + CASE WHEN upd THEN 1 ELSE 0 END AS g,
  CASE WHEN upd AND l_partkey > 1 THEN l_partkey - 1 ELSE l_partkey END AS part_now
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderkey % 7 <> 0) x
 JOIN part ON p_partkey = part_now GROUP BY 1, 2""")
def mart_incremental(spark, sf):
    """Daily sales per category after three loads of changes, one of them sent twice; the lines are never read again."""
    mart = Mart(scratch_path(spark, "mart"), ("full_date", "category"), {
        "total_qty": ("sum", "quantity"), "total_revenue": ("sum", "gross_amount"), "lines": ("rows", None),
        "counted": ("count", "quantity"), "avg_qty": ("avg", "quantity"),
    })
    calendar, parts = dates(spark, sf).select("date_key", "full_date"), products(spark, sf).select("product_key", "category")
    shape = lambda deltas: deltas.join(parts, "product_key").join(calendar, "date_key")
    for number, load in enumerate(line_loads(spark, sf)):
        for _ in range(2 if number == 1 else 1):
            update_mart(load, mart, shape, ["date_key", "product_key"], "lines", number)
        if number == 1:
            fold_mart(spark, mart)
    return read_mart(spark, mart).withColumn("avg_qty", F.round("avg_qty", 6))
