"""Filters, joins, subqueries and windows over orders and customers."""

from pyspark.sql import functions as F

from tidemart.operators import relational as r
from tidemart.operators.ordered import ranks
from tidemart.plans.registered.base import customers, orders, query, table
from tidemart.sources.scratch import materialise

# Fixed value: the day the recent-orders queries look back from.
AS_OF = "2001-08-01"
DAYS = 365


@query("SELECT order_id, customer_id, CAST(order_date AS VARCHAR) AS order_date, CAST(amount AS DOUBLE) AS amount, status FROM {orders} WHERE amount > 100000")
def filter_amount(spark, sf):
    return r.filter_gt(orders(spark, sf), "amount", 100000)


@query("SELECT order_id, CAST(amount AS DOUBLE) AS amount FROM {orders} WHERE status = 'F'")
def filter_status(spark, sf):
    return r.filter_eq(orders(spark, sf), status="F").select("order_id", "amount")


@query("SELECT id, name FROM {customers}")
def choose_columns(spark, sf):
    return customers(spark, sf)


@query(f"SELECT order_id, customer_id, CAST(order_date AS VARCHAR) AS order_date, CAST(amount AS DOUBLE) AS amount, status FROM {{orders}} WHERE order_date >= DATE '{AS_OF}' - INTERVAL {DAYS} DAY")
def recent_orders(spark, sf):
    return r.recent(orders(spark, sf), "order_date", DAYS, AS_OF)


@query("SELECT order_id, CAST(order_date AS VARCHAR) AS order_date FROM {orders} ORDER BY order_date DESC NULLS FIRST")
def order_desc(spark, sf):
    return r.order_desc(orders(spark, sf).select("order_id", "order_date"), "order_date")


@query("SELECT status, order_id FROM {orders} ORDER BY status NULLS LAST, order_id NULLS LAST")
def order_by_columns(spark, sf):
    return r.order_asc(orders(spark, sf).select("status", "order_id"), "status", "order_id")


# Orders in state P have no customer here, so that both sides of a join have rows without a partner.
_PLACED = "(SELECT order_id, CASE WHEN status <> 'P' THEN customer_id END AS customer_id, amount FROM {orders} o0)"


def _placed(spark, sf):
    return orders(spark, sf).withColumn("customer_id", F.when(F.col("status") != "P", F.col("customer_id")))


_RECENT = f"(SELECT * FROM {{orders}} WHERE order_date >= DATE '{AS_OF}' - INTERVAL {DAYS} DAY)"
_COLS = "c.id, c.name, o.order_id, CAST(o.amount AS DOUBLE) AS amount"


@query(f"SELECT {_COLS} FROM {{customers}} c JOIN {_PLACED} o ON c.id = o.customer_id")
def join_inner(spark, sf):
    return r.customers_with_orders(customers(spark, sf), _placed(spark, sf)).select("id", "name", "order_id", "amount")


@query(f"SELECT {_COLS} FROM {{customers}} c LEFT JOIN {_PLACED} o ON c.id = o.customer_id")
def join_left(spark, sf):
    return r.all_customers(customers(spark, sf), _placed(spark, sf)).select("id", "name", "order_id", "amount")


@query(f"SELECT {_COLS} FROM {_PLACED} o RIGHT JOIN {{customers}} c ON c.id = o.customer_id")
def join_right(spark, sf):
    return r.orders_right_customers(_placed(spark, sf), customers(spark, sf)).select("id", "name", "order_id", "amount")


@query(f"SELECT {_COLS} FROM {{customers}} c FULL JOIN {_PLACED} o ON c.id = o.customer_id")
def join_full(spark, sf):
    return r.customers_full_orders(customers(spark, sf), _placed(spark, sf)).select("id", "name", "order_id", "amount")


@query(f"WITH recent_orders AS {_RECENT} SELECT c.name, o.order_id, CAST(o.amount AS DOUBLE) AS amount, CAST(o.order_date AS VARCHAR) AS order_date FROM {{customers}} c JOIN recent_orders o ON c.id = o.customer_id")
def recent_orders_by_customer(spark, sf):
    joined = r.recent_orders_by_customer(customers(spark, sf), orders(spark, sf), AS_OF, DAYS)
    return joined.select("name", "order_id", "amount", "order_date")


@query("SELECT customer_id, CAST(SUM(amount) AS DOUBLE) AS total_revenue FROM {orders} GROUP BY customer_id")
def revenue_per_customer(spark, sf):
    return r.revenue_per_customer(orders(spark, sf))


@query(
    "SELECT customer_id, CAST(SUM(amount) AS DOUBLE) AS total_amount FROM {orders} GROUP BY customer_id "
    "HAVING SUM(amount) > (SELECT AVG(t) FROM (SELECT SUM(amount) AS t FROM {orders} GROUP BY customer_id) s)"
)
def above_average(spark, sf):
    return r.above_average_customers(orders(spark, sf))


@query(
    "WITH revenue AS (SELECT customer_id, SUM(amount) AS total_revenue FROM {orders} GROUP BY customer_id) "
    "SELECT customer_id, CAST(total_revenue AS DOUBLE) AS total_revenue, RANK() OVER (ORDER BY total_revenue DESC) AS rank FROM revenue"
)
def ranked_customers(spark, sf):
    return r.ranked_customers(orders(spark, sf))


@query(
    "SELECT customer_id, CAST(SUM(amount) AS DOUBLE) AS total_amount, RANK() OVER (ORDER BY SUM(amount) DESC) AS customer_rank, "
    "DENSE_RANK() OVER (ORDER BY SUM(amount) DESC) AS customer_dense_rank FROM {orders} GROUP BY customer_id"
)
def customer_rank(spark, sf):
    return r.customer_rank(orders(spark, sf))


# Rows of a key from which the `_hot` queries split it: few, so that small tables take that route too.
SPLIT_ROWS = 100


@query(
    "SELECT part, quantity, RANK() OVER (ORDER BY quantity DESC) AS rank, DENSE_RANK() OVER (ORDER BY quantity DESC) AS dense_rank "
    "FROM (SELECT l_partkey AS part, CAST(SUM(l_quantity) AS BIGINT) AS quantity FROM lineitem GROUP BY l_partkey) t"
)
def rank_with_ties(spark, sf):
    sold = table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("part")).agg(
        F.sum("l_quantity").cast("long").alias("quantity")
    )
    return ranks(materialise(sold, "sold"), "quantity", "rank", "dense_rank", SPLIT_ROWS)


@query(
    "SELECT order_id, customer_id, CAST(SUM(amount) OVER (PARTITION BY customer_id ORDER BY order_date) AS DOUBLE) AS running_total FROM {orders}"
)
def running_total(spark, sf):
    return r.running_total(orders(spark, sf)).select("order_id", "customer_id", "running_total")


@query(
    "SELECT order_id, customer_id, ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY order_date, order_id) AS order_sequence FROM {orders}"
)
def order_sequence(spark, sf):
    return r.order_sequence(orders(spark, sf)).select("order_id", "customer_id", "order_sequence")


@query(
    "SELECT order_id, customer_id, CAST(amount AS DOUBLE) AS amount, "
    "CAST(SUM(amount) OVER (PARTITION BY customer_id) AS DOUBLE) AS total_customer_amount FROM {orders}"
)
def customer_total(spark, sf):
    return r.with_customer_total(orders(spark, sf)).select("order_id", "customer_id", "amount", "total_customer_amount")


@query(
    "SELECT order_id, status, CAST(SUM(amount) OVER (PARTITION BY status ORDER BY order_date) AS DOUBLE) AS running_total FROM {orders}"
)
def running_total_hot(spark, sf):
    total = r.running_total(orders(spark, sf), "status", group_rows=SPLIT_ROWS)
    return total.select("order_id", "status", "running_total")


@query(
    "SELECT order_id, status, ROW_NUMBER() OVER (PARTITION BY status ORDER BY order_date, order_id) AS order_sequence FROM {orders}"
)
def order_sequence_hot(spark, sf):
    numbered = r.order_sequence(orders(spark, sf), "status", group_rows=SPLIT_ROWS)
    return numbered.select("order_id", "status", "order_sequence")


@query(
    "SELECT order_id, status, CAST(SUM(amount) OVER (PARTITION BY status) AS DOUBLE) AS total_customer_amount FROM {orders}"
)
def group_total_hot(spark, sf):
    total = r.with_customer_total(orders(spark, sf), "status", group_rows=SPLIT_ROWS)
    return total.select("order_id", "status", "total_customer_amount")


@query(f"SELECT {_COLS} FROM {{customers}} c FULL JOIN {{orders}} o ON c.id = o.customer_id")
def join_full_hot(spark, sf):
    joined = r.customers_full_orders(customers(spark, sf), orders(spark, sf), group_rows=SPLIT_ROWS // 10)
    return joined.select("id", "name", "order_id", "amount")


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey NOT IN (SELECT CASE WHEN o_orderstatus = 'F' THEN o_orderkey ELSE -o_orderkey END FROM orders)")
def orphans(spark, sf):
    """Keys of unfinished orders are negative here, so that their lines have no parent."""
    key = F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey")).otherwise(-F.col("o_orderkey"))
    parents = table(spark, sf, "orders").withColumn("o_orderkey", key)
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return r.orphans(lines, parents, "l_orderkey", "o_orderkey")


_LINE = "concat_ws(',', CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), CAST(CAST(o_orderdate AS DATE) AS VARCHAR), o_orderpriority)"


def _lines(spark, sf):
    return table(spark, sf, "orders").select(
        F.concat_ws(",", "o_orderkey", "o_custkey", F.col("o_orderdate").cast("date"), "o_orderpriority").alias("value")
    )


@query(f"SELECT line AS value FROM (SELECT {_LINE} AS line FROM orders) t WHERE contains(line, '1998')")
def lines_with_text(spark, sf):
    return r.grep_lines(_lines(spark, sf), "1998")


@query("SELECT concat_ws(' ', CAST(o_custkey AS VARCHAR), o_orderpriority) AS value FROM orders")
def line_fields(spark, sf):
    return r.project_fields(_lines(spark, sf), [2, 4])


@query("SELECT CAST(event_id AS VARCHAR) AS id, event_type AS status FROM events")
def delimited_messages(spark, sf):
    messages = table(spark, sf, "events").select(F.concat_ws(",", "event_id", "event_type").alias("value"))
    return r.parse_delimited(messages, ["id", "status"])


@query(
    "WITH by_status AS (SELECT status, customer_id, MAX(amount) AS largest FROM {orders} GROUP BY status, customer_id) "
    "SELECT c.name, s.status, CAST(s.largest AS DOUBLE) AS largest FROM {customers} c JOIN by_status s ON c.id = s.customer_id"
)
def common_table_expression(spark, sf):
    """The same text as a user would send to `spark.sql`."""
    return spark.sql(
        "WITH by_status AS (SELECT status, customer_id, MAX(amount) AS largest FROM {o} GROUP BY status, customer_id) "
        "SELECT c.name, s.status, s.largest FROM {c} c JOIN by_status s ON c.id = s.customer_id",
        o=orders(spark, sf), c=customers(spark, sf),
    )


@query("SELECT ROUND(AVG(total), 2) AS mean_total FROM (SELECT CAST(SUM(amount) AS DOUBLE) AS total FROM {orders} GROUP BY customer_id) s")
def derived_table(spark, sf):
    totals = spark.sql("SELECT customer_id, CAST(SUM(amount) AS DOUBLE) AS total FROM {o} GROUP BY customer_id", o=orders(spark, sf))
    return spark.sql("SELECT ROUND(AVG(total), 2) AS mean_total FROM (SELECT total FROM {t}) s", t=totals)
