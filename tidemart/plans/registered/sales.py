"""Silver and gold layers over orders and their lines."""

from pyspark.sql import DataFrame, functions as F

from tidemart.functions import scalars as s
from tidemart.operators import cleaning, gold
from tidemart.operators.relational import keep_castable
from tidemart.plans.registered.base import events, query, table


def raw_orders(spark, sf, text_time: bool = False) -> DataFrame:
    """Order lines as rows of the raw file; orders without lines have no quantity."""
    o, l = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    time = F.date_format("o_orderdate", s.TIMESTAMP_PATTERN) if text_time else F.col("o_orderdate").cast("timestamp")
    return o.join(l, o.o_orderkey == l.l_orderkey, "left").select(
        F.col("o_orderkey").alias("order_id"),
        time.alias("order_timestamp"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").alias("unit_price"),
        F.concat(F.lit(" "), "o_orderstatus").alias("order_status"),
        F.concat("o_orderpriority", F.lit(" ")).alias("payment_method"),
    )


_SILVER = """(SELECT o_orderkey AS order_id, o_orderdate AS order_timestamp, CAST(l_quantity AS INTEGER) AS quantity,
 l_extendedprice AS unit_price, lower(trim(o_orderstatus)) AS order_status, lower(trim(o_orderpriority)) AS payment_method,
 CAST(l_quantity AS INTEGER) * l_extendedprice AS gross_amount FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey)"""


@query(f"""SELECT order_id, epoch_us(order_timestamp) AS order_timestamp, CAST(quantity AS BIGINT) AS quantity, unit_price,
 order_status, payment_method, gross_amount FROM {_SILVER} s""")
def silver(spark, sf):
    return cleaning.to_silver(raw_orders(spark, sf, text_time=True))


_TEXT_QUANTITY = """CASE l_linenumber WHEN 1 THEN CAST(l_quantity AS INTEGER) WHEN 2 THEN CAST(l_quantity AS INTEGER) WHEN 3 THEN 0
 WHEN 4 THEN CAST(l_quantity AS INTEGER) WHEN 5 THEN -CAST(l_quantity AS INTEGER) END"""


@query(f"""SELECT CAST(o_orderkey AS VARCHAR) AS order_id, epoch_us(o_orderdate) AS order_timestamp, CAST({_TEXT_QUANTITY} AS BIGINT) AS quantity,
 CASE WHEN l_linenumber <> 6 THEN l_extendedprice END AS unit_price, lower(trim(o_orderstatus)) AS order_status,
 lower(trim(o_orderpriority)) AS payment_method,
 {_TEXT_QUANTITY} * CASE WHEN l_linenumber <> 6 THEN l_extendedprice END AS gross_amount
 FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey""")
def silver_text(spark, sf):
    """All columns as text, with quantities like `12.`, `.5`, `12.5<tab>`, ` -12`, `1e1` and words."""
    o, l = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    n, number = F.col("l_linenumber"), F.col("l_quantity").cast("int").cast("string")
    quantity = (
        F.when(n == 1, F.concat(number, F.lit("."))).when(n == 2, F.concat(number, F.lit(".5\t"))).when(n == 3, F.lit(".5"))
        .when(n == 4, F.concat(F.lit("\t "), number)).when(n == 5, F.concat(F.lit(" -"), number)).when(n == 6, F.lit("1e1"))
        .when(n.isNotNull(), F.lit("many"))
    )
    raw = o.join(l, o.o_orderkey == l.l_orderkey, "left").select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.date_format("o_orderdate", s.TIMESTAMP_PATTERN).alias("order_timestamp"),
        quantity.alias("quantity"),
        F.when(n == 6, "free").otherwise(F.col("l_extendedprice").cast("string")).alias("unit_price"),
        F.concat(F.lit(" "), "o_orderstatus").alias("order_status"),
        F.concat("o_orderpriority", F.lit(" ")).alias("payment_method"),
    )
    return cleaning.to_silver(raw)


@query(f"""SELECT CAST(CAST(order_timestamp AS DATE) AS VARCHAR) AS order_date, payment_method, COUNT(*) AS total_orders,
 round(SUM(gross_amount), 2) AS total_revenue FROM {_SILVER} s GROUP BY 1, 2 ORDER BY 1, 2""")
def daily_sales(spark, sf):
    daily = gold.daily_sales(cleaning.to_silver(raw_orders(spark, sf)))
    return daily.withColumn("total_revenue", F.round("total_revenue", 2))


@query(f"""SELECT CAST(CAST(order_timestamp AS DATE) AS VARCHAR) AS order_date, payment_method,
 round(SUM(gross_amount), 2) AS total_revenue FROM {_SILVER} s GROUP BY 1, 2""")
def daily_revenue(spark, sf):
    daily = gold.daily_revenue(cleaning.to_silver(raw_orders(spark, sf)))
    return daily.withColumn("total_revenue", F.round("total_revenue", 2))


def bronze_events(spark, sf) -> DataFrame:
    """Events as text: errors have no readable amount, sign-ups no readable date."""
    kind = F.col("event_type")
    return events(spark, sf).select(
        F.col("event_id").cast("string").alias("order_id"),
        F.col("user_id").cast("string").alias("customer_id"),
        F.when(kind == "error", "bad_amount").otherwise(F.col("value").cast("string")).alias("amount"),
        F.when(kind == "signup", "bad_date").otherwise(F.col("ts").cast("date").cast("string")).alias("order_date"),
    )


_BRONZE_SILVER = """(SELECT CAST(event_id AS INTEGER) AS order_id, CAST(user_id AS INTEGER) AS customer_id, value AS amount,
 CASE WHEN event_type <> 'signup' THEN CAST(ts AS DATE) END AS order_date FROM events WHERE event_type <> 'error')"""


@query(f"""SELECT CAST(order_id AS BIGINT) AS order_id, CAST(customer_id AS BIGINT) AS customer_id, amount,
 CAST(order_date AS VARCHAR) AS order_date FROM {_BRONZE_SILVER} s""")
def bronze_to_silver(spark, sf):
    return cleaning.bronze_to_silver(bronze_events(spark, sf))


@query(f"""SELECT CAST(customer_id AS BIGINT) AS customer_id, COUNT(order_id) AS total_orders,
 round(SUM(amount), 2) AS total_revenue FROM {_BRONZE_SILVER} s GROUP BY 1""")
def customer_sales(spark, sf):
    sales = gold.customer_sales(cleaning.bronze_to_silver(bronze_events(spark, sf)))
    return sales.withColumn("total_revenue", F.round("total_revenue", 2))


@query("SELECT CAST(event_id AS VARCHAR) AS order_id, CAST(value AS VARCHAR) AS amount FROM events WHERE event_type <> 'error'")
def keep_readable(spark, sf):
    return keep_castable(bronze_events(spark, sf), "amount", "double").select("order_id", "amount")


def raw_accounts(spark, sf) -> DataFrame:
    """Orders with their customer's balance as amount; low-priority ones have no readable date and open ones no amount."""
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    return o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.when(F.col("o_orderpriority") == "5-LOW", "bad_date")
        .otherwise(F.col("o_orderdate").cast("date").cast("string")).alias("order_date"),
        F.when(F.col("o_orderstatus") != "O", F.col("c_acctbal").cast("string")).alias("amount"),
        F.col("o_orderstatus").alias("status"),
    )


@query("""SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date,
 c_acctbal AS amount, o_orderstatus AS status, strftime(o_orderdate, '%Y-%m') AS year_month
 FROM orders JOIN customer ON o_custkey = c_custkey
 WHERE o_orderpriority <> '5-LOW' AND o_orderstatus <> 'O' AND c_acctbal > 0""")
def clean_orders(spark, sf):
    return cleaning.clean_orders(raw_accounts(spark, sf))


@query("SELECT c_custkey, CAST(c_acctbal AS VARCHAR) AS amount FROM customer WHERE c_acctbal > 0")
def positive_amounts(spark, sf):
    text = table(spark, sf, "customer").select("c_custkey", F.col("c_acctbal").cast("string").alias("amount"))
    return cleaning.filter_field_positive(text, "amount")


@query("""SELECT user_id, event_type, event_id, epoch_us(ts) AS ts, value FROM (SELECT *, ROW_NUMBER() OVER
 (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS n FROM events) t WHERE n = 1""")
def dedup(spark, sf):
    rows = events(spark, sf).select("user_id", "event_type", "event_id", "ts", "value")
    return cleaning.dedup(rows, ["user_id", "event_type"], ["ts", "event_id"])


@query("""SELECT event_id, epoch_us(date_trunc('second', ts)) AS parsed, CAST(CAST(ts AS DATE) AS VARCHAR) AS day,
 strftime(ts, '%Y-%m') AS month, CAST(strftime(ts, '%Y%m%d') AS BIGINT) AS date_key,
 CAST(CAST(ts AS DATE) - INTERVAL 30 DAY AS DATE)::VARCHAR AS month_before,
 upper(event_type) AS loud, lower(trim('  ' || event_type)) AS quiet,
 TRY_CAST(CASE WHEN event_type = 'click' THEN 'none' ELSE CAST(user_id AS VARCHAR) END AS BIGINT) AS maybe_user,
 value + user_id AS added, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def scalar_functions(spark, sf):
    text = F.date_format("ts", s.TIMESTAMP_PATTERN)
    maybe = F.when(F.col("event_type") == "click", "none").otherwise(F.col("user_id").cast("string"))
    return events(spark, sf).select(
        "event_id",
        s.parse_ts(text, s.TIMESTAMP_PATTERN).alias("parsed"),
        s.to_day("ts").alias("day"),
        s.year_month("ts").alias("month"),
        s.date_key("ts").alias("date_key"),
        s.days_before(F.col("ts").cast("date"), 30).alias("month_before"),
        F.upper("event_type").alias("loud"),
        s.normalise(F.concat(F.lit("  "), "event_type")).alias("quiet"),
        s.lenient(maybe, "bigint").alias("maybe_user"),
        (F.col("value") + F.col("user_id")).alias("added"),
        F.from_json("props", "k long")["k"].alias("k"),
    )
