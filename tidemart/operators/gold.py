"""Aggregates for the gold layer, star joins and the category mart."""

from pyspark.sql import DataFrame, functions as F

from tidemart.functions.scalars import to_day


def customer_sales(silver: DataFrame) -> DataFrame:
    """Orders with an id and revenue per customer."""
    return silver.groupBy("customer_id").agg(
        F.count("order_id").alias("total_orders"), F.sum("amount").alias("total_revenue")
    )


def daily_sales(silver: DataFrame) -> DataFrame:
    """Row count and revenue per day and payment method, in that order."""
    return (
        silver.groupBy(to_day("order_timestamp").alias("order_date"), "payment_method")
        .agg(F.count(F.lit(1)).alias("total_orders"), F.sum("gross_amount").alias("total_revenue"))
        .orderBy("order_date", "payment_method")
    )


def daily_revenue(silver: DataFrame) -> DataFrame:
    """Revenue per day and payment method."""
    return silver.groupBy(to_day("order_timestamp").alias("order_date"), "payment_method").agg(
        F.sum("gross_amount").alias("total_revenue")
    )


def star_orders(fact: DataFrame, dates: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Each fact row with its date, customer name and product name.

    No broadcast hint: Spark broadcasts a dimension that is small enough and shuffles a large one,
    splitting hot keys.
    """
    return (
        fact.join(dates.select("date_key", "full_date"), "date_key")
        .join(customers.select("customer_key", "full_name"), "customer_key")
        .join(products.select("product_key", "product_name"), "product_key")
        .select("order_id", "full_date", "full_name", "product_name", "quantity", "gross_amount")
    )


def mart_daily_category_sales(fact: DataFrame, dates: DataFrame, products: DataFrame) -> DataFrame:
    """Quantity and revenue per date and category, ordered. Facts are summed per date key and category before they meet the dates."""
    per_key = (
        fact.join(products.select("product_key", "category"), "product_key")
        .groupBy("date_key", "category")
        .agg(F.sum("quantity").alias("_qty"), F.sum("gross_amount").alias("_revenue"))
    )
    return (
        per_key.join(dates.select("date_key", "full_date"), "date_key")
        .groupBy("full_date", "category")
        .agg(F.sum("_qty").alias("total_qty"), F.sum("_revenue").alias("total_revenue"))
        .orderBy(F.asc_nulls_last("full_date"), F.asc_nulls_last("category"))
    )


def revenue_by_day(fact: DataFrame) -> DataFrame:
    return fact.groupBy("order_date").agg(F.sum("revenue").alias("total_revenue"))


def revenue_by_customer(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Quantity and revenue per customer, largest revenue first.

    Facts point at any version of a customer, so they are summed per version, then per business
    key, and shown under the current version's name. The fact table is reduced before it is joined.
    """
    per_version = fact.groupBy("customer_key").agg(
        F.sum("quantity").alias("_quantity"), F.sum("revenue").alias("_revenue")
    )
    per_customer = (
        per_version.join(customers.select("customer_key", "customer_id"), "customer_key")
        .groupBy("customer_id")
        .agg(F.sum("_quantity").alias("total_quantity"), F.sum("_revenue").alias("total_revenue"))
    )
    current = customers.filter("is_current").select("customer_id", "customer_name")
    return per_customer.join(current, "customer_id").orderBy(F.desc_nulls_first("total_revenue"), "customer_id")
