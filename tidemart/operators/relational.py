"""Filters, joins, aggregates, subqueries and window queries over orders and customers.

Column names are parameters with the defaults `customer_id`, `order_id`, `order_date`, `amount`.
"""

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from tidemart.functions.scalars import days_before, lenient
from tidemart.operators.ordered import (
    GROUP_ROWS, group_total, large_keys, ranks, row_numbers, running_sum, spread_ties,
)
from tidemart.sources.scratch import materialise

# --- filters and projections -------------------------------------------------------------------


def filter_gt(df: DataFrame, col: str, value) -> DataFrame:
    return df.filter(F.col(col) > value)


def filter_eq(df: DataFrame, **values) -> DataFrame:
    """Rows equal to every given value."""
    for name, value in values.items():
        df = df.filter(F.col(name) == F.lit(value))
    return df


def recent(df: DataFrame, date_col: str, days: int, as_of: date | str | Column | None = None) -> DataFrame:
    """Rows from `days` days before `as_of` on, that day included."""
    return df.filter(F.col(date_col) >= days_before(as_of, days))


def keep_castable(df: DataFrame, col: str, type_name: str) -> DataFrame:
    return df.filter(lenient(col, type_name).isNotNull())


def grep_lines(lines: DataFrame, text: str) -> DataFrame:
    """Lines that contain `text` anywhere."""
    return lines.filter(F.col("value").contains(text))


def parse_delimited(lines: DataFrame, names: Sequence[str], sep: str = ",", col: str = "value") -> DataFrame:
    """Delimited text in `col` to string columns; a missing trailing field is NULL."""
    parts = F.split(F.col(col), f"\\Q{sep}\\E", -1)
    others = [c for c in lines.columns if c != col]
    return lines.select(*others, *[F.get(parts, F.lit(i)).alias(name) for i, name in enumerate(names)])


def project_fields(lines: DataFrame, fields: Sequence[int], header: str | None = None, sep: str = ",") -> DataFrame:
    """The given 1-based fields of each line joined by a space, without the header line."""
    body = lines if header is None else lines.filter(F.col("value") != header)
    parts = F.split(F.col("value"), f"\\Q{sep}\\E", -1)
    picked = [F.coalesce(F.get(parts, F.lit(i - 1)), F.lit("")) for i in fields]
    return body.select(F.concat_ws(" ", *picked).alias("value"))


def order_desc(df: DataFrame, col: str, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Descending with NULLs first. Rows of one frequent value are sorted by several tasks."""
    rows, ties = spread_ties(df, [col], group_rows)
    return rows.orderBy(F.col(col).desc_nulls_first(), *ties).select(*df.columns)


def order_asc(df: DataFrame, *cols: str, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Ascending with NULLs last. Rows of one frequent value are sorted by several tasks."""
    rows, ties = spread_ties(df, cols, group_rows)
    return rows.orderBy(*[F.col(c).asc_nulls_last() for c in cols], *ties).select(*df.columns)


# --- joins -------------------------------------------------------------------------------------


def _joined(customers: DataFrame, orders: DataFrame, how: str, key: str, fk: str) -> DataFrame:
    return customers.join(orders, customers[key] == orders[fk], how)


def customers_with_orders(customers: DataFrame, orders: DataFrame, key: str = "id", fk: str = "customer_id") -> DataFrame:
    return _joined(customers, orders, "inner", key, fk)


def _outer(
    customers: DataFrame, orders: DataFrame, key: str, fk: str, keep_orders: bool, group_rows: int
) -> DataFrame:
    """Outer join that keeps all customers, and with `keep_orders` all orders too.

    Spark splits a hot key only on the preserved side of a one-sided outer join and not at all in a
    full one. Large keys therefore go through an inner join (either side can be split) plus the
    unmatched rows, found against the distinct keys of the other side.
    """
    if customers.schema[key].dataType != orders.schema[fk].dataType:
        # Keys are routed before they are joined, so equal keys must have one type.
        raise TypeError(f"cast {key} and {fk} to one type before an outer join")
    how = "full" if keep_orders else "left"
    keys = orders.select(F.col(fk).alias("_k"), F.lit(0).alias("_side"))
    if keep_orders:  # one count of both sides' keys
        keys = keys.union(customers.select(F.col(key), F.lit(1)))
    large = large_keys(keys, ["_k", "_side"], group_rows).select("_k").distinct()
    if large.isEmpty():
        return _joined(customers, orders, how, key, fk)

    def part(rows: DataFrame, col: str, kind: str) -> DataFrame:
        return rows.join(large, rows[col].eqNullSafe(large["_k"]), kind)

    usual = _joined(part(customers, key, "left_anti"), part(orders, fk, "left_anti"), how, key, fk)
    hot_c, hot_o = part(customers, key, "left_semi"), part(orders, fk, "left_semi")

    def unmatched(rows: DataFrame, col: str, others: DataFrame, other_col: str) -> DataFrame:
        seen = others.select(F.col(other_col).alias("_seen")).distinct()
        return rows.join(seen, rows[col] == seen["_seen"], "left_anti")

    def nulls(of: DataFrame) -> list[Column]:
        return [F.lit(None).cast(f.dataType).alias(f.name) for f in of.schema]

    result = usual.union(_joined(hot_c, hot_o, "inner", key, fk)).union(
        unmatched(hot_c, key, hot_o, fk).select("*", *nulls(orders))
    )
    if keep_orders:
        result = result.union(unmatched(hot_o, fk, hot_c, key).select(*nulls(customers), "*"))
    return result


def all_customers(
    customers: DataFrame, orders: DataFrame, key: str = "id", fk: str = "customer_id", group_rows: int = GROUP_ROWS
) -> DataFrame:
    """Every customer, with NULL order columns where there is no order."""
    return _outer(customers, orders, key, fk, False, group_rows)


def orders_right_customers(
    orders: DataFrame, customers: DataFrame, key: str = "id", fk: str = "customer_id", group_rows: int = GROUP_ROWS
) -> DataFrame:
    """Right join that preserves the customers: the rows of `all_customers`, order columns first."""
    rows = _outer(customers, orders, key, fk, False, group_rows)
    width = len(customers.columns)
    names = [*[f"c{i}" for i in range(width)], *[f"o{i}" for i in range(len(orders.columns))]]
    flipped = rows.toDF(*names).select(*names[width:], *names[:width])
    return flipped.toDF(*orders.columns, *customers.columns)


def customers_full_orders(
    customers: DataFrame, orders: DataFrame, key: str = "id", fk: str = "customer_id", group_rows: int = GROUP_ROWS
) -> DataFrame:
    return _outer(customers, orders, key, fk, True, group_rows)


def recent_orders_by_customer(
    customers: DataFrame,
    orders: DataFrame,
    as_of: date | str | None = None,
    days: int = 30,
    key: str = "id",
    fk: str = "customer_id",
    date_col: str = "order_date",
) -> DataFrame:
    return _joined(customers, recent(orders, date_col, days, as_of), "inner", key, fk)


def orphans(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent."""
    keys = parent.select(F.col(pk).alias("_pk"))
    return child.filter(F.col(fk).isNotNull()).join(keys, F.col(fk) == F.col("_pk"), "left_anti")


# --- aggregates --------------------------------------------------------------------------------


def revenue_per_customer(
    orders: DataFrame, customer: str = "customer_id", amount: str = "amount", name: str = "total_revenue"
) -> DataFrame:
    return orders.groupBy(customer).agg(F.sum(amount).alias(name))


def above_average_customers(
    orders: DataFrame, customer: str = "customer_id", amount: str = "amount", name: str = "total_amount"
) -> DataFrame:
    """Customers whose total exceeds the mean of all customer totals."""
    totals = revenue_per_customer(orders, customer, amount, name)
    return orders.sparkSession.sql(
        f"SELECT * FROM {{totals}} WHERE {name} > (SELECT avg({name}) FROM {{totals}})", totals=totals
    )


# --- windows -----------------------------------------------------------------------------------


def running_total(
    orders: DataFrame,
    customer: str = "customer_id",
    date_col: str = "order_date",
    amount: str = "amount",
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Running total per customer by date; orders of one date share a total."""
    return running_sum(orders, [customer], date_col, amount, "running_total", group_rows)


def order_sequence(
    orders: DataFrame,
    customer: str = "customer_id",
    date_col: str = "order_date",
    order_id: str = "order_id",
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """1, 2, 3 ... per customer by date, ties by order id."""
    order = [F.col(date_col).asc_nulls_last(), F.col(order_id).asc_nulls_last()]
    return row_numbers(orders, [customer], order, "order_sequence", group_rows)


def customer_rank(
    orders: DataFrame, customer: str = "customer_id", amount: str = "amount", group_rows: int = GROUP_ROWS
) -> DataFrame:
    """Customers ranked by total amount, with and without gaps."""
    totals = materialise(revenue_per_customer(orders, customer, amount, "total_amount"), "totals")
    return ranks(totals, "total_amount", "customer_rank", "customer_dense_rank", group_rows)


def ranked_customers(
    orders: DataFrame, customer: str = "customer_id", amount: str = "amount", group_rows: int = GROUP_ROWS
) -> DataFrame:
    """Revenue per customer, then its rank."""
    return ranks(
        materialise(revenue_per_customer(orders, customer, amount), "revenue"), "total_revenue", "rank", group_rows=group_rows
    )


def with_customer_total(
    orders: DataFrame, customer: str = "customer_id", amount: str = "amount", group_rows: int = GROUP_ROWS
) -> DataFrame:
    return group_total(orders, [customer], amount, "total_customer_amount", group_rows)
