"""Quality gate: a failed suite stops everything after it."""

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from tidemart.operators.quality import (
    QualityGateFailed, Rule, between, failures, in_set, not_null, row_count_between, unique, validate,
)
from tidemart.sources.scratch import materialise

# The statuses and limits every order load is held to.
ORDER_STATUSES = ("created", "paid", "shipped", "delivered", "cancelled")
QUANTITY = (1, 20)
UNIT_PRICE = (0, 1000)
ROW_COUNT = (1, 100000)


def orders_suite() -> list[Rule]:
    return [
        not_null("order_id"),
        unique("order_id"),
        not_null("customer_id"),
        between("quantity", *QUANTITY),
        between("unit_price", *UNIT_PRICE),
        in_set("order_status", ORDER_STATUSES),
        row_count_between(*ROW_COUNT),
    ]


def check(df: DataFrame, suite: Sequence[Rule]) -> DataFrame:
    """`df` itself when it passes the suite; raises otherwise."""
    failed = failures(validate(df, suite))
    if failed:
        raise QualityGateFailed(failed)
    return df


def run_gated(
    ingest: Callable[[], DataFrame],
    transform: Callable[[DataFrame], DataFrame],
    publish: Callable[[DataFrame], DataFrame],
    suite: Sequence[Rule],
    ready: Callable[[], object] | None = None,
) -> DataFrame:
    """Ready check, ingest, validate, transform, publish, in this order; the first error ends the run.

    `ready` raises when the input is not there yet. Nothing of silver or gold is written unless the
    ingested rows pass. What `ingest` returns is written once; validation and transform both read that.
    """
    if ready is not None:
        ready()
    return publish(transform(check(materialise(ingest(), "ingested"), suite)))
