"""Change events: reading the envelope and applying it to a table."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidemart.functions.scalars import decode_decimal

# The operation codes of the change envelope.
CREATE, UPDATE, DELETE, READ = "c", "u", "d", "r"


def envelope(row: StructType) -> StructType:
    """Schema of one change message whose table rows have schema `row`."""
    source = StructType([
        StructField("connector", StringType()), StructField("db", StringType()),
        StructField("table", StringType()), StructField("lsn", LongType()),
    ])
    payload = StructType([
        StructField("before", row), StructField("after", row), StructField("source", source),
        StructField("op", StringType()), StructField("ts_ms", LongType()),
    ])
    return StructType([StructField("payload", payload)])


def parse_change_events(
    df: DataFrame, row: StructType, decimals: Mapping[str, tuple[int, int]] | None = None, col: str = "value"
) -> DataFrame:
    """JSON messages to `op, before, after, lsn, ts_ms`; messages without an operation are left out.

    `decimals` maps columns sent as base64 numbers to (precision, scale).
    """
    decimals = decimals or {}
    message = F.from_json(F.col(col).cast("string"), envelope(row))
    # As a generator the message is parsed once; a plain filter on it would parse it again.
    parsed = df.select(F.inline(F.array(message["payload"]))).filter(F.col("op").isNotNull())

    def image(name: str) -> Column:
        side = F.col(name)
        fields = [
            (decode_decimal(side[f], *decimals[f]) if f in decimals else side[f]).alias(f) for f in row.fieldNames()
        ]
        return F.when(side.isNotNull(), F.struct(*fields)).alias(name)

    return parsed.select("op", image("before"), image("after"), F.col("source.lsn").alias("lsn"), "ts_ms")


def last_changes(events: DataFrame, key: str) -> DataFrame:
    """The newest event per key by log position, deletes included: key, lsn, op, after.

    Log position, not time: two events can share a millisecond. Each task reduces its own events to
    one per key before the shuffle.
    """
    keyed = events.select(
        F.coalesce(F.col("after")[key], F.col("before")[key]).alias("key"), "lsn", "op", "after"
    )
    return newest(keyed)


def newest(keyed: DataFrame) -> DataFrame:
    best = F.max(F.struct("lsn", "op", "after")).alias("best")
    return keyed.groupBy("key").agg(best).select("key", "best.lsn", "best.op", "best.after")


def apply_changes(events: DataFrame, key: str) -> DataFrame:
    """The table after all events, whatever order they arrive in."""
    return rows_of(last_changes(events, key))


def rows_of(last: DataFrame) -> DataFrame:
    return last.filter(F.col("op") != DELETE).select("after.*")


def change_delta(events: DataFrame, col: str, name: str = "delta") -> DataFrame:
    """`after - before` of a numeric column; a missing side counts as 0."""
    zero = F.lit(0)
    return events.withColumn(
        name, F.coalesce(F.col("after")[col], zero) - F.coalesce(F.col("before")[col], zero)
    )
