"""Event-time aggregation, its sink, and message-log bookkeeping."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery


def windowed_orders(
    events: DataFrame,
    key: str = "customer_id",
    amount: str = "amount",
    time: str = "event_time",
    window: str = "5 minutes",
    lateness: str = "5 minutes",
    once: Sequence[str] = (),
) -> DataFrame:
    """Orders and amount per tumbling window and customer; events later than `lateness` are dropped.

    `once` names the columns that tell a message: one that the source delivers again counts once. A repeat carries the time of the first,
    so it is either within the watermark, where the first is still known, or too late to count; the state holds no message longer.
    """
    timed = events.withWatermark(time, lateness)
    if once:
        timed = timed.dropDuplicatesWithinWatermark(list(once))
    return (
        timed
        .groupBy(F.window(time, window), key)
        .agg(F.count(F.lit(1)).alias("total_orders"), F.sum(amount).alias("total_amount"))
    )


def write_stream_parquet(
    df: DataFrame,
    path: str,
    checkpoint: str,
    every: str | None = None,
    partition_by: tuple[str, ...] = (),
) -> StreamingQuery:
    """Append finished rows to Parquet. The checkpoint lets a restart go on without loss or repeats.

    With `every` ("5 minutes") the query keeps running; without it, it takes in what is there,
    stops, and the next start goes on from the checkpoint.
    """
    writer = df.writeStream.format("parquet").outputMode("append")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.start()


def order_within_partition(messages: DataFrame) -> DataFrame:
    """Messages of each topic partition in offset order.

    A range sort, so that one busy partition is sorted by many tasks; an offset occurs once in its partition. No order
    between partitions is implied.
    """
    return messages.orderBy("topic", "partition", "offset")


def lag(offsets: DataFrame, ends: DataFrame) -> DataFrame:
    """Messages not yet read per topic partition: log end minus current offset.

    A partition without a committed offset lags by its whole log.
    """
    current = offsets.select("topic", "partition", "current_offset")
    return ends.select("topic", "partition", "log_end_offset").join(current, ["topic", "partition"], "left").withColumn(
        "lag", F.col("log_end_offset") - F.coalesce("current_offset", F.lit(0))
    )
