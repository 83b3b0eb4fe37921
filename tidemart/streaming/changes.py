"""Continuous apply of change events."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemart.operators.changes import last_changes, newest, rows_of
from tidemart.sources.tables import add_rows, fold, read_reduced

#: Buckets of a change table. A fold rewrites a bucket as a whole, so choose as many as make a bucket some hundred MB.
BUCKETS = 8


def add_changes(events: DataFrame, path: str, key: str, source: str | None = None, batch: int | None = None, buckets: int = BUCKETS) -> None:
    """Add the newest of some change events per key, deletes included, to the table at `path`. Nothing is rewritten."""
    add_rows(last_changes(events, key), path, source, batch, ["key"], buckets)


def stream_changes(
    events: DataFrame, path: str, key: str, checkpoint: str, every: str | None = None, buckets: int = BUCKETS
) -> StreamingQuery:
    """Keep a table at `path` up to date with a stream of parsed change events.

    Each micro-batch adds its newest event per key, deletes included. The table numbers what is added
    and remembers checkpoint and batch, so a repeated batch is not added twice and a stream with a new
    checkpoint adds its events anew; log positions settle any order. Nothing is rewritten per batch;
    run `compact_changes` now and then.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        add_changes(batch, path, key, checkpoint, batch_id, buckets)

    writer = events.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def current_rows(spark: SparkSession, path: str, keys: DataFrame | None = None) -> DataFrame | None:
    """The table as of the last finished micro-batch. Only buckets with changes since the last fold are aggregated.

    With `keys`, a DataFrame with a column `key`, only their rows; buckets of other keys are not opened.
    """
    last = read_reduced(spark, path, newest, keys)
    if last is None:
        return None
    if keys is not None:
        last = last.join(keys.select("key"), "key", "left_semi")
    return rows_of(last)


def compact_changes(spark: SparkSession, path: str) -> DataFrame | None:
    """Fold the added batches into the buckets they touch. Deletes stay known, so a late repeat cannot revive a row."""
    return fold(spark, path, newest)
