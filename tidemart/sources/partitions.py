"""Replacing single partitions of a partitioned folder, each load once."""

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, Row, SparkSession, functions as F

from tidemart.sources.store import Store

#: Where the record lies below the folder; Spark's readers skip the name.
RECORD = "_replaced"


def replaced_loads(spark: SparkSession, path: str) -> list[dict]:
    """The record: per load its `source`, `batch` and the `partitions` it has replaced, oldest first."""
    store = Store(spark, path)
    names = [n for n in store.names(f"{path}/{RECORD}") if not n.startswith(".")]
    return [json.loads(store.read(f"{path}/{RECORD}/{n}")) for n in names]


def _name(source: str, batch: int) -> str:
    """A file name for a load, so that asking whether it is in opens nothing."""
    return f"{batch:020d}-{source.encode().hex()}.json"


def replace_partitions(df: DataFrame, path: str, by: Sequence[str], source: str, batch: int) -> list[dict]:
    """Put the rows of `df` in place of the partitions that they fall into; other partitions keep their files.

    Returns the partitions replaced. A load is known by `source` and `batch`, and one that is already recorded changes nothing, whatever
    it brings. The record is written last: a load that broke off is simply repeated. A partition that `df` has no row of stays.
    One writer at a time.
    """
    spark, seen = df.sparkSession, Observation()
    store, name = Store(spark, path), _name(source, batch)
    if name in store.names(f"{path}/{RECORD}"):
        return []
    values: list[dict] = []
    if not df.isEmpty():
        # The values are gathered while the rows are written: one entry per partition.
        counted = df.observe(seen, F.collect_set(F.struct(*by)).alias("partitions"))
        placed = counted.hint("rebalance", *[F.col(c) for c in by])
        placed.write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy(*by).parquet(path)
        values = sorted((_plain(r) for r in seen.get["partitions"]), key=str)
    store.create(f"{path}/{RECORD}/{name}", json.dumps({"source": source, "batch": batch, "partitions": values}))
    return values


def _plain(row: Row) -> dict:
    return {k: v if v is None or isinstance(v, (bool, int, float, str)) else str(v) for k, v in row.asDict().items()}
