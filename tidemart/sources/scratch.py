"""Shared scratch storage for cutting lineage and for outputs that are read back."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_root: str | None = None


def scratch_root(spark: SparkSession) -> str:
    """The folder named in `spark.checkpoint.dir`; a temporary one only in local mode."""
    global _local_root
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="tidemart-")
    return _local_root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path in the scratch folder."""
    return f"{scratch_root(spark)}/tidemart/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once to scratch and read it back.

    Later steps re-read the files, so a lost executor never restarts the whole upstream plan and
    non-repeatable columns (row positions) keep one value.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
