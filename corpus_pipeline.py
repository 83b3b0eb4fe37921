"""The corpus pipeline: documents through quality rules, near-duplicate removal, decontamination, secret redaction and
mixing. Each stage reads what the one before it wrote."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemart.llm import decontam, mixing, near, quality, secrets
from tidemart.sources.scratch import materialise

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that policy `v2` accepts."""
    return quality.keep(docs, "v2")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group; five-word shingles, similarity 0.8 or more."""
    return near.deduplicate(docs, size=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontam.remove(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked."""
    return secrets.redact(docs, length_col="n_chars")


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time the mix takes a document, as a whole, with `epoch` and `words`."""
    return mixing.mixture(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret scans", secret_scans),
    ("mixing", source_mixing),
]

#: Near-duplicate search by random trees and a trained forest have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
