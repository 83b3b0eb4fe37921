"""Batch readers and input checks."""

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType


class MissingInput(FileNotFoundError):
    """The input path holds no file."""


class InvalidHeader(ValueError):
    """A text file does not start with the agreed header line."""


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """CSV with a header. Pass `schema` for large inputs: inference costs one more pass."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_parquet(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Parquet directory; `name=value` folders come back as columns that prune on filter."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def read_bronze_text(spark: SparkSession, path: str, columns: Sequence[str], sep: str = ",") -> DataFrame:
    """Delimited text with every column a string and no header."""
    schema = StructType([StructField(name, StringType()) for name in columns])
    return spark.read.schema(schema).option("sep", sep).csv(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw text, one row per line in `value`."""
    return spark.read.text(path)


def rows(spark: SparkSession, data: Sequence, schema: StructType | str) -> DataFrame:
    """Literal rows as a table, for fixtures and small reference data."""
    return spark.createDataFrame(list(data), schema)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether `path` names at least one existing file or folder. Reads no content."""
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def require_path(spark: SparkSession, path: str) -> str:
    if not path_exists(spark, path):
        raise MissingInput(f"File not found: {path}")
    return path


def require_header(spark: SparkSession, path: str, header: str) -> str:
    """Every non-empty file under `path` must start with exactly `header`, and one must be there.

    One pass over the lines, reduced on the way to one first line per file.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"),
        "value",
    )
    firsts = lines.filter(F.col("start") == 0).groupBy("file").agg(F.min_by("value", "at").alias("first"))
    checked, other = firsts.agg(
        F.count(F.lit(1)), F.max(F.when(F.col("first") != header, F.struct("file", "first")))
    ).first()
    if other:
        raise InvalidHeader(f"Invalid schema: {other['file']} starts with {other['first']!r}")
    if not checked:
        raise InvalidHeader(f"Invalid schema: {path} is empty")
    return path


def stored_bytes(spark: SparkSession, path: str, glob: str = "*.parquet") -> tuple[int, int]:
    """Total bytes and number of files under `path`, from file listings alone."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(path)
        .agg(F.coalesce(F.sum("length"), F.lit(0)), F.count("length"))
        .first()
    )
    return files[0], files[1]
