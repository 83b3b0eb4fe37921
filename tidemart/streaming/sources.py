"""Stream readers and message parsing."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

REJECT = "_reject"


def read_kafka(
    spark: SparkSession, servers: str, topic: str, starting: str = "earliest", options: Mapping[str, str] | None = None
) -> DataFrame:
    """A Kafka topic as a stream of messages. Needs Spark's Kafka package on the classpath."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    return reader.options(**(options or {})).load()


def read_event_files(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Landed text files as a stream of messages in `value`; new files are picked up as they appear."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path)


def read_parquet_stream(spark: SparkSession, path: str, schema: StructType, max_files: int | None = None) -> DataFrame:
    """Landed Parquet files as a stream, oldest first."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def parse_json(
    df: DataFrame, schema: StructType, col: str = "value", event_time: str | None = "event_time", rejects: bool = False
) -> DataFrame:
    """JSON text to typed columns, `event_time` parsed from ISO text.

    A message that does not parse becomes a row of NULLs; with `rejects` its text is kept in
    `_reject`, so that `rejected` and `accepted` can part the two.
    """
    wanted = StructType([*schema, StructField(REJECT, StringType())]) if rejects else schema
    options = {"columnNameOfCorruptRecord": REJECT} if rejects else {}
    data = F.from_json(F.col(col).cast("string"), wanted, options)
    # As a generator the message is parsed once; a later filter on its columns would parse it again.
    parsed = df.select(F.inline(F.array(data)))
    if event_time and event_time in schema.fieldNames():
        parsed = parsed.withColumn(event_time, F.try_to_timestamp(F.col(event_time)))
    return parsed


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col(REJECT).isNull()).drop(REJECT)


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col(REJECT).isNotNull()).select(F.col(REJECT).alias("value"))


def event_time(col: Column | str) -> Column:
    """A timestamp that a watermark accepts, from a timestamp with or without zone."""
    return (F.col(col) if isinstance(col, str) else col).cast("timestamp")
