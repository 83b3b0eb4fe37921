"""Small text and column helpers shared by the operators of this subpackage."""

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (
    ArrayType, BooleanType, DataType, DoubleType, LongType, StringType, StructField, StructType,
)

#: Words between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(col: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(col, UPPER, UPPER.lower())


def free_name(df: DataFrame, name: str) -> str:
    """`name`, with underscores in front until no column of `df` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


#: Rows that go to Python at a time. Texts are long, so Spark's usual 10,000 would be a large part of a worker's memory.
BATCH_ROWS = 1000


def in_small_batches(df: DataFrame) -> DataFrame:
    """`df`, with the session set to send at most `BATCH_ROWS` rows to Python at a time."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= BATCH_ROWS:
        conf.set(name, str(BATCH_ROWS))
    return df


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, whatever else `df` carries."""
    return df.select(*(F.col(f"`{n}`") for n in names))


LONG, DOUBLE, STRING, BOOLEAN = LongType(), DoubleType(), StringType(), BooleanType()


def struct(**fields: DataType) -> StructType:
    """A struct type, which unlike a DDL string needs no running session."""
    return StructType([StructField(name, kind) for name, kind in fields.items()])


def array(kind: DataType) -> ArrayType:
    return ArrayType(kind)
