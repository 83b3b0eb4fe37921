"""Uniqueness of a load against a table, without grouping the table again.

Next to the table's keys, kept in buckets, lies a bitmap of their hashes. A key of a load whose bit is not set is surely new. The others
are doubtful, and only the buckets that doubtful keys fall into are opened to decide exactly.
"""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemart.operators.ordered import null_safe_join
from tidemart.sources.tables import add_rows, fold, read_reduced, read_table

#: Bits that Spark's bitmap functions put into one value.
PER_VALUE = 32768


@dataclass(frozen=True)
class KeyIndex:
    """Where the keys of a table are kept, in how many buckets, and how many bits the bitmap has.

    With b bits and n keys a new key is doubtful with probability n / b: take 16 bits or more per key.
    """

    path: str
    keys: tuple[str, ...]
    buckets: int = 64
    bits: int = 1 << 24

    @property
    def keys_path(self) -> str:
        return f"{self.path}/keys"

    @property
    def bits_path(self) -> str:
        return f"{self.path}/bits"

    def place(self) -> Column:
        """A key's place in the bitmap, from 1."""
        return F.pmod(F.xxhash64(F.lit(1), *self.keys), F.lit(self.bits)) + 1


def _merged(rows: DataFrame) -> DataFrame:
    return rows.groupBy("value_number").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def doubtful(load: DataFrame, index: KeyIndex) -> DataFrame:
    """The distinct keys of a load whose bit is set: those that can be in the table, and few others. NULL keys never are."""
    spark = load.sparkSession
    keys = load.select(*index.keys).dropna().distinct()
    known = read_reduced(spark, index.bits_path, _merged)
    if known is None:
        return keys.limit(0)
    placed = keys.withColumn("_place", index.place()).withColumns({
        "value_number": F.bitmap_bucket_number("_place"), "_at": F.bitmap_bit_position("_place").cast("int"),
    })
    byte = F.conv(F.hex(F.expr("substring(bitmap, _at DIV 8 + 1, 1)")), 16, 10).cast("int")
    held = placed.join(known, "value_number").withColumn("_byte", byte)
    return held.where(F.expr("shiftright(_byte, _at % 8) & 1 = 1")).select(*index.keys)


def repeated_keys(load: DataFrame, index: KeyIndex) -> DataFrame:
    """Keys of a load that are not unique, exactly: `rows` of the load that have them, and whether they are `in_table`.

    The load is reduced to its keys. Of the table, only buckets with doubtful keys are read.
    """
    spark = load.sparkSession
    counted = load.select(*index.keys).dropna().groupBy(*index.keys).agg(F.count(F.lit(1)).alias("rows"))
    asked = doubtful(load, index)
    held = None if asked.isEmpty() else read_table(spark, index.keys_path, asked)
    if held is None:
        found = counted.withColumn("in_table", F.lit(False))
    else:
        in_table = held.join(asked, list(index.keys), "left_semi").distinct().withColumn("_in", F.lit(True))
        found = counted.join(in_table, list(index.keys), "left").withColumn("in_table", F.coalesce("_in", F.lit(False))).drop("_in")
    return found.where("rows > 1 OR in_table")


def new_rows(load: DataFrame, index: KeyIndex) -> DataFrame:
    """The rows of a load whose key is neither in the table nor twice in the load; rows with a NULL key among them."""
    return null_safe_join(load, repeated_keys(load, index).select(*index.keys), list(index.keys), "left_anti")


def remember(load: DataFrame, index: KeyIndex, source: str | None = None, batch: int | None = None) -> None:
    """Add the keys of a load that has become part of the table; a batch of a named source counts once. Adds, rewrites nothing."""
    keys = load.select(*index.keys).dropna().distinct()
    add_rows(keys, index.keys_path, source, batch, index.keys, index.buckets)
    placed = keys.select(index.place().alias("_place"))
    bitmaps = placed.groupBy(F.bitmap_bucket_number("_place").alias("value_number")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_place")).alias("bitmap")
    )
    add_rows(bitmaps, index.bits_path, source, batch, ["value_number"], min(index.buckets, max(1, index.bits // PER_VALUE)))


def fold_index(spark: SparkSession, index: KeyIndex) -> None:
    """Each key and each part of the bitmap once again, in the buckets that loads have touched."""
    fold(spark, index.keys_path, lambda rows: rows.distinct())
    fold(spark, index.bits_path, _merged)
