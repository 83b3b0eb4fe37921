"""A bounded filter for membership in a set of ids.

Rows that a small part of a table is wanted of should not be shuffled to find out which. The ids are hashed into a bitmap of at
most `MOST` bits, which is all that is sent to the tasks: a row whose bit is not set is surely not wanted. The others, the wanted
ones and a few more, are left for an exact join.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tidemart.llm.text import BOOLEAN

#: Bits per id, and the most and least bits of a bitmap.
PER_ID, MOST, LEAST = 16, 1 << 27, 1 << 15


def sieve(ids: DataFrame, col: str):
    """A function from an id column to whether the id may be among the values of `ids[col]`. NULL is never."""
    bits = LEAST
    wanted = PER_ID * ids.count()
    while bits < min(wanted, MOST):
        bits *= 2
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(bits)) + 1
    hashed = ids.where(F.col(col).isNotNull()).select(place(F.col(col)).alias("p"))
    parts = hashed.groupBy(F.bitmap_bucket_number("p").alias("k")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("part")
    )
    bitmap = np.zeros(bits // 8, np.uint8)
    for row in parts.collect():  # 4 KB each, MOST / 8 bytes together
        part = np.frombuffer(row["part"], np.uint8)
        at = (row["k"] - 1) * (LEAST // 8)
        bitmap[at:at + len(part)] = part
    shared = ids.sparkSession.sparkContext.broadcast(bitmap)

    @F.pandas_udf(BOOLEAN)
    def held(places: pd.Series) -> pd.Series:
        at = places.to_numpy() - 1
        return pd.Series((shared.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1)

    return lambda c: c.isNotNull() & held(place(c))
