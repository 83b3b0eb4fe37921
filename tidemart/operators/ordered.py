"""Order-dependent work that survives a hot key.

A plain window puts all rows of a key in one task. That is the best plan while every key is small,
so it stays the default; keys that an exact count finds to be large take another route: their rows are
range-sorted over many tasks ("pieces"), each piece is solved alone, and what earlier pieces carry
over is added. How the few carried rows are joined is left to Spark, which knows their size; few literal keys are broadcast.
"""

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemart.sources.scratch import materialise

#: A key with more rows than this is not handed to a single task.
GROUP_ROWS = 4_000_000

_INDEX_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def large_keys(df: DataFrame, keys: Sequence[str], group_rows: int = GROUP_ROWS) -> DataFrame:
    """The keys with more than `group_rows` rows, and their `_rows`: an exact count, reduced in every task."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return settled(counts.filter(F.col("_rows") > group_rows), "large-keys")


#: So many rows of a small result are kept on the driver; a larger one is written.
FEW_ROWS = 1000


def settled(df: DataFrame, label: str) -> DataFrame:
    """`df` computed once: as literal rows where there are at most `FEW_ROWS`, else written.

    Spark does not know the size of literal rows. The hint sends them to every task, so that a join with few large keys leaves the
    rows of these keys where they are.
    """
    found = df.limit(FEW_ROWS + 1).collect()
    if len(found) > FEW_ROWS:
        return materialise(df, label)
    return F.broadcast(df.sparkSession.createDataFrame(found, df.schema))


def by_heat(
    df: DataFrame,
    keys: Sequence[str],
    plain: Callable[[DataFrame], DataFrame],
    split: Callable[[DataFrame, int], DataFrame],
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """`plain` for ordinary keys, `split` for large ones, results together. Any number of keys can be large.

    Rows find their route by a join with the table of large keys. `split` also gets the number of pieces its rows need.
    """
    large = large_keys(df, keys, group_rows)
    rows = large.agg(F.sum("_rows")).first()[0]
    if rows is None:
        return plain(df)
    usual = plain(null_safe_join(df, large.drop("_rows"), keys, "left_anti"))
    hot = null_safe_join(df, large.drop("_rows"), keys, "left_semi")
    return usual.unionByName(
        split(hot, piece_count(df, rows, group_rows)).select(*[F.col(f.name).cast(f.dataType) for f in usual.schema])
    )


#: A piece may hold so many rows even where keys are split from fewer on: each piece is a task, which has to be worth its start.
PIECE_ROWS = 500_000


def piece_count(df: DataFrame, rows: int, group_rows: int = GROUP_ROWS) -> int:
    """Pieces of at most about `group_rows` rows, or `PIECE_ROWS` if that is more, and no fewer than keep all tasks busy."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / max(group_rows, PIECE_ROWS)))


def sorted_pieces(df: DataFrame, order: Sequence[Column], pieces: int | None = None) -> DataFrame:
    """Rows in global order as `_piece` (range) and `_at` (position in it), written once.

    A hash of the row settles ties. Exact copies stay in one piece: see `stamped`.
    """
    count = pieces or piece_count(df, 0)
    full = [*order, F.xxhash64(*df.columns)]
    number = F.monotonically_increasing_id()
    placed = df.repartitionByRange(count, *full).sortWithinPartitions(*full).withColumn("_n", number)
    return materialise(
        placed.select(
            *df.columns,
            F.shiftright("_n", _INDEX_BITS).cast("int").alias("_piece"),
            F.col("_n").bitwiseAND(F.lit((1 << _INDEX_BITS) - 1)).alias("_at"),
        ),
        "pieces",
    )


def stamped(df: DataFrame) -> DataFrame:
    """`df` written once with a number per row in `_stamp`, which tells exact copies apart.

    The number must not change between attempts of a later sort, so it is stored, not computed.
    """
    return materialise(df.withColumn("_stamp", F.monotonically_increasing_id()), "stamped")


def spread_ties(df: DataFrame, cols: Sequence[str], group_rows: int = GROUP_ROWS) -> tuple[DataFrame, list[Column]]:
    """`df` and the extra sort columns that let a range sort by `cols` cut through a large group of ties.

    There are none unless some value of `cols` is large.
    """
    if large_keys(df, cols, group_rows).isEmpty():
        return df, []
    return stamped(df), [F.col("_stamp")]


def piece_offsets(pieced: DataFrame, **totals: Column) -> DataFrame:
    """Per piece, the running total of each aggregate over all earlier pieces. One row per piece."""
    before = Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    per_piece = pieced.groupBy("_piece").agg(*[total.alias(name) for name, total in totals.items()])
    return per_piece.select(
        "_piece", *[F.coalesce(F.sum(name).over(before), F.lit(0)).alias(name) for name in totals]
    )


def global_positions(
    df: DataFrame, order: Sequence[Column], name: str = "_row", pieces: int | None = None
) -> DataFrame:
    """Dense positions 1, 2, 3 ... in global order, without a single-task window."""
    pieced = sorted_pieces(df, order, pieces)
    offsets = piece_offsets(pieced, _before=F.count(F.lit(1)))
    return pieced.join(offsets, "_piece").select(
        *df.columns, (F.col("_before") + F.col("_at") + 1).alias(name)
    )


def row_numbers(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """`row_number` per key."""

    def plain(part: DataFrame) -> DataFrame:
        return part.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))

    def split(part: DataFrame, pieces: int) -> DataFrame:
        pieced = sorted_pieces(stamped(part), [*[F.col(k) for k in keys], *order, F.col("_stamp")], pieces)
        # Joined by piece and key: by key alone, all rows of a key would meet in one task.
        earlier = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
        starts = (
            pieced.groupBy("_piece", *keys)
            .agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_part"))
            .select("_piece", *keys, "_first", F.coalesce(F.sum("_part").over(earlier), F.lit(0)).alias("_carry"))
        )
        return null_safe_join(pieced, starts, ["_piece", *keys]).withColumn(
            name, F.col("_carry") + F.col("_at") - F.col("_first") + 1
        ).drop("_piece", "_at", "_first", "_carry", "_stamp")

    return by_heat(df, keys, plain, split, group_rows)


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys where NULL equals NULL, keeping the left key columns."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = F.lit(True)
    for k in keys:
        condition = condition & left[k].eqNullSafe(renamed[f"_r_{k}"])
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def running_sum(
    df: DataFrame, keys: Sequence[str], order: str, value: str, name: str, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """Sum of `value` per key up to and including the row's `order` value, NULLs last; ties share one total."""
    upwards = F.col(order).asc_nulls_last()

    def plain(part: DataFrame) -> DataFrame:
        return part.withColumn(name, F.sum(value).over(Window.partitionBy(*keys).orderBy(upwards)))

    def split(part: DataFrame, pieces: int) -> DataFrame:
        ties = [*keys, order]
        totals = part.groupBy(*ties).agg(F.sum(value).alias("_sum"))
        pieced = sorted_pieces(totals, [*[F.col(c) for c in keys], upwards], pieces)
        inside = Window.partitionBy("_piece", *keys).orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
        earlier = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
        carried = (
            pieced.groupBy("_piece", *keys)
            .agg(F.sum("_sum").alias("_part"))
            .select("_piece", *keys, F.sum("_part").over(earlier).alias("_carry"))
        )
        local = pieced.withColumn("_local", F.sum("_sum").over(inside))
        # NULL plus something is that something; both NULL stays NULL, as in a window sum.
        total = F.when(F.col("_carry").isNull(), F.col("_local")).otherwise(
            F.col("_carry") + F.coalesce(F.col("_local"), F.lit(0))
        )
        upto = null_safe_join(local, carried, ["_piece", *keys]).select(*ties, total.alias(name))
        return null_safe_join(part, upto, ties)

    return by_heat(df, keys, plain, split, group_rows)


def group_total(
    df: DataFrame, keys: Sequence[str], value: str, name: str, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """Sum of `value` per key on every row."""

    def plain(part: DataFrame) -> DataFrame:
        return part.withColumn(name, F.sum(value).over(Window.partitionBy(*keys)))

    def split(part: DataFrame, _: int) -> DataFrame:
        totals = part.groupBy(*keys).agg(F.sum(value).alias(name))
        return null_safe_join(part, totals, keys)

    return by_heat(df, keys, plain, split, group_rows)


def ranks(
    df: DataFrame, value: str, rank: str = "rank", dense_rank: str | None = None, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """`rank` and `dense_rank` over all rows by `value` descending, NULLs first.

    Up to `group_rows` rows are one window. More are ranked by their distinct values, range-sorted over many tasks: how many rows
    and how many values come before each. `df` is read more than once, so pass a table or a materialised result.
    """
    names = [rank] + ([dense_rank] if dense_rank else [])
    if df.count() <= group_rows:
        down = Window.orderBy(F.col(value).desc_nulls_first())
        return df.withColumns(dict(zip(names, (F.rank().over(down).cast("long"), F.dense_rank().over(down).cast("long")))))
    values = df.groupBy(value).agg(F.count(F.lit(1)).alias("_rows"))
    pieced = sorted_pieces(values, [F.col(value).desc_nulls_first()])
    inside = Window.partitionBy("_piece").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    offsets = piece_offsets(pieced, _rows_before=F.sum("_rows"), _values_before=F.count(F.lit(1)))
    placed = pieced.withColumn("_inside", F.coalesce(F.sum("_rows").over(inside), F.lit(0))).join(
        offsets, "_piece"
    )
    numbers = [F.col("_rows_before") + F.col("_inside") + 1, F.col("_values_before") + F.col("_at") + 1]
    ranked = placed.select(value, *[n.alias(name) for n, name in zip(numbers, names)])
    return null_safe_join(df, ranked, [value])


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the largest `order` per key; full ties fall to the largest remaining columns.

    An aggregate, not a window: each task first reduces its own rows to one per key.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = F.max(F.struct(*order, *rest)).alias("_best")
    return df.groupBy(*keys).agg(best).select(
        *[F.col(c) if c in keys else F.col("_best")[c].alias(c) for c in df.columns]
    )
