"""File layout: partition, split, compact and cluster."""

import json
import math
import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemart.operators.ordered import GROUP_ROWS, ranks, spread_ties
from tidemart.sources.readers import stored_bytes
from tidemart.sources.scratch import materialise
from tidemart.sources.store import Store

#: Files of this size are large enough to scan well and small enough to spread over tasks.
TARGET_BYTES = 512 * 1024 * 1024


def write_files(df: DataFrame, path: str, files: int) -> DataFrame:
    """Spread the rows evenly over `files` files."""
    df.repartition(files).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_count(total_bytes: int, target_bytes: int = TARGET_BYTES) -> int:
    return max(1, math.ceil(total_bytes / target_bytes))


def compact(
    spark: SparkSession, source: str, target: str, files: int | None = None, target_bytes: int = TARGET_BYTES
) -> DataFrame:
    """Rewrite many small files as few large ones; without `files`, as many as the bytes need.

    The rows are shuffled, so that reading the many stays parallel.
    """
    count = files or file_count(stored_bytes(spark, source)[0], target_bytes)
    df = spark.read.parquet(source)
    df.repartition(count).write.mode("overwrite").parquet(target)
    return spark.read.schema(df.schema).parquet(target)


def cluster(
    df: DataFrame,
    cols: Sequence[str],
    path: str,
    files: int | None = None,
    max_rows_per_file: int = 0,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Files that each hold one range of `cols`, sorted by them; without `files`, Spark sizes the ranges by their bytes.

    One frequent value fills several files instead of one task.
    """
    rows, ties = spread_ties(df, cols, group_rows)
    ranges = [F.col(c) for c in cols] + ties
    placed = rows.repartitionByRange(files, *ranges) if files else rows.repartitionByRange(*ranges)
    placed = placed.sortWithinPartitions(*cols)
    writer = placed.select(*df.columns).write.mode("overwrite")
    if max_rows_per_file:
        writer = writer.option("maxRecordsPerFile", max_rows_per_file)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# --- several columns at once ---------------------------------------------------------------------

#: Bits of a column's place in the curve: 2 ** BITS ranges of equally many rows.
BITS = 12
RANGES = "_ranges"


def z_value(places: Sequence[Column], bits: int = BITS) -> Column:
    """The place on a Z curve: the bits of all columns' places in turn, so that near on the curve is near in every column."""
    parts = [
        F.shiftleft(F.shiftright(place, bit).bitwiseAND(F.lit(1)).cast("long"), bit * len(places) + at)
        for at, place in enumerate(places) for bit in range(bits)
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), parts)


def cluster_together(
    df: DataFrame, cols: Sequence[str], path: str, files: int | None = None, bits: int = BITS, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """Files that are narrow in every one of `cols`, so that a filter on any of them opens a part of the files.

    A column counts by the rank of its values, whatever their type and however uneven they are; NULLs are together. One frequent
    combination fills several files. What range of each column a file holds is stored next to the files, for `read_ranges`.
    """
    if len(cols) * bits > 62:
        raise ValueError("too many bits for the columns")
    spark, kept = df.sparkSession, df.columns
    rows = materialise(df, "unclustered")
    total = max(1, rows.count())
    for i, c in enumerate(cols):
        ranked = ranks(rows, c, f"_rank{i}")
        place = F.floor((F.col(f"_rank{i}") - 1) * F.lit(2**bits) / F.lit(total)).cast("long")
        rows = materialise(ranked.withColumn(f"_rank{i}", place), "ranked")
    rows = rows.withColumn("_z", z_value([F.col(f"_rank{i}") for i in range(len(cols))], bits))
    rows, ties = spread_ties(rows, ["_z"], group_rows)
    order = [F.col("_z"), *ties]
    placed = rows.repartitionByRange(files, *order) if files else rows.repartitionByRange(*order)
    placed.sortWithinPartitions("_z").select(*kept).write.mode("overwrite").parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    ends = [e for i, c in enumerate(cols) for e in (F.min(c).alias(f"low{i}"), F.max(c).alias(f"high{i}"), F.count_if(F.col(c).isNull()).alias(f"nulls{i}"))]
    per_file = written.groupBy(F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file")).agg(*ends)
    names = [F.lit(c).alias(f"column{i}") for i, c in enumerate(cols)]
    per_file.select("*", *names).coalesce(1).write.mode("overwrite").parquet(f"{path}/{RANGES}")
    return written


def read_ranges(spark: SparkSession, path: str, wanted: Mapping[str, tuple], schema=None) -> DataFrame:
    """Rows of a folder from `cluster_together` with every named column between two values, both included.

    Only files whose ranges overlap are opened.
    """
    ranges = spark.read.parquet(f"{path}/{RANGES}")
    known = [c for c in ranges.columns if c.startswith("column")]
    first = ranges.select(*known).first()
    at = {first[c]: c[len("column"):] for c in known} if first else {}
    fit, rows = F.lit(True), F.lit(True)
    for c, (low, high) in wanted.items():
        rows = rows & F.col(f"`{c}`").between(low, high)
        if c in at:
            fit = fit & (F.col(f"low{at[c]}") <= F.lit(high)) & (F.col(f"high{at[c]}") >= F.lit(low))
    files = [f"{path}/{r['file']}" for r in ranges.where(fit).select("file").collect()]  # a name per file
    schema = schema or spark.read.parquet(path).schema
    return spark.read.schema(schema).parquet(*files).where(rows) if files else spark.createDataFrame([], schema)


# --- small files only ----------------------------------------------------------------------------

LIVE = "_live"
#: Groups of files that one job rewrites.
JOB_GROUPS = 200


def bins(sizes: Sequence[tuple[str, int]], target: int) -> list[list[str]]:
    """Names in groups of at most `target` bytes: the largest first, each into the fullest group that it still fits in."""
    groups: list[tuple[int, list[str]]] = []
    for name, size in sorted(sizes, key=lambda s: (-s[1], s[0])):
        room = [g for g in range(len(groups)) if groups[g][0] + size <= target]
        if room:
            best = max(room, key=lambda g: groups[g][0])
            groups[best] = (groups[best][0] + size, [*groups[best][1], name])
        else:
            groups.append((size, [name]))
    return [names for _, names in groups]


def live_files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """The data files of a folder that count, with their bytes, relative to it: those of the last compaction and those added since."""
    store = Store(spark, path)
    found = {_below(path, name): size for name, size in store.files(path)}
    for stage in store.names(f"{path}/{LIVE}"):
        if not stage.endswith(".json"):
            found |= {f"{LIVE}/{stage}/{_below(f'{path}/{LIVE}/{stage}', n)}": s for n, s in store.files(f"{path}/{LIVE}/{stage}")}
    notes = [n for n in store.names(f"{path}/{LIVE}") if n.endswith(".json") and not n.startswith(".")]
    if not notes:
        return sorted((n, s) for n, s in found.items() if not n.startswith(f"{LIVE}/"))
    told = json.loads(store.read(f"{path}/{LIVE}/{notes[-1]}"))
    added = set(told["added"])
    return sorted((n, s) for n, s in found.items() if n in added or not n.startswith(f"{LIVE}/") and n not in told["gone"])


def _below(path: str, name: str) -> str:
    return name.rpartition(f"/{path.rstrip('/').rpartition('/')[2]}/")[2]


def read_live(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """The rows of a folder whose small files may have been packed."""
    files = [f"{path}/{name}" for name, _ in live_files(spark, path)]
    return (spark.read.schema(schema) if schema is not None else spark.read).parquet(*files)


def pack_small_files(spark: SparkSession, path: str, target_bytes: int = TARGET_BYTES, small: float = 0.75) -> list[list[str]]:
    """Put the small files of a folder together, up to `target_bytes`, without a shuffle; the groups that were rewritten.

    Files of at least `small` times the target are left alone. Small ones are packed by their bytes, and each group is read and
    written by one task. New files and the note that they count lie below `_live`, which plain readers skip: nothing is
    overwritten or removed while it is read. `read_live` follows the note; files added later count as well. Groups of one file
    are not rewritten. A folder without partitions; pack each partition by itself.
    """
    store = Store(spark, path)
    files = live_files(spark, path)
    groups = [g for g in bins([(n, s) for n, s in files if s < small * target_bytes], target_bytes) if len(g) > 1]
    if not groups:
        return []
    schema = spark.read.parquet(f"{path}/{files[0][0]}").schema
    stage = f"{LIVE}/{uuid.uuid4().hex}"
    for i in range(0, len(groups), JOB_GROUPS):
        parts = [spark.read.schema(schema).parquet(*[f"{path}/{n}" for n in g]).coalesce(1) for g in groups[i:i + JOB_GROUPS]]
        reduce(DataFrame.union, parts).write.mode("append").parquet(f"{path}/{stage}")
    notes = [n for n in store.names(f"{path}/{LIVE}") if n.endswith(".json") and not n.startswith(".")]
    told = json.loads(store.read(f"{path}/{LIVE}/{notes[-1]}")) if notes else {"added": [], "gone": []}
    packed = {n for g in groups for n in g}
    new = [f"{stage}/{_below(f'{path}/{stage}', n)}" for n, _ in store.files(f"{path}/{stage}")]
    store.create(f"{path}/{LIVE}/{len(notes) + 1:020d}.json", json.dumps({
        "added": sorted(({*told["added"]} - packed) | {*new}), "gone": sorted({*told["gone"]} | {n for n in packed if not n.startswith(LIVE)}),
    }))
    return groups
