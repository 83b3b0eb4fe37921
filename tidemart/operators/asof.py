"""Point-in-time join: for every entity row, the newest feature row not later than it."""

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemart.operators.ordered import GROUP_ROWS, by_heat, large_keys, null_safe_join, settled, sorted_pieces


@dataclass(frozen=True, eq=False)
class Lookup:
    """Feature rows with their time columns, the columns to deliver, and how long a row stays valid."""

    features: DataFrame
    columns: Sequence[str]
    ts: str = "event_timestamp"
    created: str | None = None
    ttl: timedelta | None = None


def point_in_time_join(
    entities: DataFrame,
    features: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    entity_ts: str = "event_timestamp",
    feature_ts: str = "event_timestamp",
    created: str | None = None,
    ttl: timedelta | None = None,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """All entity columns plus `columns`, NULL where no feature row applies. No entity row is lost.

    A feature row applies when its time is not after the entity's and not more than `ttl` before
    it. At one time the later `created` wins.
    """
    return point_in_time_joins(
        entities, [Lookup(features, columns, feature_ts, created, ttl)], keys, entity_ts, group_rows
    )


def point_in_time_joins(
    entities: DataFrame,
    lookups: Sequence[Lookup],
    keys: Sequence[str],
    entity_ts: str = "event_timestamp",
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Several lookups on the same keys, each as in `point_in_time_join`.

    Entities and all feature rows are laid on one timeline per key, so there is one shuffle however
    many lookups, and no row multiplication. A key with very many rows is cut into time ranges and
    the last feature rows of earlier ranges are carried over.
    """
    keys = list(keys)
    line = _asking(entities, keys, entity_ts)
    reach = _reach(entities, entity_ts)
    for i, lookup in enumerate(lookups):
        line = line.unionByName(_facts(lookup, entities, keys, reach, f"_v{i}"), allowMissingColumns=True)
    values = [f"_v{i}" for i in range(len(lookups))]

    def plain(part: DataFrame) -> DataFrame:
        return _solved(part, keys, values)

    def split(part: DataFrame, pieces: int) -> DataFrame:
        # One row per key and time, so that any number of copies or of rows at one time can be cut:
        # the values that hold at this time, and whether an entity asks for it.
        newest = [F.max(F.when(F.col(v).isNotNull(), F.struct("_made", v))).alias(v) for v in values]
        moments = part.groupBy(*keys, "_t").agg(F.max("_kind").alias("_asked"), *newest).select(
            *keys, "_t", "_asked", *[F.col(f"{v}.{v}").alias(v) for v in values]
        )
        pieced = sorted_pieces(moments, [F.col(c) for c in (*keys, "_t")], pieces)
        upto = Window.partitionBy("_piece", *keys).orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
        earlier = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
        # One row per piece and key in it: keys are few here and each spans neighbouring pieces.
        ends = [F.max_by(v, F.when(F.col(v).isNotNull(), F.col("_at"))).alias(f"_end{v}") for v in values]
        carried = pieced.groupBy("_piece", *keys).agg(*ends).select(
            "_piece", *keys, *[F.last(f"_end{v}", ignorenulls=True).over(earlier).alias(f"_carry{v}") for v in values]
        )
        local = pieced.withColumns({f"_local{v}": F.last(v, ignorenulls=True).over(upto) for v in values})
        answers = null_safe_join(local.filter("_asked = 1"), carried, ["_piece", *keys]).select(
            *keys, "_t", *[F.coalesce(f"_local{v}", f"_carry{v}").alias(f"_h{v}") for v in values]
        )
        asking = part.filter("_kind = 1").select(*keys, "_t", "_row")
        return null_safe_join(asking, answers, [*keys, "_t"]).drop(*keys, "_t")

    return _delivered(by_heat(line, keys, plain, split, group_rows), lookups, values, entity_ts)


def _asking(entities: DataFrame, keys: Sequence[str], entity_ts: str) -> DataFrame:
    """Entity rows as rows of the timeline."""
    return entities.select(
        *keys,
        F.col(entity_ts).cast("timestamp").alias("_t"),
        F.lit(1).alias("_kind"),
        F.lit(None).cast("timestamp").alias("_made"),
        F.struct(*entities.columns).alias("_row"),
    )


def _solved(line: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """For each entity row of a timeline the last feature rows before it, by one window per key."""
    # Features sort before entities of the same time; the values only settle full ties.
    order = [F.col(c) for c in ("_t", "_kind", "_made", *values)]
    upto = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    hits = {f"_h{v}": F.last(v, ignorenulls=True).over(upto) for v in values}
    return line.withColumns(hits).filter("_kind = 1").select("_row", *hits)


def _delivered(matched: DataFrame, lookups: Sequence, values: Sequence[str], entity_ts: str) -> DataFrame:
    asked = F.col(f"_row.{entity_ts}").cast("timestamp")
    delivered = []
    for lookup, v in zip(lookups, values):
        fresh = F.lit(True)
        if lookup.ttl is not None:
            limit = F.make_dt_interval(secs=F.lit(lookup.ttl.total_seconds()).cast("decimal(18,6)"))
            fresh = asked - F.col(f"_h{v}._t") <= limit
        delivered += [F.when(fresh, F.col(f"_h{v}.{c}")).alias(c) for c in lookup.columns]
    return matched.select("_row.*", *delivered)


def _reach(entities: DataFrame, entity_ts: str) -> tuple[int | None, int | None]:
    """First and last time of the entity rows in microseconds, from one pass."""
    asked = F.unix_micros(F.col(entity_ts).cast("timestamp"))
    return tuple(entities.agg(F.min(asked), F.max(asked)).first())


def _facts(
    lookup: Lookup, entities: DataFrame, keys: list[str], reach: tuple[int | None, int | None], name: str
) -> DataFrame:
    """The feature rows some entity row could use, as timeline rows with their values in `name`.

    The entities' time range reaches the scan, and a semi join, which Spark plans by size, leaves out other keys.
    """
    near = _within(lookup.features, lookup, reach).join(entities.select(*keys), keys, "left_semi")
    return _known(near.dropna(subset=keys), lookup, [F.col(k) for k in keys], name)


def _within(features: DataFrame, lookup, reach: tuple[int | None, int | None]) -> DataFrame:
    first, last = reach
    time = F.col(lookup.ts).cast("timestamp")
    near = features.filter(F.lit(False) if last is None else time <= F.timestamp_micros(F.lit(last)))
    if last is not None and lookup.ttl is not None:
        near = near.filter(time >= F.timestamp_micros(F.lit(first - lookup.ttl // timedelta(microseconds=1))))
    return near


def _known(features: DataFrame, lookup, keys: Sequence[Column], name: str) -> DataFrame:
    """Feature rows as rows of the timeline."""
    time = F.col(lookup.ts).cast("timestamp")
    made = F.col(lookup.created) if lookup.created else F.lit(None)
    return features.select(
        *keys,
        time.alias("_t"),
        F.lit(0).alias("_kind"),
        made.cast("timestamp").alias("_made"),
        F.struct(time.alias("_t"), *lookup.columns).alias(name),
    )


# --- history that stays where it is --------------------------------------------------------------


@dataclass(frozen=True)
class StoredHistory:
    """A history laid out for point-in-time joins: a table bucketed by its keys and sorted by keys and time.

    `wide` holds the rows of keys that are too large for one bucket, `hot` those keys; both are files, and None if there are none.
    """

    table: str
    keys: tuple[str, ...]
    ts: str
    created: str | None
    buckets: int
    wide: str | None = None
    hot: str | None = None

    def rows(self, spark: SparkSession) -> DataFrame:
        """All of it, as a plain DataFrame."""
        usual = spark.table(self.table)
        return usual if self.wide is None else usual.unionByName(spark.read.schema(usual.schema).parquet(self.wide))


@dataclass(frozen=True)
class StoredLookup:
    """What to deliver from a stored history, and how long a row stays valid."""

    history: StoredHistory
    columns: Sequence[str]
    ttl: timedelta | None = None

    @property
    def ts(self) -> str:
        return self.history.ts

    @property
    def created(self) -> str | None:
        return self.history.created


def store_history(
    df: DataFrame,
    table: str,
    path: str,
    keys: Sequence[str],
    ts: str = "event_timestamp",
    created: str | None = None,
    buckets: int = 64,
    group_rows: int = GROUP_ROWS,
) -> StoredHistory:
    """Lay out a history once, as table `table` with files below `path`, so that joins move entity rows only.

    Choose as many buckets as make one some hundred MB. Rows without a key can never be asked for and are left out. Keys with more than
    `group_rows` rows are laid out in ranges of key and time next to the table.
    """
    spark, keys = df.sparkSession, list(keys)
    rows = df.dropna(subset=keys)
    large = large_keys(rows, keys, group_rows).drop("_rows")
    wide = hot = None
    if not large.isEmpty():
        wide, hot = f"{path}/wide", f"{path}/hot"
        large.coalesce(1).write.parquet(hot)
        heavy = rows.join(large, keys, "left_semi")
        heavy.repartitionByRange(*keys, ts).sortWithinPartitions(*keys, ts).write.parquet(wide)
        rows = rows.join(large, keys, "left_anti")
    placed = rows.select(*df.columns).repartition(buckets, *keys)
    placed.write.bucketBy(buckets, *keys).sortBy(*keys, ts).option("path", f"{path}/buckets").saveAsTable(table)
    return StoredHistory(table, tuple(keys), ts, created, buckets, wide, hot)


def point_in_time_stored(
    entities: DataFrame,
    lookups: Sequence[StoredLookup],
    entity_ts: str = "event_timestamp",
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """As `point_in_time_joins`, on stored histories with the same keys and buckets.

    Entity rows are dealt to the histories' buckets and each bucket is solved where it lies: no history row is shuffled. Keys that
    are large in a history or among the entities take the route of `point_in_time_joins`.
    """
    layouts = {(look.history.keys, look.history.buckets) for look in lookups}
    if len(layouts) != 1:
        raise ValueError("histories that are joined together need the same keys and buckets")
    ((keys, buckets),) = layouts
    spark, keys = entities.sparkSession, list(keys)
    hot = large_keys(entities, keys, group_rows).drop("_rows")
    for path in dict.fromkeys(look.history.hot for look in lookups if look.history.hot):
        hot = hot.unionByName(spark.read.schema(hot.schema).parquet(path))
    hot = settled(hot.distinct(), "hot-keys")
    rest = None
    if not hot.isEmpty():
        rows = null_safe_join(entities, hot, keys, "left_semi")
        plain = [Lookup(look.history.rows(spark), look.columns, look.ts, look.created, look.ttl) for look in lookups]
        rest = point_in_time_joins(rows, plain, keys, entity_ts, group_rows)
        entities = null_safe_join(entities, hot, keys, "left_anti")
    values = [f"_v{i}" for i in range(len(lookups))]
    # Under other names the keys of table and entities compare as equal, which lets the union keep the buckets.
    own = [F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)]
    names = [f"_key{i}" for i in range(len(keys))]
    asking = _asking(entities, keys, entity_ts)
    line = asking.select(*own, *[c for c in asking.columns if c not in keys]).repartition(buckets, *names)
    reach = _reach(entities, entity_ts)
    asked = entities.select(*keys).distinct()
    for look, name in zip(lookups, values):
        near = _within(spark.table(look.history.table), look, reach).join(asked, keys, "left_semi")
        line = line.unionByName(_known(near, look, own, name), allowMissingColumns=True)
    found = _delivered(_solved(line, names, values), lookups, values, entity_ts)
    return found if rest is None else found.unionByName(rest)
