"""Date dimension, surrogate keys and slowly changing dimensions of type 1, 2 and 6."""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemart.functions.scalars import date_parts
from tidemart.operators.ordered import global_positions, latest_per_key
from tidemart.sources.scratch import materialise


def date_dim(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per calendar day from `start` to `end`, both included."""
    days = spark.sql(f"SELECT explode(sequence(DATE'{start}', DATE'{end}')) AS day")
    return days.select(*date_parts("day"))


def date_dim_of(df: DataFrame, col: str) -> DataFrame:
    """Date dimension covering every day between the first and last date in `df`."""
    span = df.agg(F.min(F.col(col).cast("date")).alias("first"), F.max(F.col(col).cast("date")).alias("last"))
    return span.select(F.explode(F.sequence("first", "last")).alias("day")).select(*date_parts("day"))


@dataclass(frozen=True)
class Tracking:
    """Column names of a dimension with history.

    `previous` and `current` name, per tracked column, the columns that hold the value before the
    change and the newest value; leave a column out when the dimension has none.
    """

    key: str = "customer_id"
    surrogate: str = "customer_key"
    start: str = "effective_date"
    end: str = "end_date"
    flag: str = "current_flag"
    previous: Mapping[str, str] = field(default_factory=dict)
    current: Mapping[str, str] = field(default_factory=dict)


def assign_keys(df: DataFrame, order_by: Sequence[str], name: str, start: int = 1) -> DataFrame:
    """Dense integer keys from `start` in the order of `order_by`, which must identify a row."""
    placed = global_positions(df, [F.col(c) for c in order_by], "_row")
    return placed.select((F.col("_row") + (start - 1)).alias(name), *[c for c in df.columns if c != name])


def scd1(dim: DataFrame, changes: DataFrame, cols: Sequence[str], tracking: Tracking) -> DataFrame:
    """Overwrite the open row; history columns stay as they are."""
    t = tracking
    # Several changes of a key: the one with the largest values counts.
    incoming = changes.select(F.col(t.key).alias("_key"), *[F.col(c).alias(f"_new_{c}") for c in cols])
    one_each = latest_per_key(incoming, ["_key"], []).withColumn("_hit", F.lit(True))
    joined = dim.join(one_each, F.col(t.key) == F.col("_key"), "left")
    open_ = F.coalesce(F.col(t.flag), F.lit(False)) & F.coalesce(F.col("_hit"), F.lit(False))
    values: dict[str, Column] = {}
    for c in cols:
        values[c] = F.when(open_, F.col(f"_new_{c}")).otherwise(F.col(c))
        if c in t.current:
            values[t.current[c]] = F.when(open_, F.col(f"_new_{c}")).otherwise(F.col(t.current[c]))
    return joined.withColumns(values).select(*dim.columns)


def _dated(changes: DataFrame, t: Tracking, cols: Sequence[str], effective: str) -> DataFrame:
    """One change per key and date: `_key`, `_from` and `_new_<col>`. Of several on one day the largest counts."""
    incoming = changes.select(
        F.col(t.key).alias("_key"), F.col(effective).cast("date").alias("_from"), *[F.col(c).alias(f"_new_{c}") for c in cols]
    )
    return latest_per_key(incoming, ["_key", "_from"], [])


def _open_rows(dim: DataFrame, t: Tracking, cols: Sequence[str]) -> DataFrame:
    return dim.filter(F.col(t.flag)).select(
        F.col(t.key).alias("_key"), F.struct(F.col(t.start).alias("_from"), *[F.col(c).alias(f"_new_{c}") for c in cols]).alias("_open")
    )


def refused_changes(
    dim: DataFrame,
    changes: DataFrame,
    cols: Sequence[str],
    tracking: Tracking,
    effective: str = "effective_date",
    *,
    backdated: bool = False,
) -> DataFrame:
    """The changes that `scd2` and `scd6`, with the same `backdated`, do not apply, with the `reason`."""
    t = tracking
    if backdated:
        spans = dim.groupBy(F.col(t.key).alias("_key")).agg(F.max(_until(F.col(t.end))).alias("_last"))
        dated = _dated(changes, t, cols, effective).join(spans, "_key", "left")
        reason = (
            F.when(F.col("_last").isNull(), "no version").when(F.col("_from").isNull(), "no date")
            .when(F.col("_from") > F.col("_last"), "after the last version ended")
        )
        return _with_reason(dated, t, cols, effective, reason)
    dated = _dated(changes, t, cols, effective).join(_open_rows(dim, t, cols), "_key", "left")
    reason = (
        F.when(F.col("_open").isNull(), "no open version").when(F.col("_from").isNull(), "no date")
        .when(F.col("_from") < F.col("_open._from"), "before the open version")
    )
    return _with_reason(dated, t, cols, effective, reason)


def _with_reason(dated: DataFrame, t: Tracking, cols: Sequence[str], effective: str, reason: Column) -> DataFrame:
    return dated.select(
        F.col("_key").alias(t.key), F.col("_from").alias(effective), *[F.col(f"_new_{c}").alias(c) for c in cols],
        reason.alias("reason"),
    ).filter("reason IS NOT NULL")


def _until(end: Column) -> Column:
    """The last day of a version; of an open one a day after all others."""
    return F.coalesce(end, F.lit("9999-12-31").cast("date"))


def scd2(
    dim: DataFrame,
    changes: DataFrame,
    cols: Sequence[str],
    tracking: Tracking,
    effective: str = "effective_date",
    *,
    overwrite_current: bool = False,
    backdated: bool = False,
) -> DataFrame:
    """Apply every change in date order: each closes the version before it the day before and opens one with a new key.

    A change that repeats the values before it opens no version, so applying the same changes again changes
    nothing. Changes without an open version, without a date or dated before the open version are left out; see
    `refused_changes`. Facts keep the surrogate key they have. `overwrite_current` also writes the newest value to every
    version. The versions of a key in one load, at most one per day, are worked out in one row.

    With `backdated`, changes before the open version are spliced into the history, see `_spliced`.
    """
    t = tracking
    if backdated:
        return _numbered(_spliced(dim, changes, cols, t, effective, overwrite_current), dim, t)
    dated = _dated(changes, t, cols, effective).filter(F.col("_from").isNotNull())
    per_key = dated.groupBy("_key").agg(
        F.array_sort(F.collect_list(F.struct("_from", *[f"_new_{c}" for c in cols]))).alias("_changes")
    )
    kind = per_key.schema["_changes"].dataType
    first = F.array(F.col("_open")).cast(kind)

    def add(versions: Column, change: Column) -> Column:
        last = F.element_at(versions, -1)
        same = F.lit(True)
        for c in cols:
            same = same & change[f"_new_{c}"].eqNullSafe(last[f"_new_{c}"])
        return F.when(same, versions).otherwise(F.concat(versions, F.array(change)))

    later = F.filter("_changes", lambda x: x["_from"] >= F.element_at(first, 1)["_from"])
    versions = per_key.join(_open_rows(dim, t, cols), "_key").select("_key", F.aggregate(later, first, add).alias("_v"))
    joined = dim.join(versions, F.col(t.key) == F.col("_key"), "left")
    spread = F.coalesce(F.col(t.flag), F.lit(False)) & F.col("_v").isNotNull()
    steps = F.when(spread, F.sequence(F.lit(0), F.size("_v") - 1)).otherwise(F.array(F.lit(0)))
    rows = joined.select("*", spread.alias("_spread"), F.explode(steps).alias("_i"))

    added = F.col("_i") > 0
    this, before, after, last = F.get("_v", F.col("_i")), F.get("_v", F.col("_i") - 1), F.get("_v", F.col("_i") + 1), F.element_at("_v", -1)
    closed = F.col("_spread") & after.isNotNull()
    values = {
        t.surrogate: F.when(~added, F.col(t.surrogate)),
        t.start: F.when(added, this["_from"]).otherwise(F.col(t.start)),
        t.end: F.when(closed, F.date_sub(after["_from"], 1)).when(~added, F.col(t.end)),
        t.flag: F.when(closed, F.lit(False)).when(added, F.lit(True)).otherwise(F.col(t.flag)),
    }
    for c in cols:
        values[c] = F.when(added, this[f"_new_{c}"]).otherwise(F.col(c))
        if c in t.previous:
            values[t.previous[c]] = F.when(added, before[f"_new_{c}"]).otherwise(F.col(t.previous[c]))
        if c in t.current and overwrite_current:
            values[t.current[c]] = F.when(F.col("_v").isNotNull(), last[f"_new_{c}"]).otherwise(F.col(t.current[c]))
        elif c in t.current:
            values[t.current[c]] = F.when(added, this[f"_new_{c}"]).otherwise(F.col(t.current[c]))
    rows = rows.select(*[values.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in dim.schema], added.alias("_added"))
    return _numbered(rows, dim, t)


def _numbered(rows: DataFrame, dim: DataFrame, t: Tracking) -> DataFrame:
    """New versions (`_added`) get surrogate keys after those there are, by key and start."""
    rows = materialise(rows, "versions")
    newest = rows.agg(F.coalesce(F.max(t.surrogate), F.lit(0))).first()[0]
    opened = assign_keys(rows.filter("_added").select(dim.columns), [t.key, t.start], t.surrogate, int(newest) + 1)
    typed = opened.select(*[F.col(f.name).cast(f.dataType) for f in dim.schema])
    return rows.filter("NOT _added").drop("_added").unionByName(typed)


def _spliced(
    dim: DataFrame, changes: DataFrame, cols: Sequence[str], t: Tracking, effective: str, overwrite_current: bool
) -> DataFrame:
    """All versions after changes of any date, with `_added` on new ones, which have no surrogate key yet.

    A change splits the version that covers its date: that one ends the day before, keeps its key, and the rest of its time goes to a
    new version. If the version after it already has the new values, no version is opened: the later one starts earlier and keeps
    its key, as facts point at it. A change before the first version opens one that ends where the first begins. The `previous`
    columns of a version are repaired where the version before it is new. A change that repeats the values it meets opens
    nothing; nor does it leave a trace, so a later load knows only the versions there are. Keys without any version, and changes after the end of a key without an open version, are left out; see
    `refused_changes`. Gaps between versions stay, and a change in a gap fills it from its date on.

    The versions and changes of a key, at most a few per day of its history, are laid on one line and walked in one row.
    """
    values = [f"_new_{c}" for c in cols]
    kind = dim.schema[t.surrogate].dataType
    dated = _dated(changes, t, cols, effective).filter(F.col("_from").isNotNull())
    line = dated.select(
        "_key", F.struct("_from", F.lit(1).alias("_new"), F.lit(None).cast(kind).alias("_sk"), F.lit(None).cast("date").alias("_end"), *values).alias("_e")
    )
    held = dim.join(dated.select("_key").distinct(), F.col(t.key) == F.col("_key"), "left_semi").select(
        F.col(t.key).alias("_key"),
        F.struct(
            F.col(t.start).alias("_from"), F.lit(0).alias("_new"), F.col(t.surrogate).alias("_sk"), F.col(t.end).alias("_end"),
            *[F.col(c).alias(f"_new_{c}") for c in cols],
        ).alias("_e"),
    )
    per_key = held.unionByName(line).groupBy("_key").agg(
        F.array_sort(F.collect_list("_e")).alias("_events"), F.max(F.when(F.col("_e._new") == 0, _until(F.col("_e._end")))).alias("_last")
    )
    events = F.filter("_events", lambda e: (e["_new"] == 0) | (e["_from"] <= F.col("_last")))

    def version(from_: Column, until: Column, sk: Column, base: Column, moved: bool, source: Column) -> Column:
        return F.struct(
            from_.alias("_from"), until.cast("date").alias("_until"), sk.cast(kind).alias("_sk"), base.cast(kind).alias("_base"),
            F.lit(moved).alias("_moved"), *[source[v].alias(v) for v in values],
        )

    none = F.lit(None)

    def walk(versions: Column, e: Column) -> Column:
        last = F.try_element_at(versions, F.lit(-1))
        some = F.size(versions) > 0
        same = some
        for v in values:
            same = same & last[v].eqNullSafe(e[v])
        before = F.slice(versions, 1, F.greatest(F.size(versions) - 1, F.lit(0)))
        meets = last["_until"].isNull() | (last["_until"] == F.date_sub(e["_from"], 1))
        kept = F.concat(versions, F.array(version(e["_from"], e["_end"], e["_sk"], e["_sk"], False, e)))
        earlier = F.concat(before, F.array(version(last["_from"], e["_end"], e["_sk"], e["_sk"], True, e)))
        covers = last["_until"].isNull() | (last["_until"] >= e["_from"])
        alone = F.concat(versions, F.array(version(e["_from"], none, none, last["_base"], False, e)))
        cut = version(last["_from"], F.date_sub(e["_from"], 1), last["_sk"], last["_base"], False, last).withField("_moved", last["_moved"])
        split = F.concat(before, F.array(cut, version(e["_from"], last["_until"], none, last["_base"], False, e)))
        old = F.when(same & last["_sk"].isNull() & meets, earlier).otherwise(kept)
        new = F.when(~some | ~covers, alone).when(same, versions).otherwise(split)
        return F.when(e["_new"] == 0, old).otherwise(new)

    start = F.array().cast(
        f"array<struct<_from:date,_until:date,_sk:{kind.simpleString()},_base:{kind.simpleString()},_moved:boolean,"
        + ",".join(f"{v}:{dim.schema[c].dataType.simpleString()}" for c, v in zip(cols, values)) + ">>"
    )
    walked = per_key.filter(F.col("_last").isNotNull()).select("_key", F.aggregate(events, start, walk).alias("_v"))
    at = F.col("_i")
    steps = walked.select("_v", F.posexplode("_v").alias("_i", "_this")).select(
        "_i", "_this", F.get("_v", at - 1).alias("_before"), F.get("_v", at + 1).alias("_after"), F.element_at("_v", -1).alias("_newest"),
        F.get(F.filter("_v", lambda v: v["_base"].isNotNull()), F.lit(0))["_base"].alias("_first"),
    )

    def fresh(v: str) -> Column:
        """Whether a version is new, or starts at another day than it did."""
        return F.col(v).isNotNull() & (F.col(f"{v}._sk").isNull() | F.col(f"{v}._moved"))

    steps = steps.withColumn("_base", F.coalesce("_this._base", "_first"))
    joined = dim.join(steps, F.col(t.surrogate) == F.col("_base"), "left")
    touched, added = F.col("_this").isNotNull(), F.col("_this").isNotNull() & F.col("_this._sk").isNull()
    until = F.when(
        fresh("_this") | fresh("_after"), F.least("_this._until", F.date_sub("_after._from", 1))
    ).otherwise(F.col("_this._until"))
    out = {
        t.surrogate: F.when(~added, F.col(t.surrogate)),
        t.start: F.when(touched, F.col("_this._from")).otherwise(F.col(t.start)),
        t.end: F.when(touched, until).otherwise(F.col(t.end)),
        t.flag: F.when(touched, F.when(until.isNotNull(), False).when(added, True).otherwise(F.col(t.flag))).otherwise(F.col(t.flag)),
    }
    for c in cols:
        own = F.col(f"_this._new_{c}")
        out[c] = F.when(touched, own).otherwise(F.col(c))
        if c in t.previous:
            repaired = fresh("_this") | fresh("_before")
            out[t.previous[c]] = F.when(touched & repaired, F.col(f"_before._new_{c}")).otherwise(F.col(t.previous[c]))
        if c in t.current and overwrite_current:
            out[t.current[c]] = F.when(touched, F.col(f"_newest._new_{c}")).otherwise(F.col(t.current[c]))
        elif c in t.current:
            out[t.current[c]] = F.when(added, own).otherwise(F.col(t.current[c]))
    return joined.select(
        *[out.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in dim.schema], added.alias("_added")
    )


def scd6(
    dim: DataFrame,
    changes: DataFrame,
    cols: Sequence[str],
    tracking: Tracking,
    effective: str = "effective_date",
    *,
    backdated: bool = False,
) -> DataFrame:
    """As type 2, and every version of the key shows the newest value in its `current` column.

    A key without an open row takes no change, as in type 2.
    """
    return scd2(dim, changes, cols, tracking, effective, overwrite_current=True, backdated=backdated)


def dim_history(dim: DataFrame, tracking: Tracking) -> DataFrame:
    """All versions, ordered by business key and start."""
    return dim.orderBy(tracking.key, tracking.start, tracking.surrogate)
