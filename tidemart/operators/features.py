"""Feature views, on-demand features and services; training sets and latest-value tables."""

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tidemart.operators.asof import Lookup, StoredHistory, StoredLookup, point_in_time_joins, point_in_time_stored
from tidemart.operators.ordered import GROUP_ROWS, latest_per_key
from tidemart.sources.scratch import materialise
from tidemart.sources.store import Store
from tidemart.sources.tables import add_rows, fold, read_reduced, read_table, table_state

# --- definitions -------------------------------------------------------------------------------


@dataclass(frozen=True)
class Entity:
    name: str
    join_keys: tuple[str, ...]


@dataclass(frozen=True)
class FeatureSource:
    """Parquet rows with an event time and, optionally, a creation time. `rows` replaces the path.

    A `stored` history, laid out by the views' keys, replaces both: training sets then leave its rows where they are.
    """

    name: str
    path: str | None = None
    timestamp: str = "event_timestamp"
    created: str | None = "created"
    rows: DataFrame | None = field(default=None, compare=False)
    stored: StoredHistory | None = None

    def read(self, spark: SparkSession) -> DataFrame:
        if self.stored is not None:
            return self.stored.rows(spark)
        return self.rows if self.rows is not None else spark.read.parquet(self.path)


@dataclass(frozen=True)
class RequestSource:
    """Columns that come with the entity rows."""

    name: str
    schema: StructType

    def check(self, df: DataFrame) -> None:
        for wanted in self.schema:
            if wanted.name not in df.columns:
                raise ValueError(f"request column {wanted.name} is missing")
            if df.schema[wanted.name].dataType != wanted.dataType:
                raise TypeError(f"request column {wanted.name} must be {wanted.dataType.simpleString()}")


@dataclass(frozen=True)
class FeatureView:
    name: str
    entity: Entity
    schema: StructType
    source: FeatureSource
    ttl: timedelta | None = None
    tags: Mapping[str, str] = field(default_factory=dict)

    @property
    def features(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def columns(self) -> list[str]:
        made = [self.source.created] if self.source.created else []
        return [*self.entity.join_keys, self.source.timestamp, *made, *self.features]

    @property
    def order(self) -> list[str]:
        return [self.source.timestamp, *([self.source.created] if self.source.created else [])]

    def typed(self, df: DataFrame) -> DataFrame:
        """The view's columns only, features cast to their declared types."""
        missing = [c for c in self.columns if c not in df.columns]
        if missing:
            raise ValueError(f"{self.name}: source lacks {', '.join(missing)}")
        declared = {f.name: f.dataType for f in self.schema}
        return df.select(*[F.col(c).cast(declared[c]).alias(c) if c in declared else F.col(c) for c in self.columns])


@dataclass(frozen=True)
class OnDemandView:
    """Features computed from other views and request columns.

    Give `exprs` (column expressions, the usual way) or `pandas_fn`, which gets a pandas frame of
    the input columns per Arrow batch and returns the output columns.
    """

    name: str
    sources: tuple
    schema: StructType
    exprs: Mapping[str, Column] = field(default_factory=dict, compare=False)
    pandas_fn: Callable | None = None

    @property
    def features(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def views(self) -> list[FeatureView]:
        return [s for s in self.sources if isinstance(s, FeatureView)]

    @property
    def requests(self) -> list[RequestSource]:
        return [s for s in self.sources if isinstance(s, RequestSource)]

    def add_to(self, df: DataFrame) -> DataFrame:
        """`df`, which holds the input columns, with this view's features."""
        for request in self.requests:
            request.check(df)
        if self.pandas_fn is None:
            return df.withColumns({f.name: self.exprs[f.name].cast(f.dataType) for f in self.schema})
        inputs = [c for v in self.views for c in v.features]
        inputs += [c for r in self.requests for c in r.schema.fieldNames()]
        fn, names = self.pandas_fn, self.features

        @F.pandas_udf(self.schema)
        def made(columns: pd.DataFrame) -> pd.DataFrame:
            return fn(columns[inputs])[names]

        # Only the inputs go through pandas; all other columns stay as they are.
        out = df.withColumn("_made", made(F.struct(*dict.fromkeys(inputs))))
        return out.select(*[c for c in df.columns if c not in names], "_made.*")


@dataclass(frozen=True)
class Selection:
    """Some features of a view."""

    view: FeatureView | OnDemandView
    names: tuple[str, ...]


@dataclass(frozen=True)
class FeatureService:
    """A named selection of whole views and parts of views; `log_path` receives served features."""

    name: str
    parts: tuple
    log_path: str | None = None

    @property
    def selections(self) -> list[Selection]:
        return [p if isinstance(p, Selection) else Selection(p, tuple(p.features)) for p in self.parts]


def parse_ref(ref: str) -> tuple[str, str]:
    """`view:feature` to its two names."""
    view, separator, feature = ref.partition(":")
    if not (view and separator and feature) or ":" in feature:
        raise ValueError(f"feature reference must be view:feature, not {ref!r}")
    return view, feature


@dataclass(frozen=True)
class FeatureRepo:
    """The views and services that belong together, and where their latest values are kept, in so many buckets of keys.

    A fold rewrites a bucket as a whole, so choose as many as make a bucket some hundred MB.
    """

    views: tuple
    services: tuple = ()
    store: str | None = None
    buckets: int = 8

    def view(self, name: str):
        for view in self.views:
            if view.name == name:
                return view
        raise KeyError(f"no feature view {name}")

    def service(self, name: str) -> FeatureService:
        for service in self.services:
            if service.name == name:
                return service
        raise KeyError(f"no feature service {name}")

    def select(self, wanted: Sequence[str] | FeatureService) -> list[Selection]:
        """Per view the wanted features, in the order they are first named."""
        if isinstance(wanted, FeatureService):
            selections = wanted.selections
        else:
            grouped: dict[str, list[str]] = {}
            for ref in wanted:
                view, feature = parse_ref(ref)
                grouped.setdefault(view, []).append(feature)
            selections = [Selection(self.view(view), tuple(names)) for view, names in grouped.items()]
        names = [n for s in selections for n in s.names]
        if len(names) != len(set(names)):
            raise ValueError("two selected features share a name")
        for s in selections:
            unknown = set(s.names) - set(s.view.features)
            if unknown:
                raise ValueError(f"{s.view.name} has no feature {', '.join(sorted(unknown))}")
        return selections


def _plan(selections: Sequence[Selection]) -> tuple[dict, list[OnDemandView], list[str]]:
    """Stored views with the features each must deliver, the on-demand views, the output names."""
    stored: dict[str, tuple[FeatureView, list[str]]] = {}
    on_demand: list[OnDemandView] = []

    def need(view: FeatureView, names: Sequence[str]) -> None:
        have = stored.setdefault(view.name, (view, []))[1]
        have.extend(n for n in names if n not in have)

    for s in selections:
        if isinstance(s.view, OnDemandView):
            on_demand.append(s.view)
            for view in s.view.views:
                need(view, view.features)
        else:
            need(s.view, s.names)
    return stored, on_demand, [n for s in selections for n in s.names]


# --- training sets -----------------------------------------------------------------------------


def historical_features(
    spark: SparkSession,
    entity_df: DataFrame,
    wanted: Sequence[str] | FeatureService,
    repo: FeatureRepo,
    entity_ts: str = "event_timestamp",
    as_of: datetime | None = None,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Entity rows with the features known at each row's time; other entity columns pass through.

    `as_of` stamps every row with one time first: scoring now instead of training on the past.
    Values pushed to a view's history count as soon as they are there.
    """
    selections = repo.select(wanted)
    stored, on_demand, names = _plan(selections)
    if as_of is not None:
        entity_df = entity_df.withColumn(entity_ts, F.lit(as_of).cast("timestamp"))
    entity_columns = entity_df.columns
    by_keys: dict[tuple[str, ...], list[Lookup]] = {}
    in_place: dict[tuple[tuple[str, ...], int], list[StoredLookup]] = {}
    types = {}
    for view, features in stored.values():
        laid = view.source.stored
        if laid is not None and laid.keys == view.entity.join_keys and not _has_pushed(spark, view, repo):
            in_place.setdefault((laid.keys, laid.buckets), []).append(StoredLookup(laid, features, view.ttl))
            types.update({f.name: f.dataType for f in view.schema if f.name in features})
            continue
        history = view.typed(view_history(spark, view, repo))
        lookup = Lookup(history, features, view.source.timestamp, view.source.created, view.ttl)
        by_keys.setdefault(view.entity.join_keys, []).append(lookup)
    result = entity_df
    for keys, lookups in by_keys.items():
        result = point_in_time_joins(result, lookups, keys, entity_ts, group_rows)
    for lookups in in_place.values():
        result = point_in_time_stored(result, lookups, entity_ts, group_rows)
    result = result.withColumns({name: F.col(name).cast(kind) for name, kind in types.items()})
    for view in on_demand:
        result = view.add_to(result)
    return result.select(*entity_columns, *names)


def _history_path(view: FeatureView, repo: FeatureRepo) -> str:
    return f"{repo.store}/history/{view.source.name}"


def _has_pushed(spark: SparkSession, view: FeatureView, repo: FeatureRepo) -> bool:
    return bool(repo.store) and table_state(spark, _history_path(view, repo)).schema is not None


def view_history(spark: SparkSession, view: FeatureView, repo: FeatureRepo) -> DataFrame:
    """The source rows and any rows pushed since."""
    rows = view.source.read(spark)
    pushed = read_table(spark, _history_path(view, repo)) if repo.store else None
    return rows if pushed is None else rows.unionByName(pushed)


# --- latest values -----------------------------------------------------------------------------


def _store_path(view: FeatureView, repo: FeatureRepo) -> str:
    if not repo.store:
        raise ValueError("the feature repo has no store path")
    return f"{repo.store}/latest/{view.name}"


def upsert_latest(df: DataFrame, path: str, keys: Sequence[str], buckets: int = 8) -> None:
    """Offer rows to a latest-value table.

    Rows carry their time, so they are only added here; readers take the newest per key and
    `compact_latest` brings the buckets they fall into to one row per key. A repeated upsert changes nothing.
    """
    add_rows(df, path, keys=keys, buckets=buckets)


def _newest(keys: Sequence[str], order: Sequence[str]) -> Callable[[DataFrame], DataFrame]:
    return lambda rows: latest_per_key(rows, list(keys), list(order))


def read_latest(
    spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str], wanted: DataFrame | None = None
) -> DataFrame | None:
    """One row per key. With `wanted`, a DataFrame of keys, only buckets that can hold them are opened, and only their rows come."""
    rows = read_reduced(spark, path, _newest(keys, order), wanted)
    return rows if rows is None or wanted is None else rows.join(wanted.select(*keys), list(keys), "left_semi")


def compact_latest(spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str]) -> DataFrame | None:
    return fold(spark, path, _newest(keys, order))


def materialize_incremental(
    spark: SparkSession, repo: FeatureRepo, end: datetime, views: Sequence[str] | None = None
) -> dict[str, tuple[datetime | None, datetime]]:
    """Bring the newest row per key in (last end, end] of each view to its latest-value table.

    The first run of a view starts its TTL before `end`. Returns the time range used per view; the
    end is recorded only after the rows are written, so an interrupted run is simply repeated.
    """
    done = {}
    for view in repo.views:
        if not isinstance(view, FeatureView) or (views is not None and view.name not in views):
            continue
        path = _store_path(view, repo)
        start = _last_end(spark, path)
        if start is None and view.ttl is not None:
            start = end - view.ttl
        ts = F.col(view.source.timestamp).cast("timestamp")
        rows = view.typed(view_history(spark, view, repo)).filter(ts <= F.lit(end).cast("timestamp"))
        if start is not None:
            rows = rows.filter(ts > F.lit(start).cast("timestamp"))
        upsert_latest(latest_per_key(rows, list(view.entity.join_keys), view.order), path, view.entity.join_keys, repo.buckets)
        _mark(spark, path, end)
        done[view.name] = (start, end)
    return done


#: How the end of a load is written in a file name.
MARK = "%Y%m%dT%H%M%S.%f"


def _mark(spark: SparkSession, path: str, end: datetime) -> None:
    """Record that rows up to `end` are loaded. A later mark replaces earlier ones."""
    utc = end.astimezone(timezone.utc) if end.tzinfo else end
    store, name = Store(spark, path), utc.strftime(MARK)
    if name not in store.names(f"{path}/marks"):
        store.create(f"{path}/marks/{name}")


def _last_end(spark: SparkSession, path: str) -> datetime | None:
    marks = [datetime.strptime(n, MARK) for n in Store(spark, path).names(f"{path}/marks") if not n.startswith(".")]
    return max(marks, default=None)


def latest_features(
    spark: SparkSession, keys_df: DataFrame, wanted: Sequence[str] | FeatureService, repo: FeatureRepo
) -> DataFrame:
    """Rows of `keys_df` with the latest values of the wanted features; unknown keys get NULL.

    Also appends the result to the service's log destination when it has one.
    """
    stored, on_demand, names = _plan(repo.select(wanted))
    result = keys_df
    for view, features in stored.values():
        keys = list(view.entity.join_keys)
        # Other keys' rows are left out first; Spark plans the semi join by size.
        asked = keys_df.select(*keys)
        latest = read_reduced(
            spark, _store_path(view, repo),
            lambda rows: latest_per_key(rows.join(asked, keys, "left_semi"), keys, view.order),
        )
        if latest is None:
            nulls = {f.name: F.lit(None).cast(f.dataType) for f in view.schema if f.name in features}
            result = result.withColumns(nulls)
            continue
        result = result.join(latest.select(*keys, *features), keys, "left")
    for view in on_demand:
        result = view.add_to(result)
    result = result.select(*keys_df.columns, *names)
    if isinstance(wanted, FeatureService) and wanted.log_path:
        # Written first, so that what is logged and what is returned are one computation.
        result = materialise(result, "served")
        log_features(result, f"{wanted.log_path}/{wanted.name}")
    return result


def log_features(df: DataFrame, path: str) -> None:
    """Append served features with the time they were served."""
    df.withColumn("served_at", F.current_timestamp()).write.mode("append").parquet(path)


def push(
    spark: SparkSession, repo: FeatureRepo, source: str, df: DataFrame, to: str = "both", batch: int | None = None
) -> None:
    """Add rows to the history and/or the latest values of every view on `source`.

    With a `batch` number, a repeated push of that batch adds nothing to the history. To the latest values it never does.
    """
    if to not in ("history", "latest", "both"):
        raise ValueError("to must be history, latest or both")
    fed = [v for v in repo.views if isinstance(v, FeatureView) and v.source.name == source]
    if not fed:
        raise KeyError(f"no feature view reads {source}")
    if to in ("history", "both"):
        schema = fed[0].source.read(spark).schema
        rows = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
        add_rows(rows, _history_path(fed[0], repo), None if batch is None else source, batch)
    if to in ("latest", "both"):
        for view in fed:
            keys = view.entity.join_keys
            upsert_latest(latest_per_key(view.typed(df), list(keys), view.order), _store_path(view, repo), keys, repo.buckets)
