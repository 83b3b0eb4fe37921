"""Tables that change over time on plain Parquet.

A table is a folder with `base/v=N` (versions), `deltas/d=N` (rows added since) and `commits`. A commit is one small file with the whole
state of the table: which versions and deltas count, and which batches are in. A reader lists the commits, opens the newest and reads
what it names, so it never sees half of a version, and no path is overwritten while it is read. Only the newest commits are kept.

A table with `keys` deals its rows into a fixed number of buckets by a hash of the keys. A fold then rewrites only the buckets that rows
were added to, a read of given keys opens only theirs, and reading one row per key aggregates only buckets with added rows.

One writer per table at a time.
"""

import json
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tidemart.sources.store import Store

BUCKET = "_bucket"
#: Commits that stay, for readers that have just listed them.
KEPT_COMMITS = 16

Reduce = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class State:
    """What counts: `bases` has the version that holds each bucket (0: none), deltas in (`upto`, `last`] were added since.

    A table without keys has one bucket. `batches` has the numbers that each named source has added, as ranges.
    """

    commit: int = 0
    version: int = 0
    upto: int = 0
    last: int = 0
    bases: tuple[int, ...] = (0,)
    keys: tuple[str, ...] = ()
    schema: dict | None = None
    batches: dict[str, list[list[int]]] = field(default_factory=dict)

    @property
    def deltas(self) -> range:
        return range(self.upto + 1, self.last + 1)

    def holds(self, source: str, batch: int | None) -> bool:
        number = -1 if batch is None else batch
        return any(low <= number <= high for low, high in self.batches.get(source, ()))

    def with_batch(self, source: str, batch: int | None) -> "State":
        """Neighbouring numbers make one range, so a stream's batches stay one entry."""
        number = -1 if batch is None else batch
        ranges: list[list[int]] = []
        for low, high in sorted([*self.batches.get(source, ()), [number, number]]):
            if ranges and low <= ranges[-1][1] + 1:
                ranges[-1][1] = max(ranges[-1][1], high)
            else:
                ranges.append([low, high])
        return replace(self, batches={**self.batches, source: ranges})


def table_state(spark: SparkSession, path: str) -> State:
    store = Store(spark, path)
    commits = [n for n in store.names(f"{path}/commits") if not n.startswith(".")]
    if not commits:
        return State()
    told = json.loads(store.read(f"{path}/commits/{commits[-1]}"))
    return State(**{**told, "bases": tuple(told["bases"]), "keys": tuple(told["keys"])})


def _commit(spark: SparkSession, path: str, state: State) -> State:
    state = replace(state, commit=state.commit + 1)
    store = Store(spark, path)
    store.create(f"{path}/commits/{state.commit:020d}.json", json.dumps(asdict(state)))
    for name in [n for n in store.names(f"{path}/commits") if not n.startswith(".")][:-KEPT_COMMITS]:
        store.remove(f"{path}/commits/{name}")
    return state


def bucket_of(keys: Sequence[str | Column], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _write(df: DataFrame, path: str, state: State) -> None:
    """Overwrite only clears what an unfinished attempt at the same path left behind."""
    if not state.keys:
        df.write.mode("overwrite").parquet(path)
        return
    placed = df.withColumn(BUCKET, bucket_of(state.keys, len(state.bases)))
    # Each bucket lands in few files; AQE splits a bucket that is too much for one task.
    placed.hint("rebalance", F.col(BUCKET)).write.mode("overwrite").partitionBy(BUCKET).parquet(path)


def _typed(df: DataFrame, schema: StructType) -> DataFrame:
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema])


def _known(state: State) -> StructType:
    return StructType.fromJson(state.schema)


def publish(df: DataFrame, path: str, upto: int | None = None) -> DataFrame:
    """Write `df` as the next full version and make it current. `upto` is the last delta it holds, by default all of them."""
    spark = df.sparkSession
    state = table_state(spark, path)
    version = state.version + 1
    _write(df, f"{path}/base/v={version}", state)
    _commit(spark, path, replace(
        state, version=version, upto=state.last if upto is None else upto, bases=(version,) * len(state.bases),
        schema=df.schema.jsonValue(),
    ))
    return read_table(spark, path)


def add_rows(
    df: DataFrame, path: str, source: str | None = None, batch: int | None = None, keys: Sequence[str] = (), buckets: int = 1
) -> int | None:
    """Add rows without rewriting the table; the number of the new delta.

    A writer that may repeat a batch names itself in `source` and the batch in `batch`: a batch that is already there is not
    added again, and gives None. The first rows fix columns, `keys` and `buckets`.
    """
    spark = df.sparkSession
    state = table_state(spark, path)
    if source is not None and state.holds(source, batch):
        return None
    if state.schema is None:
        state = replace(state, schema=df.schema.jsonValue(), keys=tuple(keys), bases=(0,) * (buckets if keys else 1))
    elif keys and tuple(keys) != state.keys:
        raise ValueError(f"the table has keys {state.keys}, not {tuple(keys)}")
    number = state.last + 1
    _write(_typed(df, _known(state)), f"{path}/deltas/d={number}", state)
    state = replace(state, last=number)
    _commit(spark, path, state if source is None else state.with_batch(source, batch))
    return number


def _bucket_paths(store: Store, folder: str, wanted: set[int]) -> list[str]:
    """The folders of some buckets; the folder itself if it holds no others."""
    held = {int(n.partition("=")[2]): n for n in store.names(folder) if n.startswith(f"{BUCKET}=")}
    if held.keys() <= wanted:
        return [folder] if held else []
    return [f"{folder}/{held[b]}" for b in sorted(held.keys() & wanted)]


def _paths(spark: SparkSession, path: str, state: State, wanted: set[int] | None = None, deltas: bool = True) -> list[str]:
    if not state.keys:
        found = [f"{path}/base/v={state.bases[0]}"] if state.bases[0] else []
        return found + [f"{path}/deltas/d={d}" for d in state.deltas if deltas]
    store = Store(spark, path)
    wanted = set(range(len(state.bases))) if wanted is None else wanted
    found = []
    for version in sorted({state.bases[b] for b in wanted} - {0}):
        found += _bucket_paths(store, f"{path}/base/v={version}", {b for b in wanted if state.bases[b] == version})
    for d in state.deltas if deltas else ():
        found += _bucket_paths(store, f"{path}/deltas/d={d}", wanted)
    return found


def _rows(spark: SparkSession, state: State, paths: list[str]) -> DataFrame:
    schema = _known(state)
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(*paths)


def touched_buckets(spark: SparkSession, path: str, state: State | None = None) -> set[int]:
    """The buckets that rows were added to since they were last folded, from listings."""
    state = state or table_state(spark, path)
    store = Store(spark, path)
    names = (n for d in state.deltas for n in store.names(f"{path}/deltas/d={d}"))
    return {int(n.partition("=")[2]) for n in names if n.startswith(f"{BUCKET}=")}


def _wanted(state: State, keys: DataFrame | None) -> set[int] | None:
    """The buckets that some keys fall into: at most as many numbers as there are buckets."""
    if keys is None or not state.keys:
        return None
    types = {f.name: f.dataType for f in _known(state)}
    typed = keys.select(*[F.col(f"`{k}`").cast(types[k]).alias(k) for k in state.keys])
    return {r[0] for r in typed.select(bucket_of(state.keys, len(state.bases)).alias(BUCKET)).distinct().collect()}


def read_table(spark: SparkSession, path: str, keys: DataFrame | None = None) -> DataFrame | None:
    """The current versions together with the rows added since; None if there is no table. Only live files are listed.

    With `keys`, a table with buckets opens only those that can hold them; rows of other keys in these come along.
    """
    state = table_state(spark, path)
    return None if state.schema is None else _rows(spark, state, _paths(spark, path, state, _wanted(state, keys)))


def read_reduced(spark: SparkSession, path: str, reduce: Reduce, keys: DataFrame | None = None) -> DataFrame | None:
    """`reduce` of the current rows, where folds use the same `reduce`. Buckets without added rows are read as they are."""
    state = table_state(spark, path)
    if state.schema is None:
        return None
    wanted = _wanted(state, keys)
    if not state.keys:
        return reduce(_rows(spark, state, _paths(spark, path, state)))
    wanted = set(range(len(state.bases))) if wanted is None else wanted
    open_ = touched_buckets(spark, path, state) & wanted
    settled = _paths(spark, path, state, wanted - open_, deltas=False)
    if not open_:
        return _rows(spark, state, settled)
    moving = _typed(reduce(_rows(spark, state, _paths(spark, path, state, open_))), _known(state))
    return _rows(spark, state, settled).unionByName(moving) if settled else moving


def fold(spark: SparkSession, path: str, reduce: Reduce) -> DataFrame | None:
    """Make `reduce(current rows)` the table, so that reads need no deltas. Rows of one key must be reduced by themselves.

    Without keys that is a new full version. With keys only buckets with added rows are rewritten; the files of all others stay.
    """
    state = table_state(spark, path)
    if state.schema is None:
        return None
    if not state.keys:
        return publish(reduce(_rows(spark, state, _paths(spark, path, state))), path, state.last)
    touched = touched_buckets(spark, path, state)
    if touched:
        version = state.version + 1
        _write(_typed(reduce(_rows(spark, state, _paths(spark, path, state, touched))), _known(state)), f"{path}/base/v={version}", state)
        bases = tuple(version if b in touched else v for b, v in enumerate(state.bases))
        _commit(spark, path, replace(state, version=version, upto=state.last, bases=bases))
    return read_table(spark, path)


def vacuum(spark: SparkSession, path: str) -> list[str]:
    """Remove versions, buckets of versions, and deltas that no longer count; what was removed.

    Readers that opened the table before the last fold may still need them: run it when they are done.
    """
    state, store = table_state(spark, path), Store(spark, path)
    dead = [f"{path}/deltas/{n}" for n in store.names(f"{path}/deltas") if int(n.partition("=")[2]) <= state.upto]
    for name in store.names(f"{path}/base"):
        version = int(name.partition("=")[2])
        if version not in state.bases:
            dead.append(f"{path}/base/{name}")
        elif state.keys:
            held = (n for n in store.names(f"{path}/base/{name}") if n.startswith(f"{BUCKET}="))
            dead += [f"{path}/base/{name}/{n}" for n in held if state.bases[int(n.partition("=")[2])] != version]
    for gone in dead:
        store.remove(gone)
    return dead
