"""Messages of each topic partition in offset order, while they stream in.

Files and retries deliver the messages of a log partition out of order, more than once, or not at all. Each partition has a state: the
offset that comes next, and the messages behind a hole. What continues the order is passed on at once, what has been passed on is dropped,
and what lies behind a hole is held until the hole is filled or given up by a timer.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructField, StructType

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
NONE = -1
HELD = pa.schema([("offset", pa.int64()), ("at", pa.int64()), ("value", pa.string())])


#: Held messages of so many consecutive offsets are one entry of the state: a round trip a message is too slow for large holes.
BLOCK = 4096


class _InOrder(StatefulProcessor):
    """State per partition: `line` (next offset, messages passed on, first held offset, its timer) and the held messages in blocks of offsets."""

    def __init__(self, first: int | None, wait_ms: int | None):
        self.first, self.wait_ms = first, wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.line = handle.getValueState("line", "next long, passed long, held long, timer long")
        self.held = handle.getMapState("held", "block long", "messages binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows))[["offset", "at", "value"]].drop_duplicates("offset").sort_values("offset")
        if self.line.exists():
            next_, passed, held, timer = self.line.get()
        else:
            next_, passed, held, timer = int(new["offset"].iloc[0]) if self.first is None else self.first, 0, NONE, NONE
        new = new[new["offset"] >= next_]
        if not len(new):
            return
        first, out = int(new["offset"].iloc[0]), new[:0]
        if first == next_:
            out, held, at = self._released(new, next_, held != NONE)
        else:
            at = int(new["at"].iloc[0]) if held == NONE or first <= held else None
            for block, part in _blocks(new):
                self._hold(block, part if held == NONE else _joined(part, self._block(block)))
            held = first if held == NONE else min(held, first)
        timer = self._timed(held, at, timer, timerValues)
        next_, passed = next_ + len(out), passed + len(out)
        self.line.update((next_, passed, held, timer))
        if len(out):
            yield _told(key, out, passed, 0)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """The hole is given up: go on with the first message behind it."""
        next_, passed, held, timer = self.line.get()
        if held == NONE or expiredTimerInfo.getExpiryTimeInMs() != timer:
            return
        skipped, next_ = held - next_, held
        out, held, at = self._released(None, next_, True)
        next_, passed = next_ + len(out), passed + len(out)
        timer = self._timed(held, at, NONE, timerValues)
        self.line.update((next_, passed, held, timer))
        yield _told(key, out, passed, skipped)

    def _released(self, new: pd.DataFrame | None, next_: int, stored: bool) -> tuple[pd.DataFrame, int, int | None]:
        """What continues from `next_` of the new and the held messages, and the offset and time of the first one left, which stay held.

        Only blocks that messages come to or go from are read, and the first one behind the next hole.
        """
        fresh = {} if new is None else dict(_blocks(new))
        old = {k[0] for k in self.held.keys()} if stored else set()
        out, held, at = [], NONE, None
        for block in sorted(old | fresh.keys()):
            goes_on = next_ // BLOCK == block
            if not (goes_on or block in fresh or held == NONE):
                continue
            kept = self._block(block) if block in old else None
            rows = _joined(fresh[block], kept) if block in fresh else kept
            count = _run(rows["offset"].to_numpy(), next_) if goes_on else 0
            out.append(rows[:count])
            next_, rest = next_ + count, rows[count:]
            if len(rest) and held == NONE:
                held, at = int(rest["offset"].iloc[0]), int(rest["at"].iloc[0])
            if len(rest) and (count or block in fresh):
                self._hold(block, rest)
            elif not len(rest) and block in old:
                self.held.removeKey((block,))
        return pd.concat(out), held, at

    def _block(self, block: int) -> pd.DataFrame | None:
        found = self.held.getValue((block,))
        return None if found is None else pa.ipc.open_stream(bytes(found[0])).read_all().to_pandas()

    def _hold(self, block: int, rows: pd.DataFrame) -> None:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, HELD) as to:
            to.write_table(pa.Table.from_pandas(rows, HELD, preserve_index=False))
        self.held.updateValue((block,), (sink.getvalue().to_pybytes(),))

    def _timed(self, held: int, at: int | None, timer: int, now) -> int:
        """The timer of the first held message: its own time, or so long from now. `at` is None if it has one already."""
        if held == NONE or at is not None:
            if timer != NONE:
                self.handle.deleteTimer(timer)
            if held == NONE:
                return NONE
            timer = at // 1000 if self.wait_ms is None else now.getCurrentProcessingTimeInMs() + self.wait_ms
            self.handle.registerTimer(timer)
        return timer


def _blocks(rows: pd.DataFrame) -> Iterator[tuple[int, pd.DataFrame]]:
    """Sorted messages by block."""
    number = rows["offset"].to_numpy() // BLOCK
    edges = np.flatnonzero(np.diff(number)) + 1
    for low, high in zip([0, *edges.tolist()], [*edges.tolist(), len(rows)]):
        yield int(number[low]), rows[low:high]


def _joined(new: pd.DataFrame, old: pd.DataFrame | None) -> pd.DataFrame:
    """The messages of both, sorted; a new one replaces a held one of its offset."""
    if old is None:
        return new
    return pd.concat([new, old[~old["offset"].isin(new["offset"])]]).sort_values("offset")


def _run(offsets: np.ndarray, first: int) -> int:
    """How many sorted offsets continue from `first` without a hole."""
    off = np.flatnonzero(offsets != first + np.arange(len(offsets)))
    return int(off[0]) if len(off) else len(offsets)


def _told(key, rows: pd.DataFrame, passed: int, skipped: int) -> pd.DataFrame:
    position = np.arange(passed - len(rows) + 1, passed + 1)
    return pd.DataFrame({
        "topic": key[0], "partition": key[1], "offset": rows["offset"].to_numpy(np.int64), "at": rows["at"].to_numpy(np.int64),
        "value": rows["value"].to_numpy(object), "position": position, "skipped": np.where(np.arange(len(rows)) == 0, skipped, 0),
    })


def in_order(
    messages: DataFrame, time: str = "timestamp", patience: str = "10 minutes", first: int | None = 0, wait_ms: int | None = None
) -> DataFrame:
    """A stream of messages (`topic`, `partition`, `offset`, `value` as text, and their time) in offset order per partition.

    Adds `position`, 1, 2, 3 ... per partition in the order of release, and `skipped`, how many offsets were given up just before a
    message. Each offset is passed on once; repeats are dropped. `first` is the offset that a partition starts with; with None
    it is the smallest one of its first batch. A hole is given up when the watermark, `patience` behind the newest message, has
    passed the message after it; messages later than that are dropped. With `wait_ms` it is given up so many milliseconds after
    the message behind it came in, by the clock; such a query has to keep running, since one that ends when all is read would wait for
    its timers for ever. What still lies behind a hole when a stream stops stays in its state.

    Messages that continue the order are only sorted; the state is written for those behind a hole, in blocks of `BLOCK` offsets. Spark
    refuses a checkpoint that holds single messages, as earlier versions wrote them. Needs the RocksDB state store.
    """
    needed = messages.withWatermark(time, patience) if wait_ms is None else messages
    own = needed.select(
        "topic", "partition", "offset", F.col("value").cast("string").alias("value"), F.unix_micros(time).alias("at"), F.col(time).alias(time)
    ).where("topic IS NOT NULL AND partition IS NOT NULL AND offset IS NOT NULL AND at IS NOT NULL")
    kinds = {f.name: f for f in own.schema}
    schema = StructType([
        kinds["topic"], kinds["partition"], StructField("offset", LongType()), StructField("at", LongType()), kinds["value"],
        StructField("position", LongType()), StructField("skipped", LongType()),
    ])
    found = own.groupBy("topic", "partition").transformWithStateInPandas(
        _InOrder(first, wait_ms), schema, "Append", "EventTime" if wait_ms is None else "ProcessingTime"
    )
    return found.select(
        "topic", "partition", "offset", F.timestamp_micros("at").alias(time), "value", "position", "skipped"
    )


class rocksdb:
    """While streams are started inside this context, they keep their state in RocksDB, whatever the session says."""

    def __init__(self, spark: SparkSession):
        self.conf = spark.conf

    def __enter__(self):
        self.before = self.conf.get(_PROVIDER)
        self.conf.set(_PROVIDER, ROCKSDB)

    def __exit__(self, *_):
        self.conf.set(_PROVIDER, self.before)
