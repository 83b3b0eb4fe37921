"""Streams: order inside a partition, repeated deliveries, the gate."""

import random
import time
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.errors import StreamingQueryException

from helpers import tuples
from tidemart.operators.quality import between, in_set, not_null, observed, unique, validate
from tidemart.sources.tables import read_table
from tidemart.streaming import ordering
from tidemart.streaming.gate import stream_gated
from tidemart.streaming.ordering import in_order, rocksdb
from tidemart.streaming.sources import event_time, read_parquet_stream
from tidemart.streaming.windows import windowed_orders, write_stream_parquet

LOG = "topic string, partition int, offset long, timestamp timestamp, value string"


def minute(m):
    return f"timestamp'2026-01-01 00:00:00' + interval {m} minutes"


def land(spark, folder, rows):
    """Messages (partition, offset, minute) as one file."""
    parts = [f"select 'orders' topic, {p} partition, {o}L offset, {minute(m)} timestamp, 'v{o}' value" for p, o, m in rows]
    spark.sql(" union all ".join(parts)).coalesce(1).write.mode("append").parquet(str(folder))


def run(spark, folder, tmp_path, **more):
    stream = read_parquet_stream(spark, str(folder), spark.createDataFrame([], LOG).schema, max_files=1)
    with rocksdb(spark):
        write_stream_parquet(in_order(stream, **more), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    return tuples(spark.read.parquet(str(tmp_path / "out")), "partition", "position", "offset", "skipped")


def test_a_hole_is_held_filled_and_given_up(spark, tmp_path):
    folder = tmp_path / "in"
    land(spark, folder, [(0, 0, 0), (0, 2, 2), (0, 1, 1), (1, 1, 1)])
    land(spark, folder, [(0, 5, 5), (0, 4, 4), (0, 2, 2)])  # 3 is missing, 2 comes again
    first = [(0, 1, 0, 0), (0, 2, 1, 0), (0, 3, 2, 0)]
    assert run(spark, folder, tmp_path) == first
    land(spark, folder, [(0, 3, 3), (1, 0, 0), (0, 7, 7), (0, 9, 9)])  # after a restart 3 fills the hole; 6 and 8 are missing
    second = first + [(0, 4, 3, 0), (0, 5, 4, 0), (0, 6, 5, 0), (1, 1, 0, 0), (1, 2, 1, 0)]
    assert run(spark, folder, tmp_path) == second
    land(spark, folder, [(1, 2, 18)])  # the watermark passes 7, not 9
    third = second + [(1, 3, 2, 0), (0, 7, 7, 1)]
    assert run(spark, folder, tmp_path) == sorted(third)
    land(spark, folder, [(1, 3, 60), (0, 6, 59)])  # 6 comes too late; 9 is given a go
    fourth = third + [(1, 4, 3, 0), (0, 8, 9, 1)]
    assert run(spark, folder, tmp_path) == sorted(fourth)


def test_holes_by_the_clock_and_an_unknown_start(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    land(spark, folder, [(0, 12, 2), (0, 10, 0), (3, 7, 0)])
    stream = read_parquet_stream(spark, str(folder), spark.createDataFrame([], LOG).schema)
    with rocksdb(spark):
        query = write_stream_parquet(in_order(stream, first=None, wait_ms=1), out, str(tmp_path / "cp"), every="1 second")
    got, end = [], time.time() + 60
    try:
        while len(got) < 3 and time.time() < end:
            time.sleep(1)
            if query.lastProgress:
                got = tuples(spark.read.schema("partition int, position long, offset long, skipped long").parquet(out))
    finally:
        query.stop()
    assert got == [(0, 1, 10, 0), (0, 2, 12, 1), (3, 1, 7, 0)]


def test_any_landings_give_the_whole_order(spark, tmp_path):
    rng, folder = random.Random(2), tmp_path / "in"
    messages = [(p, o, o) for p in range(3) for o in range(40)]
    rng.shuffle(messages)
    sent = messages + rng.sample(messages, 30)
    for i in range(0, len(sent), 50):
        land(spark, folder, sent[i:i + 50])
    got = run(spark, folder, tmp_path, patience="1 day")
    assert got == [(p, o + 1, o, 0) for p in range(3) for o in range(40)]


class Held(dict):
    """State of one partition in memory, and how often an entry is written."""

    writes = 0

    def getValueState(self, name, schema):
        return self.line

    def getMapState(self, name, keys, values):
        return self

    def __init__(self):
        self.line, self.timers = SimpleNamespace(exists=lambda: False), set()
        self.line.update = self.keep
        self.registerTimer, self.deleteTimer, self.getValue, self.removeKey = self.timers.add, self.timers.remove, self.get, self.pop

    def keep(self, value):
        self.line.get, self.line.exists = lambda: value, lambda: True

    def updateValue(self, key, value):
        self.writes += 1
        self[key] = value


def ordering_state(first=0):
    state, held = ordering._InOrder(first, None), Held()
    state.init(held)

    def send(offsets, tag="v"):
        rows = pd.DataFrame({"offset": offsets, "at": [o * 1000 for o in offsets], "value": [None if o % 7 == 0 else f"{tag}{o}" for o in offsets]})
        return [tuple(r) for part in state.handleInputRows(("t", 0), iter([rows]), None) for r in part[["position", "offset", "value", "skipped"]].itertuples(index=False)]

    def expire():
        timer = held.timers.pop()  # as Spark drops a timer that it fires
        info = SimpleNamespace(getExpiryTimeInMs=lambda: timer)
        return [tuple(r) for part in state.handleExpiredTimer(("t", 0), None, info) for r in part[["position", "offset", "value", "skipped"]].itertuples(index=False)]

    return held, send, expire


def test_messages_behind_a_hole_are_written_in_blocks():
    held, send, _ = ordering_state()
    assert send(list(range(1, 20_001))) == []
    assert held.writes == len(held) == 5
    got = send([0])
    assert [r[:2] for r in got] == [(o + 1, o) for o in range(20_001)] and not held and not held.timers


@pytest.mark.parametrize("block", [1, 4, 4096])
def test_blocks_of_held_messages_equal_single_ones(monkeypatch, block):
    """Random landings against a plain model: what continues goes on, newer copies replace held ones, a timer gives up a hole."""
    monkeypatch.setattr(ordering, "BLOCK", block)
    rng = random.Random(block)
    held, send, expire = ordering_state()
    next_, position, waiting = 0, 0, {}
    text = lambda o, tag: None if o % 7 == 0 else f"{tag}{o}"

    def released(skipped=0):
        nonlocal next_, position
        out = []
        while next_ in waiting:
            position += 1
            out.append((position, next_, waiting.pop(next_), 0 if out else skipped))
            next_ += 1
        return out

    for turn in range(200):
        if waiting and rng.random() < 0.1:
            skipped, next_ = min(waiting) - next_, min(waiting)
            assert expire() == released(skipped)
        offsets = rng.sample(range(max(0, next_ - 3), next_ + 25), rng.randint(1, 9))
        waiting |= {o: text(o, turn) for o in offsets if o >= next_}
        assert send(offsets, turn) == released()
        assert held.timers == ({min(waiting)} if waiting else set())
        assert held.line.get()[2] == min(waiting, default=-1) if held.line.exists() else not waiting
        assert len(held) == len({o // block for o in waiting})


def test_messages_that_come_twice_count_once(spark, tmp_path):
    schema = "message_id long, customer_id int, amount double, ts timestamp"
    folder = tmp_path / "in"
    for rows in ([(1, 7, 2.0, 0), (2, 7, 3.0, 1)], [(1, 7, 2.0, 0), (2, 7, 3.0, 1)], [(3, 7, 5.0, 4), (2, 7, 3.0, 1)], [(4, 7, 1.0, 30)], [(3, 7, 5.0, 4)]):
        parts = [f"select {i}L message_id, {c} customer_id, {a}D amount, {minute(m)} ts" for i, c, a, m in rows]
        spark.sql(" union all ".join(parts)).coalesce(1).write.mode("append").parquet(str(folder))
    got = {}
    for once in ((), ("message_id",)):
        name = "once" if once else "all"
        stream = read_parquet_stream(spark, str(folder), spark.createDataFrame([], schema).schema, max_files=1)
        timed = stream.withColumn("event_time", event_time("ts"))
        write_stream_parquet(windowed_orders(timed, once=once), str(tmp_path / name), str(tmp_path / f"cp-{name}")).awaitTermination()
        got[name] = tuples(spark.read.parquet(str(tmp_path / name)), "customer_id", "total_orders", "total_amount")
    assert got == {"all": [(7, 7, 23.0)], "once": [(7, 3, 10.0)]}


ORDERS = "id long, status string, qty int"


def suite():
    return [not_null("id"), unique("id"), in_set("status", ["new", "paid"]), between("qty", 1, 9), not_null("missing")]


def test_gate_stops_and_goes_on(spark, tmp_path):
    folder, path, aside, cp = (str(tmp_path / n) for n in ("in", "table", "aside", "cp"))
    for rows in ([(1, "new", 1)], [(2, "new", 1), (2, "odd", 1)], [(3, "paid", 2)]):
        spark.createDataFrame(rows, ORDERS).coalesce(1).write.mode("append").parquet(folder)
    stream = read_parquet_stream(spark, folder, spark.createDataFrame([], ORDERS).schema, max_files=1)
    for _ in range(2):  # a second start meets the same batch and does not set it aside twice
        with pytest.raises(StreamingQueryException, match="QualityGateFailed"):
            stream_gated(stream, suite()[:4], path, aside, cp).awaitTermination()
        assert tuples(read_table(spark, path)) == [(1, "new", 1)]
        held = read_table(spark, aside)
        assert tuples(held, "id", "status", "_batch") == [(2, "new", 1), (2, "odd", 1)]
        assert sorted(held.first()["_reasons"]) == ["in_set on status: 1 of 2 unexpected", "unique on id: 2 of 2 unexpected"]
    stream_gated(stream, suite()[:4], path, aside, cp, stop=False).awaitTermination()
    assert tuples(read_table(spark, path), "id") == [(1,), (3,)]
    assert read_table(spark, aside).count() == 2


def test_gate_lets_a_repaired_suite_publish(spark, tmp_path):
    folder, path, aside, cp = (str(tmp_path / n) for n in ("in", "table", "aside", "cp"))
    spark.createDataFrame([(1, "odd", 1)], ORDERS).write.parquet(folder)
    stream = read_parquet_stream(spark, folder, spark.createDataFrame([], ORDERS).schema)
    with pytest.raises(StreamingQueryException):
        stream_gated(stream, suite()[2:3], path, aside, cp).awaitTermination()
    assert read_table(spark, path) is None
    stream_gated(stream, [in_set("status", ["odd"])], path, aside, cp).awaitTermination()
    assert tuples(read_table(spark, path), "status") == [("odd",)]


def test_observed_rules_equal_validated_ones(spark, tmp_path):
    df = spark.createDataFrame([(1, "new", 1), (1, None, 20), (None, "odd", None)], ORDERS)
    for rules in (suite(), suite()[1:2]):
        counted, results = observed(df, rules)
        path = str(tmp_path / f"w{len(rules)}")
        counted.write.parquet(path)
        order = lambda rows: sorted(map(tuple, rows.collect()), key=str)
        assert order(results(spark.read.parquet(path))) == order(validate(df, rules))
