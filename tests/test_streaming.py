"""Event-time windows, restarts, message parsing, change events."""

import itertools
import json
import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from helpers import D, same, tuples
from tidemart.operators.changes import apply_changes, change_delta, parse_change_events
from tidemart.operators.relational import parse_delimited
from tidemart.streaming.changes import compact_changes, current_rows, stream_changes
from tidemart.streaming.sources import accepted, parse_json, read_event_files, read_kafka, rejected
from tidemart.streaming.windows import lag, order_within_partition, windowed_orders, write_stream_parquet

ORDER_EVENT = StructType([
    StructField("order_id", IntegerType()), StructField("customer_id", IntegerType()),
    StructField("amount", DoubleType()), StructField("event_time", StringType()),
])


def land(folder, name, events):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(e if isinstance(e, str) else json.dumps(e) for e in events) + "\n")


def event(order, customer, time, amount):
    return {"order_id": order, "customer_id": customer, "amount": amount, "event_time": f"2026-03-01T{time}:00"}


def run(spark, tmp_path, out="out", checkpoint="cp"):
    events = parse_json(read_event_files(spark, str(tmp_path / "in")), ORDER_EVENT)
    write_stream_parquet(windowed_orders(events), str(tmp_path / out), str(tmp_path / checkpoint)).awaitTermination()
    schema = "window struct<start: timestamp, end: timestamp>, customer_id int, total_orders long, total_amount double"
    rows = spark.read.schema(schema).parquet(str(tmp_path / out))
    return tuples(rows.select(F.date_format("window.start", "HH:mm"), F.date_format("window.end", "HH:mm"), "customer_id", "total_orders", "total_amount"))


def test_windows_late_rows_and_restart(spark, tmp_path):
    folder = tmp_path / "in"
    land(folder, "1", [event(1, 101, "10:00", 15.5), event(2, 101, "10:01", 20.0), event(3, 102, "10:07", 12.0), "no json"])
    assert run(spark, tmp_path) == []
    land(folder, "2", [event(4, 103, "10:10", 1.0)])
    first = ("10:00", "10:05", 101, 2, 35.5)
    assert run(spark, tmp_path) == [first]
    land(folder, "3", [event(5, 101, "10:02", 9.0), event(6, 103, "10:16", 1.0)])
    assert run(spark, tmp_path) == [first, ("10:05", "10:10", 102, 1, 12.0)]


def test_a_running_query_takes_in_new_files(spark, tmp_path):
    folder = tmp_path / "in"
    land(folder, "1", [event(1, 101, "10:00", 15.5)])
    events = parse_json(read_event_files(spark, str(folder)), ORDER_EVENT)
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")
    query = write_stream_parquet(windowed_orders(events), out, cp, every="1 second")
    try:
        query.processAllAvailable()
        land(folder, "2", [event(2, 103, "10:30", 1.0)])
        query.processAllAvailable()
    finally:
        query.stop()
    assert tuples(spark.read.parquet(out), "customer_id", "total_amount") == [(101, 15.5)]


def test_batches_without_late_rows_equal_one_aggregate(spark, tmp_path):
    rng = random.Random(7)
    minutes = sorted(rng.choices(range(600, 720), k=120))
    events = [event(i, rng.randint(1, 5), f"{m // 60:02d}:{m % 60:02d}", float(rng.randint(1, 9))) for i, m in enumerate(minutes)]
    for i in range(4):
        land(tmp_path / "in", str(i), events[i * 30:(i + 1) * 30])
        got = run(spark, tmp_path)
    last = max(minutes)
    expected = {}
    for e, m in zip(events, minutes):
        start = m - m % 5
        if start + 5 <= last - 5:
            n, total = expected.get((start, e["customer_id"]), (0, 0.0))
            expected[(start, e["customer_id"])] = (n + 1, total + e["amount"])
    clock = lambda m: f"{m // 60:02d}:{m % 60:02d}"
    assert got == sorted((clock(s), clock(s + 5), c, n, t) for (s, c), (n, t) in expected.items())


def test_rejects_are_kept(spark):
    df = spark.createDataFrame([('{"order_id": 1, "event_time": "2026-03-01T10:00:00"}',), ("no json",)], "value string")
    parsed = parse_json(df, ORDER_EVENT, rejects=True)
    assert tuples(rejected(parsed)) == [("no json",)]
    assert tuples(accepted(parsed).select("order_id", F.hour("event_time"))) == [(1, 10)]


def test_kafka_needs_its_package(spark):
    with pytest.raises(AnalysisException, match="kafka"):
        read_kafka(spark, "localhost:1", "orders_stream", options={"maxOffsetsPerTrigger": "10"})


def test_messages(spark):
    df = spark.createDataFrame([("order_001,created",), ("order_002,paid",), ("order_003",)], "value string")
    assert tuples(parse_delimited(df, ["order", "status"])) == [("order_001", "created"), ("order_002", "paid"), ("order_003", None)]
    log = spark.createDataFrame([("orders", p, o) for p in (1, 0) for o in (3, 1, 2)], "topic string, partition int, offset long")
    assert [(r.partition, r.offset) for r in order_within_partition(log).collect()] == [(p, o) for p in (0, 1) for o in (1, 2, 3)]
    offsets = spark.createDataFrame([("orders", 0, 0), ("orders", 1, 2)], "topic string, partition int, current_offset long")
    ends = spark.createDataFrame([("orders", 0, 0), ("orders", 1, 2), ("orders", 2, 5)], "topic string, partition int, log_end_offset long")
    assert tuples(lag(offsets, ends), "partition", "lag") == [(0, 0), (1, 0), (2, 5)]


ROW = StructType([
    StructField("id", IntegerType()), StructField("customer_name", StringType()),
    StructField("status", StringType()), StructField("amount", StringType()),
])


def message(op, lsn, ts, before, after):
    side = lambda status: status and {"id": 1, "customer_name": "Alice", "status": status, "amount": "LxI="}
    source = {"connector": "postgresql", "db": "de_db", "table": "orders", "lsn": lsn}
    return json.dumps({"payload": {"before": side(before), "after": side(after), "source": source, "op": op, "ts_ms": ts}})


CREATED = message("c", 26861352, 1775148505849, None, "created")
PAID = message("u", 26861616, 1775148505851, "created", "paid")
GONE = message("d", 26861736, 1775148505851, "paid", None)


def parsed(spark, messages):
    df = spark.createDataFrame([(m,) for m in messages], "value string")
    return parse_change_events(df, ROW, {"amount": (12, 2)})


def test_change_events(spark):
    for messages in itertools.permutations([CREATED, PAID]):
        assert tuples(apply_changes(parsed(spark, messages), "id")) == [(1, "Alice", "paid", D("120.50"))]
    for messages in itertools.permutations([CREATED, PAID, GONE]):
        assert tuples(apply_changes(parsed(spark, messages), "id")) == []
    assert tuples(apply_changes(parsed(spark, [CREATED, PAID, PAID, "tombstone", "{}"]), "id"))[0][2] == "paid"
    deltas = change_delta(parsed(spark, [CREATED, PAID, GONE]), "amount")
    assert tuples(deltas, "op", "delta") == [("c", D("120.50")), ("d", D("-120.50")), ("u", D("0.00"))]


def test_stream_of_changes(spark, tmp_path):
    path, cp = str(tmp_path / "t"), str(tmp_path / "cp")

    def go():
        events = parse_change_events(read_event_files(spark, str(tmp_path / "in")), ROW, {"amount": (12, 2)})
        stream_changes(events, path, "id", cp).awaitTermination()
        return tuples(current_rows(spark, path), "status")

    land(tmp_path / "in", "1", [PAID])
    assert go() == [("paid",)]
    compact_changes(spark, path)
    land(tmp_path / "in", "2", [CREATED])
    assert go() == [("paid",)]
    land(tmp_path / "in", "3", [GONE])
    assert go() == []
    compact_changes(spark, path)
    land(tmp_path / "in", "4", [PAID])
    assert go() == []


def test_change_batches_equal_one_batch(spark, tmp_path):
    rng = random.Random(3)
    row = StructType([StructField("id", LongType()), StructField("v", LongType())])

    def msg(lsn):
        key, op = rng.randint(0, 20), rng.choice("cuud")
        image = {"id": key, "v": lsn}
        before, after = (image, None) if op == "d" else (None, image)
        return json.dumps({"payload": {"before": before, "after": after, "source": {"lsn": lsn}, "op": op, "ts_ms": 1}})

    messages = [msg(i) for i in range(200)]
    rng.shuffle(messages)
    path = str(tmp_path / "t")
    for i in range(3):
        land(tmp_path / "in", str(i), messages[i::3])
        events = parse_change_events(read_event_files(spark, str(tmp_path / "in")), row)
        stream_changes(events, path, "id", str(tmp_path / "cp")).awaitTermination()
    whole = parse_change_events(spark.createDataFrame([(m,) for m in messages], "value string"), row)
    same(current_rows(spark, path), apply_changes(whole, "id"))
