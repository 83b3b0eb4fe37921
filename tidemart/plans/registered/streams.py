"""Streams, message logs and change events fed from the events table."""

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from tidemart.functions.scalars import decode_decimal
from tidemart.operators.changes import apply_changes, change_delta, parse_change_events
from tidemart.operators.ordered import row_numbers
from tidemart.operators.quality import in_set, not_null, row_count_between, unique
from tidemart.plans.registered.base import events, query, table
from tidemart.sources.scratch import scratch_path
from tidemart.sources.tables import read_table
from tidemart.streaming.changes import add_changes, compact_changes, current_rows, stream_changes
from tidemart.streaming.gate import stream_gated
from tidemart.streaming.ordering import in_order, rocksdb
from tidemart.streaming.sources import accepted, event_time, parse_json, read_event_files, read_parquet_stream, rejected
from tidemart.streaming.windows import lag, order_within_partition, windowed_orders, write_stream_parquet

EVENT = StructType([
    StructField("event_id", LongType()), StructField("user_id", LongType()),
    StructField("value", DoubleType()), StructField("event_time", StringType()),
])
WINDOWS = "window struct<start: timestamp, end: timestamp>, user_id long, total_orders long, total_amount double"


def event_json(spark, sf) -> DataFrame:
    """Events as JSON text; errors are not JSON."""
    body = F.to_json(F.struct("event_id", "user_id", "value", F.col("ts").cast("string").alias("event_time")))
    kind = F.col("event_type")
    return events(spark, sf).select(F.when(kind == "error", F.concat(F.lit("error "), "event_id")).otherwise(body).alias("value"))


@query("SELECT event_id, user_id, value, epoch_us(ts) AS event_time FROM events WHERE event_type <> 'error'")
def json_messages(spark, sf):
    return accepted(parse_json(event_json(spark, sf), EVENT, rejects=True))


@query("SELECT 'error ' || CAST(event_id AS VARCHAR) AS value FROM events WHERE event_type = 'error'")
def rejected_messages(spark, sf):
    return rejected(parse_json(event_json(spark, sf), EVENT, rejects=True))


def _windows(spark, stream: DataFrame, label: str) -> DataFrame:
    out, checkpoint = scratch_path(spark, label), scratch_path(spark, f"{label}-checkpoint")
    grouped = windowed_orders(stream, "user_id", "value")
    write_stream_parquet(grouped, out, checkpoint).awaitTermination()
    return spark.read.schema(WINDOWS).parquet(out).select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "user_id", "total_orders",
        F.round("total_amount", 2).alias("total_amount"),
    )


_WINDOWS = """SELECT epoch_us(w) AS window_start, epoch_us(w + INTERVAL 5 MINUTE) AS window_end, user_id, count(*) AS total_orders,
 round(sum(value), 2) AS total_amount FROM (SELECT *, time_bucket(INTERVAL 5 MINUTE, ts) AS w, max(ts) OVER () AS latest
 FROM events WHERE {kept}) e WHERE w + INTERVAL 5 MINUTE <= latest - INTERVAL 5 MINUTE GROUP BY w, user_id"""


@query(_WINDOWS.format(kept="TRUE"))
def stream_windows(spark, sf):
    schema = table(spark, sf, "events").schema
    stream = read_parquet_stream(spark, f"{sf}/events.parquet*", schema).withColumn("event_time", event_time("ts"))
    return _windows(spark, stream, "windows")


@query(_WINDOWS.format(kept="event_type <> 'error'"))
def stream_windows_json(spark, sf):
    landed = scratch_path(spark, "landed-events")
    event_json(spark, sf).write.text(landed)
    return _windows(spark, parse_json(read_event_files(spark, landed), EVENT), "json-windows")


#: Fixed times: where the events are cut into two landings, and up to when they arrive once more, late.
CUT, LATE = "2024-01-16", "2024-01-03"


@query(_WINDOWS.format(kept="TRUE"))
def stream_windows_late(spark, sf):
    """Two landings, a restart from the checkpoint between them, and late events that no longer count."""
    landed, out, checkpoint = (scratch_path(spark, n) for n in ("landed", "late-windows", "late-checkpoint"))
    rows = events(spark, sf)
    before = lambda day: F.col("ts") < F.lit(day).cast("timestamp")
    for part in (rows.filter(before(CUT)), rows.filter(~before(CUT)).unionByName(rows.filter(before(LATE)))):
        part.repartition(2).write.mode("append").parquet(landed)
        stream = read_parquet_stream(spark, landed, rows.schema).withColumn("event_time", event_time("ts"))
        write_stream_parquet(windowed_orders(stream, "user_id", "value"), out, checkpoint).awaitTermination()
    return spark.read.schema(WINDOWS).parquet(out).select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "user_id", "total_orders",
        F.round("total_amount", 2).alias("total_amount"),
    )


@query(_WINDOWS.format(kept="TRUE"))
def stream_windows_repeats(spark, sf):
    """Four landings in time order, each of which arrives twice."""
    landed, out, checkpoint = (scratch_path(spark, n) for n in ("twice", "repeat-windows", "repeat-checkpoint"))
    rows = events(spark, sf)
    day = F.dayofmonth("ts")
    for low, high in ((0, 8), (8, 16), (16, 24), (24, 40)):
        for _ in range(2):
            rows.filter((day >= low) & (day < high)).coalesce(1).write.mode("append").parquet(landed)
    stream = read_parquet_stream(spark, landed, rows.schema, max_files=1).withColumn("event_time", event_time("ts"))
    grouped = windowed_orders(stream, "user_id", "value", once=["event_id"])
    write_stream_parquet(grouped, out, checkpoint).awaitTermination()
    return spark.read.schema(WINDOWS).parquet(out).select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "user_id", "total_orders",
        F.round("total_amount", 2).alias("total_amount"),
    )


def numbered_log(spark, sf) -> DataFrame:
    """Events as messages with offsets 0, 1, 2 ... per topic and partition, in event order."""
    rows = events(spark, sf).select(
        F.col("event_type").alias("topic"), (F.col("user_id") % 4).cast("int").alias("partition"), "event_id",
        F.col("ts").alias("timestamp"), F.col("event_id").cast("string").alias("value"),
    )
    placed = row_numbers(rows, ["topic", "partition"], [F.col("timestamp"), F.col("event_id")], "n")
    return placed.select("topic", "partition", (F.col("n") - 1).cast("long").alias("offset"), "timestamp", "value", "event_id")


@query("""WITH log AS (SELECT event_type AS topic, user_id % 4 AS partition, event_id, ts,
  row_number() OVER (PARTITION BY event_type, user_id % 4 ORDER BY ts, event_id) - 1 AS o, max(ts) OVER () AS newest FROM events),
 sent AS (SELECT *, max(CASE WHEN o = 6 THEN ts END) OVER (PARTITION BY topic, partition) AS after_hole FROM log WHERE o <> 5)
 SELECT topic, partition, o AS "offset", CAST(event_id AS VARCHAR) AS value,
  row_number() OVER (PARTITION BY topic, partition ORDER BY o) AS position, CASE WHEN o = 6 THEN 1 ELSE 0 END AS skipped
 FROM sent WHERE o < 5 OR after_hole <= newest - INTERVAL 12 DAY""")
def stream_in_order(spark, sf):
    """Landings in which messages come up to two landings late, one offset of each partition never comes, and some come twice."""
    landed, out, checkpoint = (scratch_path(spark, n) for n in ("log", "ordered", "ordered-checkpoint"))
    log = numbered_log(spark, sf).filter("offset <> 5")
    landing = F.floor(F.dayofmonth("timestamp") / 5) + F.col("event_id") % 2
    again = log.filter("offset % 10 = 3").withColumn("landing", F.floor(F.dayofmonth("timestamp") / 5) + 1)
    sent = log.withColumn("landing", landing).unionByName(again).drop("event_id")
    sent.write.partitionBy("landing").parquet(f"{landed}-all")
    for number in range(0, 8):
        part = spark.read.parquet(f"{landed}-all").filter(F.col("landing") == number).drop("landing")
        part.orderBy(F.xxhash64("value")).coalesce(1).write.mode("append").parquet(landed)
    schema = sent.drop("landing").schema
    stream = in_order(read_parquet_stream(spark, landed, schema, max_files=1), patience="12 days")
    with rocksdb(spark):
        write_stream_parquet(stream, out, checkpoint).awaitTermination()
    return spark.read.parquet(out).select("topic", "partition", "offset", "value", "position", "skipped")


#: Fixed times: where the events are cut into three landings, of which the last holds errors.
GATE_CUTS = ("2024-01-11", "2024-01-21")


@query("""SELECT CASE WHEN ts < TIMESTAMP '2024-01-21' THEN 'published' ELSE 'quarantined' END AS state, event_id,
 CASE WHEN ts >= TIMESTAMP '2024-01-21' THEN 2 END AS batch, CASE WHEN ts >= TIMESTAMP '2024-01-21' THEN 1 END AS reasons
 FROM events WHERE event_type <> 'error' OR ts >= TIMESTAMP '2024-01-21'""")
def gated_stream(spark, sf):
    """Three landings through the gate; the last one fails, is set aside and stops the stream."""
    landed, path, aside, checkpoint = (scratch_path(spark, n) for n in ("gate-landed", "gate", "quarantine", "gate-checkpoint"))
    rows = events(spark, sf)
    before = [F.col("ts") < F.lit(cut).cast("timestamp") for cut in GATE_CUTS]
    good = F.col("event_type") != "error"
    for part in (before[0] & good, ~before[0] & before[1] & good, ~before[1]):
        rows.filter(part).coalesce(1).write.mode("append").parquet(landed)
    kinds = ["view", "click", "purchase", "signup"]
    suite = [not_null("event_id"), unique("event_id"), in_set("event_type", kinds), row_count_between(1, 100_000_000_000)]
    try:
        stream_gated(read_parquet_stream(spark, landed, rows.schema, max_files=1), suite, path, aside, checkpoint).awaitTermination()
    except StreamingQueryException as stopped:
        if "QualityGateFailed" not in str(stopped):
            raise
    published = read_table(spark, path).select(
        F.lit("published").alias("state"), "event_id", F.lit(None).cast("long").alias("batch"), F.lit(None).cast("long").alias("reasons")
    )
    return published.unionByName(read_table(spark, aside).select(
        F.lit("quarantined").alias("state"), "event_id", F.col("_batch").alias("batch"), F.size("_reasons").cast("long").alias("reasons")
    ))


def message_log(spark, sf) -> DataFrame:
    return events(spark, sf).select(
        F.col("event_type").alias("topic"), F.col("user_id").cast("int").alias("partition"),
        F.col("event_id").alias("offset"), "ts",
    )


@query("SELECT event_type AS topic, user_id AS partition, event_id AS \"offset\" FROM events ORDER BY 1, 2, 3")
def order_within_partitions(spark, sf):
    return order_within_partition(message_log(spark, sf)).select("topic", "partition", "offset")


@query("""SELECT event_type AS topic, user_id AS partition, count(*) AS log_end_offset,
 nullif(count_if(ts < TIMESTAMP '2024-01-20'), 0) AS current_offset, count_if(ts >= TIMESTAMP '2024-01-20') AS lag
 FROM events GROUP BY 1, 2""")
def consumer_lag(spark, sf):
    log = message_log(spark, sf)
    ends = log.groupBy("topic", "partition").agg(F.count(F.lit(1)).alias("log_end_offset"))
    read = log.filter(F.col("ts") < F.lit("2024-01-20").cast("timestamp"))
    return lag(read.groupBy("topic", "partition").agg(F.count(F.lit(1)).alias("current_offset")), ends)


# --- change events: one row per user; sign-ups create, errors delete, the rest updates ------------

ROW = StructType([
    StructField("id", LongType()), StructField("status", StringType()), StructField("amount", StringType()),
])
DECIMALS = {"amount": (18, 2)}


def encoded(cents) -> F.Column:
    """A whole number as base64 of its eight big-endian bytes."""
    return F.base64(F.unhex(F.lpad(F.hex(cents.cast("long")), 16, "0")))


def change_json(spark, sf) -> DataFrame:
    """Events as change messages; amounts of clicks are negative."""
    kind = F.col("event_type")
    cents = F.round(F.col("value") * 100).cast("long") * F.when(kind == "click", -1).otherwise(1)
    row = F.struct(F.col("user_id").alias("id"), kind.alias("status"), encoded(cents).alias("amount"))
    op = F.when(kind == "signup", "c").when(kind == "error", "d").otherwise("u")
    payload = F.struct(
        F.when(op != "c", row).alias("before"),
        F.when(op != "d", row).alias("after"),
        F.struct(F.lit("postgresql").alias("connector"), F.lit("shop").alias("db"), F.lit("orders").alias("table"), F.col("event_id").alias("lsn")).alias("source"),
        op.alias("op"),
        F.unix_millis("ts").alias("ts_ms"),
    )
    return events(spark, sf).select(F.to_json(F.struct(payload.alias("payload"))).alias("value"))


_SIGNED = "CASE WHEN event_type = 'click' THEN -value ELSE value END"


@query(f"""SELECT user_id AS id, event_type AS status, {_SIGNED} AS amount FROM (SELECT *, ROW_NUMBER() OVER
 (PARTITION BY user_id ORDER BY event_id DESC) AS n FROM events) t WHERE n = 1 AND event_type <> 'error'""")
def change_table(spark, sf):
    return apply_changes(parse_change_events(change_json(spark, sf), ROW, DECIMALS), "id")


@query(f"""SELECT event_id AS lsn, CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op,
 CASE event_type WHEN 'signup' THEN value WHEN 'error' THEN -value ELSE 0.0 END AS delta FROM events""")
def change_deltas(spark, sf):
    parsed = parse_change_events(change_json(spark, sf), ROW, DECIMALS)
    return change_delta(parsed, "amount").select("lsn", "op", "delta")


@query(f"""SELECT user_id AS id, event_type AS status, {_SIGNED} AS amount FROM (SELECT *, ROW_NUMBER() OVER
 (PARTITION BY user_id ORDER BY event_id DESC) AS n FROM events) t WHERE n = 1 AND event_type <> 'error'""")
def change_stream(spark, sf):
    landed, path = scratch_path(spark, "landed-changes"), scratch_path(spark, "change-table")
    change_json(spark, sf).repartition(4).write.text(landed)
    stream = parse_change_events(read_event_files(spark, landed, max_files=2), ROW, DECIMALS)
    stream_changes(stream, path, "id", scratch_path(spark, "change-checkpoint")).awaitTermination()
    compact_changes(spark, path)
    return current_rows(spark, path)


@query(f"""SELECT user_id AS id, event_type AS status, {_SIGNED} AS amount FROM (SELECT *, ROW_NUMBER() OVER
 (PARTITION BY user_id ORDER BY event_id DESC) AS n FROM events) t WHERE n = 1 AND event_type <> 'error'""")
def change_stream_restart(spark, sf):
    """Half of the events, a fold, and the other half by a stream that starts with a new checkpoint."""
    path = scratch_path(spark, "restarted-changes")
    parsed = change_json(spark, sf)
    lsn = F.get_json_object("value", "$.payload.source.lsn").cast("long")
    for half in (0, 1):
        landed = scratch_path(spark, "landed-half")
        parsed.filter((lsn % 2) == half).repartition(2).write.text(landed)
        stream = parse_change_events(read_event_files(spark, landed, max_files=1), ROW, DECIMALS)
        stream_changes(stream, path, "id", scratch_path(spark, "half-checkpoint")).awaitTermination()
        if half == 0:
            compact_changes(spark, path)
    return current_rows(spark, path)


@query(f"""SELECT user_id AS id, event_type AS status, {_SIGNED} AS amount FROM (SELECT *, ROW_NUMBER() OVER
 (PARTITION BY user_id ORDER BY event_id DESC) AS n FROM events WHERE event_id % 3 < 2 OR user_id % 10 < 2) t
 WHERE n = 1 AND event_type <> 'error' AND user_id % 4 = 1""")
def change_table_buckets(spark, sf):
    """Three loads of changes, the last for a few keys, folds of the buckets they touch, and a read of some keys."""
    path, parsed = scratch_path(spark, "bucketed-changes"), parse_change_events(change_json(spark, sf), ROW, DECIMALS)
    key = F.coalesce("after.id", "before.id")
    for load, part in enumerate((F.col("lsn") % 3 == 0, F.col("lsn") % 3 == 1, (F.col("lsn") % 3 == 2) & (key % 10 < 2))):
        add_changes(parsed.filter(part), path, "id", "loads", load, buckets=16)
        if load != 1:
            compact_changes(spark, path)
    asked = events(spark, sf).filter("user_id % 4 = 1").select(F.col("user_id").alias("key")).distinct()
    return current_rows(spark, path, asked)


@query(f"SELECT event_id, {_SIGNED} AS amount FROM events")
def base64_decimals(spark, sf):
    cents = F.round(F.col("value") * 100).cast("long") * F.when(F.col("event_type") == "click", -1).otherwise(1)
    coded = events(spark, sf).select("event_id", encoded(cents).alias("coded"))
    return coded.select("event_id", decode_decimal("coded", 18, 2).alias("amount"))
