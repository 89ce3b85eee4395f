"""Streams over the events files, run until they are drained."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidemark import datasets, evolving, snapshots
from tidemark.operators.sample import last_not_null
from tidemark.plans.aggregates import daily_readings
from tidemark.plans.registry import plan, table
from tidemark.session import scratch_path
from tidemark.sinks.files import export_json
from tidemark.streaming import corrections, metrics, outbox
from tidemark.streaming.ingest import (
    append_stream,
    folder_per_batch,
    read_batches,
    read_stream,
    read_widened,
    retrying,
    to_all,
    widening_writer,
    write_batches,
)
from tidemark.streaming.sample import sample_stream
from tidemark.streaming.upsert import upsert_delta_stream, upsert_stream
from tidemark.timetable import PARTITION_COLUMN, TimeTable, read_time_table


def _events(spark, sf_dir):
    return read_stream(spark, f"{sf_dir}/events*.parquet", table(spark, sf_dir, "events").schema)


def _landings(spark, sf_dir, count):
    """The source after each of ``count`` batches of events has landed, dealt by event number, newest rest first.

    A batch is as many files as tasks wrote it; run until drained, a stream takes it as one micro-batch.
    """
    events, path = table(spark, sf_dir, "events"), scratch_path(spark, "landing")
    for i in range(count):
        events.where(F.col("event_id") % count == count - 1 - i).write.mode("append").parquet(path)
        yield read_stream(spark, path, events.schema)


@plan("SELECT * FROM events")
def stream_append(spark, sf_dir):
    path = scratch_path(spark, "stream-out")
    events = _events(spark, sf_dir)
    append_stream(events, path, scratch_path(spark, "stream-log")).awaitTermination()
    return spark.read.schema(events.schema).parquet(path)


@plan("""
    SELECT CAST(date_trunc('milliseconds', ts) AS TIMESTAMP) AS timestamp, concat('T', user_id) AS id, event_type AS exchange, event_id % 9 AS "quoteType",
           value AS price, 1::BIGINT AS "marketHours", value / 100 AS "changePercent", CAST(user_id AS DOUBLE) AS "dayVolume",
           CASE WHEN event_type <> 'error' THEN value / 10 END AS change, 2::BIGINT AS "priceHint"
    FROM events
""")
def stream_ticks(spark, sf_dir):
    """Ticks land as JSON records with times in milliseconds, twice; a stream appends them to a DAY table."""
    i, value, target = F.col("event_id"), F.col("value"), datasets.target("ticks")
    landing, path, log = scratch_path(spark, "ticks-json"), scratch_path(spark, "ticks"), scratch_path(spark, "stream-log")
    for batch in (0, 1):
        ticks = table(spark, sf_dir, "events").where(i % 2 == batch).select(
            F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp"),
            F.concat(F.lit("T"), "user_id").alias("id"),
            F.col("event_type").alias("exchange"),
            (i % 9).alias("quoteType"),
            value.alias("price"),
            F.lit(1).cast("bigint").alias("marketHours"),
            (value / 100).alias("changePercent"),
            F.col("user_id").cast("double").alias("dayVolume"),
            F.when(F.col("event_type") != "error", value / 10).alias("change"),
            F.lit(2).cast("bigint").alias("priceHint"),
        )
        export_json(ticks, f"{landing}/{batch}")
        typed = datasets.ticks(read_stream(spark, f"{landing}/*", ticks.schema, "json"))
        append_stream(target.stamp(typed), path, log, partition_by=target.partition_columns).awaitTermination()
    stored = read_time_table(spark, path, target).drop(PARTITION_COLUMN)
    return stored.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def _by_day(spark, sf_dir):
    readings = daily_readings(table(spark, sf_dir, "events"))
    return TimeTable(readings.schema, ts="day", unit="DAY", keys=("day", "user_id", "event_type"))


_LAST_BATCH = """
    SELECT * FROM (SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, user_id, event_type, value, event_id FROM events)
    QUALIFY row_number() OVER (PARTITION BY day, user_id, event_type ORDER BY event_id % 4, event_id DESC) = 1
"""


@plan(_LAST_BATCH)
def stream_upsert_delta(spark, sf_dir):
    """The same four batches as small sorted parts, merged by the reader and by a compaction after the third."""
    target, path, log = _by_day(spark, sf_dir), scratch_path(spark, "stream-delta"), scratch_path(spark, "stream-log")
    for events in _landings(spark, sf_dir, 4):
        upsert_delta_stream(daily_readings(events), path, target, ["event_id"], log, compact_every=3).awaitTermination()
    return snapshots.read(spark, path, target).drop(PARTITION_COLUMN)


@plan(_LAST_BATCH)
def stream_upsert(spark, sf_dir):
    """Four batches by event number, each over all days: what a later one brings wins, however old its day."""
    target, path, log = _by_day(spark, sf_dir), scratch_path(spark, "stream-upsert"), scratch_path(spark, "stream-log")
    for events in _landings(spark, sf_dir, 4):
        upsert_stream(daily_readings(events), path, target, ["event_id"], log).awaitTermination()
    return read_time_table(spark, path, target).drop(PARTITION_COLUMN)


@plan("SELECT * FROM events")
def stream_micro_batches(spark, sf_dir):
    """Six micro-batches, each of them a folder."""
    path, log = scratch_path(spark, "stream-batches"), scratch_path(spark, "stream-log")
    for events in _landings(spark, sf_dir, 6):
        write_batches(events, folder_per_batch(path), log).awaitTermination()
    return read_batches(spark, path)


@plan("SELECT * FROM events")
def stream_polled(spark, sf_dir):
    """A source that is looked at again and again until all its files have come."""
    path, query = scratch_path(spark, "stream-polled"), None
    for events in _landings(spark, sf_dir, 3):
        query = query or append_stream(events, path, scratch_path(spark, "stream-log"), {"processingTime": "0 seconds"})
        query.processAllAvailable()
    query.stop()
    return spark.read.schema(events.schema).parquet(path)


@plan("SELECT * FROM events")
def stream_replay(spark, sf_dir):
    """A write fails for good in the middle of a batch; started again, the stream loses and repeats nothing."""
    path, log = scratch_path(spark, "stream-replay"), scratch_path(spark, "stream-log")
    put, failures = folder_per_batch(path), []

    def fragile(batch, batch_id):
        put(batch.limit(1) if batch_id == 2 and not failures else batch, batch_id)
        if batch_id == 2 and not failures:
            failures.append(batch_id)
            raise OSError("the sink went away")

    for events in _landings(spark, sf_dir, 4):
        try:
            write_batches(events, fragile, log).awaitTermination()
        except StreamingQueryException:
            write_batches(events, fragile, log).awaitTermination()
    return read_batches(spark, path)


@plan("""
    SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS ts, user_id, last(value ORDER BY ts, event_id) AS value
    FROM events GROUP BY 1, 2
    HAVING CAST(date_trunc('hour', first(events.ts)) AS TIMESTAMP) + INTERVAL 1 HOUR
           <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 10 MINUTE FROM events)
""")
def stream_sample_by(spark, sf_dir):
    """Buckets the watermark has passed; the newest ones stay open."""
    last = last_not_null("value", F.struct("ts", "event_id")).alias("value")
    sampled = sample_stream(_events(spark, sf_dir), "ts", "1 hour", ["user_id"], [last], late="10 minutes")
    path = scratch_path(spark, "stream-sample")
    append_stream(sampled, path, scratch_path(spark, "stream-log")).awaitTermination()
    return spark.read.schema(sampled.schema).parquet(path)


@plan("SELECT 'first' AS sink, event_id, value FROM events UNION ALL SELECT 'second', event_id, value FROM events")
def stream_two_sinks(spark, sf_dir):
    """The same rows to two sinks, each write repeated if it fails."""
    rows = _events(spark, sf_dir).select("event_id", "value")
    paths = {name: scratch_path(spark, f"stream-{name}") for name in ("first", "second")}
    write = to_all(*[retrying(folder_per_batch(p)) for p in paths.values()])
    write_batches(rows, write, scratch_path(spark, "stream-log")).awaitTermination()
    first, second = [read_batches(spark, p).withColumn("sink", F.lit(name)) for name, p in paths.items()]
    return first.unionByName(second).select("sink", "event_id", "value")


@plan("""
    SELECT CASE WHEN event_type <> 'click' THEN event_id END AS event_id, CASE WHEN event_type <> 'click' THEN value END AS value,
           CASE WHEN event_type = 'error' THEN user_id END AS new_column,
           CASE WHEN event_type = 'click' THEN concat('{"event_id":"x', event_id, '"') END AS _corrupt_record
    FROM events
""")
def stream_new_column(spark, sf_dir):
    """Error records carry a column that the table does not know yet; click records are broken and keep their text."""
    extra = F.when(F.col("event_type") == "error", F.col("user_id")).alias("new_column")
    broken = F.concat(F.lit('{"event_id":"x'), "event_id", F.lit('"'))
    record = F.when(F.col("event_type") == "click", broken).otherwise(F.to_json(F.struct("event_id", "value", extra)))
    path, known, log = scratch_path(spark, "stream-wide"), {"event_id": "bigint", "value": "double"}, scratch_path(spark, "stream-log")
    for events in _landings(spark, sf_dir, 3):
        write_batches(events.select(record.alias("record")), widening_writer(path, "record", known), log).awaitTermination()
    return read_widened(spark, path, known)


@plan("SELECT 'steady' AS sink, event_id, value FROM events UNION ALL SELECT 'shaky', event_id, value FROM events")
def stream_outbox(spark, sf_dir):
    """Two sinks, one of them down for three of four batches: the stream goes on, and it gets what it missed."""
    path, log = scratch_path(spark, "outbox"), scratch_path(spark, "stream-log")
    targets = {name: scratch_path(spark, f"sink-{name}") for name in ("steady", "shaky")}
    attempts, put = [], folder_per_batch(targets["shaky"])

    def shaky(batch, batch_id):
        attempts.append(batch_id)
        if len(attempts) <= 3:
            raise OSError("the sink is down")
        put(batch, batch_id)

    sinks = {"steady": folder_per_batch(targets["steady"]), "shaky": shaky}
    for events in _landings(spark, sf_dir, 4):
        write_batches(events.select("event_id", "value"), outbox.outbox_writer(path, sinks), log).awaitTermination()
    told = [read_batches(spark, p).withColumn("sink", F.lit(name)) for name, p in targets.items()]
    return told[0].unionByName(told[1]).select("sink", "event_id", "value")


@plan("""
    SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS ts, user_id, count(value) AS readings, min(value) AS low, max(value) AS high,
           last(value ORDER BY ts, event_id) AS value
    FROM events GROUP BY 1, 2
""")
def stream_corrections(spark, sf_dir):
    """Every bucket as its newest correction has it; each of four batches is spread over all times."""
    kept = [
        corrections.Kept("readings", "count", "value"),
        corrections.Kept("low", "min", "value"),
        corrections.Kept("high", "max", "value"),
        corrections.Kept("value", "last", "value", ("ts", "event_id")),
    ]
    layout = corrections.buckets(table(spark, sf_dir, "events"), "ts", "1h", ["user_id"], kept)
    path, log = scratch_path(spark, "corrected"), scratch_path(spark, "stream-log")
    for events in _landings(spark, sf_dir, 4):
        corrections.sample_corrected(events, path, layout, "1h", log, compact_every=3).awaitTermination()
    return corrections.newest_corrections(spark, path, layout)


@plan("""
    SELECT CASE WHEN event_id % 3 = 2 THEN event_id ELSE event_id * 10000000000 END AS number, CASE WHEN event_id % 3 = 0 THEN value ELSE event_id + 0.5 END::DOUBLE AS size,
           CASE WHEN event_id % 3 = 0 THEN event_type END AS kind
    FROM events
""")
def stream_evolving(spark, sf_dir):
    """Three batches: an int column turns bigint, a float column double, and a third column appears."""
    path, log, i = scratch_path(spark, "evolving"), scratch_path(spark, "stream-log"), F.col("event_id")
    half = i + F.lit(0.5).cast("double")
    batches = [
        [i.cast("int").alias("number"), half.cast("float").alias("size")],
        [(i * 10_000_000_000).alias("number"), half.cast("float").alias("size")],
        [(i * 10_000_000_000).alias("number"), F.col("value").alias("size"), F.col("event_type").alias("kind")],
    ]
    for events, columns in zip(_landings(spark, sf_dir, 3), batches):
        write_batches(events.select(*columns), evolving.evolving_writer(path), log).awaitTermination()
    return evolving.read(spark, path)


@plan("SELECT sum(n)::BIGINT AS rows, count(*) AS batches, true AS timed FROM (SELECT event_id % 3 AS b, count(*) AS n FROM events GROUP BY 1)")
def stream_metrics(spark, sf_dir):
    """What a listener noted of three batches, summed up."""
    path, out, log = scratch_path(spark, "metrics"), scratch_path(spark, "stream-out"), scratch_path(spark, "stream-log")
    listener = metrics.BatchMetrics(spark, path)
    spark.streams.addListener(listener)
    try:
        for events in _landings(spark, sf_dir, 3):
            query = write_batches(metrics.observed(events, "ts"), folder_per_batch(out), log)
            query.awaitTermination()
            listener.finished(query)
    finally:
        spark.streams.removeListener(listener)
    noted = metrics.read_metrics(spark, path)
    timed = F.every((F.col("seconds") > 0) & (F.col("lag_seconds") > 0))
    return noted.agg(F.sum("rows").alias("rows"), F.count("*").alias("batches"), timed.alias("timed"))
