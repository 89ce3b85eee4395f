"""Delta upserts, outboxes, metrics and corrections of streams."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark import snapshots
from tidemark.operators.sample import last_not_null, sample_by
from tidemark.operators.upsert import dedup_keep_last
from tidemark.session import scratch_path
from tidemark.streaming import corrections, metrics, outbox
from tidemark.streaming.ingest import folder_per_batch, read_batches, read_stream, write_batches
from tidemark.streaming.upsert import delta_writer, upsert_delta_stream
from tidemark.timetable import TimeTable

SCHEMA = "ts timestamp, k string, v int, n int"


def batch_of(spark, data):
    return spark.createDataFrame([(f"2024-01-{d:02} {h:02}:10:00", k, v, n) for d, h, k, v, n in data], "ts string, k string, v int, n int").withColumn(
        "ts", F.col("ts").cast("timestamp")
    )


def land(spark, folder, data):
    batch_of(spark, data).write.mode("append").parquet(folder)


def test_twenty_delta_batches_equal_keep_last(spark):
    rng, source, path, log = random.Random(1), *(scratch_path(spark, n) for n in ("src", "out", "log"))
    layout, seen = TimeTable(spark.createDataFrame([], SCHEMA).schema, ts="ts", unit="DAY", keys=("ts", "k")), []
    for n in range(20):
        data = [(rng.randint(1, 4), rng.randint(0, 3), rng.choice("ab"), rng.randrange(100), 10 * n + i) for i in range(4)]
        seen += data
        land(spark, source, data)
        upsert_delta_stream(read_stream(spark, source, SCHEMA), path, layout, ["n"], log, compact_every=5).awaitTermination()
    want = dedup_keep_last(batch_of(spark, seen), ["ts", "k"], ["n"])
    got = snapshots.read(spark, path, layout).select(*want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert snapshots.latest(spark, path).batches == {log: 19}


def test_a_replayed_delta_batch_is_left_out(spark):
    path = scratch_path(spark, "out")
    layout = TimeTable(spark.createDataFrame([], SCHEMA).schema, ts="ts", unit="DAY", keys=("ts", "k"))
    write = delta_writer(path, layout, ["n"])
    for number in (0, 0, 1):
        write(batch_of(spark, [(1, 1, "a", number, number)]), number)
    assert len(snapshots.latest(spark, path).parts) == 2


def test_a_sink_that_is_down_gets_what_it_missed(spark):
    source, path, log, one, two = (scratch_path(spark, n) for n in ("src", "outbox", "log", "one", "two"))
    down, put = [True], folder_per_batch(two)

    def fragile(batch, batch_id):
        if down[0]:
            put(batch.limit(1), batch_id)
            raise IOError("sink is down")
        put(batch, batch_id)

    sinks = {"one": folder_per_batch(one), "two": fragile}
    for n in range(4):
        down[0] = n < 3
        land(spark, source, [(1, n, "a", n, i) for i in range(3)])
        write_batches(read_stream(spark, source, SCHEMA), outbox.outbox_writer(path, sinks), log).awaitTermination()
        assert read_batches(spark, one).count() == 3 * (n + 1)
        assert outbox.waiting(spark, path, sinks) == {"one": 0, "two": n + 1 if n < 3 else 0}
    whole = sorted(map(str, spark.read.parquet(source).collect()))
    assert sorted(map(str, read_batches(spark, one).collect())) == whole == sorted(map(str, read_batches(spark, two).collect()))


def test_drain_after_the_stream_has_ended(spark):
    path, one, two = (scratch_path(spark, n) for n in ("outbox", "one", "two"))
    down = [True]

    def fragile(batch, batch_id):
        if down[0]:
            raise IOError("sink is down")
        folder_per_batch(two)(batch, batch_id)

    sinks = {"one": folder_per_batch(one), "two": fragile}
    write = outbox.outbox_writer(path, sinks)
    for number in (0, 1, 1, 2):
        write(batch_of(spark, [(1, number, "a", number, number)]).limit(number), number)
    assert outbox.drain(spark, path, sinks) == {"two": "sink is down"}
    down[0] = False
    assert outbox.drain(spark, path, sinks) == {}
    assert read_batches(spark, two).count() == read_batches(spark, one).count() == 2
    write(batch_of(spark, [(1, 1, "a", 1, 1)]), 2)
    assert read_batches(spark, two).count() == 2 and outbox.waiting(spark, path, sinks) == {"one": 0, "two": 0}


def test_metrics_add_up_to_the_source(spark):
    source, out, log, path = (scratch_path(spark, n) for n in ("src", "out", "log", "metrics"))
    listener = metrics.BatchMetrics(spark, path)
    spark.streams.addListener(listener)
    try:
        for n in range(3):
            land(spark, source, [(1, n, "a", n, i) for i in range(5 + n)])
            stream = metrics.observed(read_stream(spark, source, SCHEMA), "ts")
            query = write_batches(stream, folder_per_batch(out), log)
            query.awaitTermination()
            assert listener.finished(query)
    finally:
        spark.streams.removeListener(listener)
    rows = metrics.read_metrics(spark, path).collect()
    assert sorted((r["batch"], r["rows"]) for r in rows) == [(0, 5), (1, 6), (2, 7)]
    assert len({r["query"] for r in rows}) == 1 and all(r["seconds"] > 0 and r["lag_seconds"] > 365 * 86_400 for r in rows)


@pytest.mark.parametrize("every", ["1h", "1d"])
def test_corrections_equal_the_batch_sample(spark, every):
    rng, source, path, log = random.Random(3), *(scratch_path(spark, n) for n in ("src", "out", "log"))
    kept = [
        corrections.Kept("n", "count", "v"),
        corrections.Kept("total", "sum", "v"),
        corrections.Kept("low", "min", "v"),
        corrections.Kept("high", "max", "v"),
        corrections.Kept("v", "last", "v", ("ts", "n")),
    ]
    rows, seen = spark.createDataFrame([], SCHEMA), []
    layout = corrections.buckets(rows, "ts", every, ["k"], kept)
    for n in range(6):
        # days go backwards, so every batch is late for the one before
        data = [(rng.randint(1, 6 - n), rng.randint(0, 3), rng.choice(["a", "b", None]), rng.choice([None, 1, 5, 9]), 10 * n + i) for i in range(5)]
        seen += data
        land(spark, source, data)
        corrections.sample_corrected(read_stream(spark, source, SCHEMA), path, layout, every, log, compact_every=3).awaitTermination()
    aggs = [F.count("v").alias("n"), F.sum("v").alias("total"), F.min("v").alias("low"), F.max("v").alias("high")]
    want = sample_by(batch_of(spark, seen), "ts", every, ["k"], [*aggs, last_not_null("v", F.struct("ts", "n")).alias("v")])
    for got in (corrections.read_buckets(spark, path, layout), corrections.newest_corrections(spark, path, layout)):
        assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    assert corrections.read_corrections(spark, path, layout).count() > want.count()
