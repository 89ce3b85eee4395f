"""Streams: replays, retries, late rows and new columns."""

import pytest
from pyspark.sql import functions as F

from tidemark.session import scratch_path
from tidemark.streaming.ingest import (
    append_stream,
    default_time,
    folder_per_batch,
    read_batches,
    read_stream,
    read_widened,
    retrying,
    to_all,
    widen,
    widening_writer,
    write_batches,
)
from tidemark.streaming.upsert import upsert_stream, upsert_writer
from tidemark.timetable import TimeTable, read_time_table

SCHEMA = "ts timestamp, k string, v int"


def land(spark, folder, rows):
    """One more file in the source folder."""
    df = spark.createDataFrame(rows, "ts string, k string, v int").withColumn("ts", F.col("ts").cast("timestamp"))
    df.coalesce(1).write.mode("append").parquet(folder)


def test_upsert_stream_over_several_batches_with_late_rows(spark):
    source, path, log = (scratch_path(spark, n) for n in ("src", "out", "log"))
    table = TimeTable(spark.createDataFrame([], SCHEMA).schema, ts="ts", unit="DAY", keys=("ts", "k"))
    batches = [
        [("2024-01-01 00:00:00", "a", 1), ("2024-01-02 00:00:00", "a", 2)],
        [("2024-01-05 00:00:00", "b", 3)],
        [("2024-01-01 00:00:00", "a", 9), ("2024-01-05 00:00:00", "b", 8)],
    ]
    for rows in batches:
        land(spark, source, rows)
        upsert_stream(read_stream(spark, source, SCHEMA, max_files=1), path, table, ["v"], log).awaitTermination()
    got = sorted((str(r["ts"])[:10], r["k"], r["v"]) for r in read_time_table(spark, path, table).collect())
    assert got == [("2024-01-01", "a", 9), ("2024-01-02", "a", 2), ("2024-01-05", "b", 8)]


def test_upsert_replay_changes_nothing(spark):
    path = scratch_path(spark, "out")
    batch = spark.createDataFrame([("2024-01-01", "a", 1)], "ts string, k string, v int").withColumn("ts", F.col("ts").cast("timestamp"))
    write = upsert_writer(path, TimeTable(batch.schema, ts="ts", unit="DAY", keys=("ts", "k")), ["v"])
    write(batch, 0)
    write(batch, 0)
    assert spark.read.parquet(path).count() == 1


def test_append_stream_picks_up_new_files_once(spark):
    source, path, log = (scratch_path(spark, n) for n in ("src", "out", "log"))
    for i in range(3):
        land(spark, source, [("2024-01-01", "a", i)])
        append_stream(read_stream(spark, source, SCHEMA), path, log).awaitTermination()
    assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == [0, 1, 2]


def test_failing_sink_is_retried_in_place(spark):
    path, calls = scratch_path(spark, "out"), []
    put = folder_per_batch(path)

    def flaky(batch, batch_id):
        calls.append(batch_id)
        put(batch, batch_id)
        if len(calls) < 3:
            raise IOError("sink is down")

    retrying(flaky, attempts=3, delay_seconds=0.01)(spark.range(5), 0)
    assert len(calls) == 3 and read_batches(spark, path).count() == 5


def test_failed_query_restarts_without_loss_or_copies(spark):
    source, path, log = (scratch_path(spark, n) for n in ("src", "out", "log"))
    land(spark, source, [("2024-01-01", "a", 1), ("2024-01-01", "b", 2)])
    put, state = folder_per_batch(path), {"broken": True}

    def write(batch, batch_id):
        put(batch, batch_id)
        if state["broken"]:
            raise IOError("lost connection after the write")

    stream = read_stream(spark, source, SCHEMA)
    with pytest.raises(Exception):
        write_batches(stream, retrying(write, attempts=1), log).awaitTermination()
    state["broken"] = False
    land(spark, source, [("2024-01-01", "c", 3)])
    write_batches(stream, write, log).awaitTermination()
    assert sorted(r["v"] for r in read_batches(spark, path).collect()) == [1, 2, 3]


def test_several_sinks_see_the_same_rows(spark):
    one, two = scratch_path(spark, "one"), scratch_path(spark, "two")
    to_all(folder_per_batch(one), folder_per_batch(two))(spark.range(10).select(F.rand().alias("r")), 0)
    assert read_batches(spark, one).exceptAll(read_batches(spark, two)).count() == 0


def test_a_column_that_appears_later_keeps_its_type_and_bad_records_their_text(spark):
    path = scratch_path(spark, "out")
    records = ['{"a": 1}', '{"a": 2, "demo": 5, "at": "x"}', '{"a": 3, "demo": "no number"}', "{broken", '{"a": "x", "f": 1.5}']
    for known in ({"a": "int"}, {"a": "int"}):
        # the second round replays every batch with a new writer
        write = widening_writer(path, "r", known)
        for i, record in enumerate(records):
            write(spark.createDataFrame([(record,)], "r string"), i)
    rows = read_widened(spark, path, {"a": "int"})
    assert dict(rows.dtypes) == {"a": "int", "_corrupt_record": "string", "at": "string", "demo": "bigint", "f": "double"}
    got = sorted(((r["a"], r["demo"], r["at"], r["_corrupt_record"]) for r in rows.collect()), key=str)
    want = [(1, None, None, None), (2, 5, "x", None), (3, None, None, records[2]), (None, None, None, "{broken"), (None, None, None, records[4])]
    assert got == sorted(want, key=str)


def test_columns_beyond_the_widest_table_stay_in_a_map(spark):
    record = '{"a": 1, "c0": 1, "c1": 2, "c2": 3}'
    row = widen(spark.createDataFrame([(record,)], "r string"), "r", {"a": "int"}, widest=2).first()
    assert (row["a"], row["c0"], row["c1"], row["_more"]) == (1, 1, 2, {"c2": "3"})


def test_upsert_stream_without_dedup_appends_once(spark):
    source, path, log = (scratch_path(spark, n) for n in ("src", "out", "log"))
    land(spark, source, [("2024-01-01", "a", 1), ("2024-01-01", "a", 1)])
    stream = read_stream(spark, source, SCHEMA)
    table = TimeTable(stream.schema, ts="ts", unit="DAY", keys=("ts", "k"), dedup=False)
    for _ in range(2):
        upsert_stream(stream, path, table, ["v"], log).awaitTermination()
    assert spark.read.parquet(path).count() == 2


def test_rows_without_a_time_get_the_batch_time(spark):
    df = spark.createDataFrame([(None, "a", 1)], SCHEMA)
    assert default_time(df, "ts").first()["ts"] is not None


def test_polling_takes_a_bounded_number_of_files_per_batch(spark):
    source, path, log = (scratch_path(spark, n) for n in ("src", "out", "log"))
    for i in range(3):
        land(spark, source, [("2024-01-01", "a", i)])
    sizes = []

    def write(batch, batch_id):
        sizes.append(batch.count())

    stream = read_stream(spark, source, SCHEMA, max_files=1)
    query = write_batches(stream, write, log, trigger={"processingTime": "100 milliseconds"})
    try:
        query.processAllAvailable()
        land(spark, source, [("2024-01-02", "b", 9)])
        query.processAllAvailable()
    finally:
        query.stop()
    assert sizes == [1, 1, 1, 1]
