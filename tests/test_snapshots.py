"""Snapshot tables: concurrent writers, cut-off writes, deltas and compaction."""

import threading
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark import snapshots
from tidemark.operators.upsert import dedup_keep_last
from tidemark.session import create_once, folder_names, scratch_path
from tidemark.timetable import PARTITION_COLUMN, TimeTable

DAY = datetime(2024, 3, 1)
SCHEMA = "ts timestamp, k string, v int, arrival int"


def readings(spark, data):
    return spark.createDataFrame([(DAY + timedelta(hours=h), k, v, i) for i, (h, k, v) in enumerate(data)], SCHEMA)


@pytest.fixture
def layout(spark):
    return TimeTable(spark.createDataFrame([], SCHEMA).drop("arrival").schema, ts="ts", unit="DAY", keys=("ts", "k"))


def stored(spark, path, layout, version=None):
    rows = snapshots.read(spark, path, layout, version).collect()
    found = {(int((r["ts"] - DAY).total_seconds() // 3600), r["k"]): r["v"] for r in rows}
    assert len(found) == len(rows)
    return found


@pytest.mark.parametrize("put", [snapshots.upsert, snapshots.upsert_delta])
def test_every_snapshot_stays_readable(spark, layout, put):
    path = scratch_path(spark, "t")
    put(readings(spark, [(1, "a", 1), (1, "a", 2), (30, "a", 3)]), path, layout, ["arrival"])
    put(readings(spark, [(1, "a", 5), (2, None, 6)]), path, layout, ["arrival"])
    snapshots.truncate(spark, path)
    put(readings(spark, [(9, "z", 9)]), path, layout, ["arrival"])
    assert stored(spark, path, layout, 1) == {(1, "a"): 2, (30, "a"): 3}
    assert stored(spark, path, layout, 2) == {(1, "a"): 5, (2, None): 6, (30, "a"): 3}
    assert stored(spark, path, layout, 3) == {}
    assert stored(spark, path, layout) == {(9, "z"): 9}
    snapshots.drop(spark, path)
    assert snapshots.latest(spark, path).version == 0 and not snapshots.exists(spark, path)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.tuples(st.integers(0, 50), st.sampled_from("ab"), st.integers(0, 9)), min_size=1, max_size=6), min_size=1, max_size=5))
def test_any_mix_of_upserts_and_compactions_equals_a_dictionary(spark, layout, batches):
    path, expected = scratch_path(spark, "t"), {}
    for i, data in enumerate(batches):
        put = snapshots.upsert if i % 3 == 2 else snapshots.upsert_delta
        put(readings(spark, data), path, layout, ["arrival"])
        expected.update({(h, k): v for h, k, v in data})
        if i % 2:
            snapshots.compact(spark, path, layout, least=2, ratio=100)
    assert stored(spark, path, layout) == expected


def test_a_cut_off_write_changes_nothing(spark, layout, monkeypatch):
    path = scratch_path(spark, "t")
    snapshots.upsert(readings(spark, [(1, "a", 1), (30, "a", 3)]), path, layout, ["arrival"])

    def crash(*args):
        raise IOError("driver lost")

    with monkeypatch.context() as patched:
        patched.setattr(snapshots, "_commit", crash)
        for put in (snapshots.upsert, snapshots.upsert_delta):
            with pytest.raises(IOError):
                put(readings(spark, [(1, "a", 9), (31, "b", 8)]), path, layout, ["arrival"])
    assert stored(spark, path, layout) == {(1, "a"): 1, (30, "a"): 3}
    assert len(snapshots.expire(spark, path, unfinished_seconds=1e6)) == 0
    assert len(snapshots.expire(spark, path, unfinished_seconds=-1)) == 2
    assert stored(spark, path, layout) == {(1, "a"): 1, (30, "a"): 3}


@pytest.mark.parametrize("other", [[(1, "a", 7), (2, "c", 7)], [(60, "c", 7)]])
def test_a_writer_that_loses_its_number_loses_no_rows(spark, layout, monkeypatch, other):
    """Another upsert commits between the read and the commit: of the same partition, or of another one."""
    path = scratch_path(spark, "t")
    snapshots.upsert(readings(spark, [(1, "a", 1), (3, "d", 4)]), path, layout, ["arrival"])
    real, writes, done = snapshots._commit, [], []

    def late(spark_, path_, snapshot):
        if not done:
            done.append(1)
            snapshots.upsert(readings(spark, other), path, layout, ["arrival"])
        return real(spark_, path_, snapshot)

    write = snapshots._write
    monkeypatch.setattr(snapshots, "_commit", late)
    monkeypatch.setattr(snapshots, "_write", lambda *a, **k: writes.append(1) or write(*a, **k))
    snapshots.upsert(readings(spark, [(1, "a", 9), (2, "b", 8)]), path, layout, ["arrival"])
    expected = {(1, "a"): 1, (3, "d"): 4} | {(h, k): v for h, k, v in other} | {(1, "a"): 9, (2, "b"): 8}
    assert stored(spark, path, layout) == expected
    # merged again only if its own partition had changed
    assert len(writes) == (3 if other[0][0] == 1 else 2)


def test_concurrent_upserts_lose_none(spark, layout):
    path = scratch_path(spark, "t")
    batches = [[(h, f"k{i}", i) for h in (1, 2, 30)] for i in range(4)]
    threads = [
        threading.Thread(target=put, args=(readings(spark, data), path, layout, ["arrival"]))
        for data, put in zip(batches, [snapshots.upsert, snapshots.upsert, snapshots.upsert_delta, snapshots.upsert_delta])
    ]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert stored(spark, path, layout) == {(h, k): v for data in batches for h, k, v in data}
    assert snapshots.latest(spark, path).version == 4


def test_one_of_several_writers_gets_a_number(spark):
    path = f"{scratch_path(spark, 'n')}/x.json"
    assert [create_once(spark, path, str(i)) for i in range(3)] == [True, False, False]
    assert spark.read.text(path).first()["value"] == "0"


def test_a_repeated_batch_is_taken_once(spark, layout):
    path = scratch_path(spark, "t")
    rows = readings(spark, [(1, "a", 1)])
    for number in (0, 0, 1, 0):
        snapshots.append(rows, path, layout, ("s", number))
    assert snapshots.latest(spark, path).version == 2
    assert snapshots.latest(spark, path).batches == {"s": 1}


def test_deltas_write_what_the_batch_holds_and_compaction_is_logarithmic(spark, layout):
    path = scratch_path(spark, "t")
    base = spark.range(20_000).select(
        F.timestamp_seconds(F.lit(1709251200) + F.col("id") % 86_400).alias("ts"), F.concat(F.lit("k"), "id").alias("k"), F.col("id").cast("int").alias("v"), F.lit(0).alias("arrival")
    )
    snapshots.upsert_delta(base, path, layout, ["arrival"])
    whole = sum(p.bytes for p in snapshots.latest(spark, path).parts)
    written, before = 0, set()
    for i in range(20):
        snapshots.upsert_delta(readings(spark, [(i % 24, "a", i), (i % 5, "b", i)]), path, layout, ["arrival"])
        snapshots.compact(spark, path, layout)
        parts = snapshots.latest(spark, path).parts
        written += sum(p.bytes for p in parts if p not in before and p.bytes < whole / 2)
        before = set(parts)
        # the large part is never written again
        assert max(p.bytes for p in parts) == whole and len(parts) <= 12
    assert written < whole
    got = dedup_keep_last(snapshots.read(spark, path, layout), ["ts", "k"], ["v"])
    assert got.count() == 20_000 + 24 - 4 + 5 and got.where("k = 'a'").agg(F.max("v")).first()[0] == 19


def test_expiry_keeps_what_kept_snapshots_need(spark, layout):
    path = scratch_path(spark, "t")
    for v in range(4):
        snapshots.upsert(readings(spark, [(1, "a", v), (30 + 24 * v, "b", v)]), path, layout, ["arrival"])
    gone = snapshots.expire(spark, path, keep=2)
    assert len(gone) == 0 or all(f"{snapshots.WRITE_COLUMN}={g}" not in folder_names(spark, path) for g in gone)
    assert stored(spark, path, layout, 3)[1, "a"] == 2 and stored(spark, path, layout)[1, "a"] == 3
    with pytest.raises(Exception):
        snapshots.read_entry(spark, path, 1)


def test_unpartitioned_and_keyless_tables(spark):
    rows = readings(spark, [(1, "a", 1), (1, "a", 2)]).drop("arrival")
    path, plain = scratch_path(spark, "t"), TimeTable(rows.schema)
    for _ in range(2):
        snapshots.append(rows, path, plain)
    assert snapshots.read(spark, path, plain).count() == 4 and PARTITION_COLUMN not in snapshots.read(spark, path, plain).columns
    keyed = TimeTable(rows.schema, keys=("k",))
    path = scratch_path(spark, "t")
    snapshots.upsert(rows.where("v = 1"), path, keyed, ["v"])
    snapshots.upsert_delta(rows, path, keyed, ["v"])
    assert [r["v"] for r in snapshots.read(spark, path, keyed).collect()] == [2]
    snapshots.overwrite(rows, path, plain)
    assert snapshots.read(spark, path, plain).count() == 2
