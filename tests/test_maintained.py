"""Latest tables, clustered files, resumable copies and evolving columns."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark import evolving, snapshots
from tidemark.operators import copying, zones
from tidemark.operators.latest import latest_on
from tidemark.operators.latest_table import LatestTable, read_latest, update_latest
from tidemark.session import scratch_path
from tidemark.timetable import TimeTable

DAY = datetime(2024, 3, 1)
SCHEMA = "ts timestamp, k string, v int"


def readings(spark, data):
    return spark.createDataFrame([(None if h is None else DAY + timedelta(hours=h), k, v) for h, k, v in data], SCHEMA)


def test_latest_table_equals_latest_on_after_every_batch(spark):
    rng, path, seen = random.Random(4), scratch_path(spark, "latest"), []
    table = LatestTable(spark.createDataFrame([], SCHEMA).schema, "ts", ("k",), ("v",), buckets=8)
    for _ in range(4):
        data = [(rng.choice([None, *range(50)]), rng.choice("abcdefgh") if rng.random() < 0.9 else None, rng.randrange(100)) for _ in range(6)]
        seen += data
        update_latest(readings(spark, data), path, table)
        want = sorted(map(str, latest_on(readings(spark, seen), "ts", ["k"], ["v"]).collect()))
        assert sorted(map(str, read_latest(spark, path, table).collect())) == want
    one = read_latest(spark, path, table, ["a"]).collect()
    assert one == [r for r in latest_on(readings(spark, seen), "ts", ["k"], ["v"]).collect() if r["k"] == "a"]


def test_only_touched_buckets_are_rewritten(spark):
    path = scratch_path(spark, "latest")
    table = LatestTable(spark.createDataFrame([], SCHEMA).schema, "ts", ("k",), buckets=16)
    update_latest(readings(spark, [(1, f"k{i}", i) for i in range(100)]), path, table)
    before = set(snapshots.latest(spark, path).parts)
    update_latest(readings(spark, [(0, "k1", -1), (2, "k2", -2)]), path, table)
    assert 14 <= len(before & set(snapshots.latest(spark, path).parts)) <= 15
    assert {r["k"]: r["v"] for r in read_latest(spark, path, table).where("k IN ('k1', 'k2')").collect()} == {"k1": 1, "k2": -2}


@pytest.fixture
def grid(spark):
    """A day of readings of a hundred vehicles."""
    return spark.range(20_000).select(
        (F.lit(DAY) + F.make_dt_interval(mins=(F.col("id") * 7919 % 2880).cast("int"))).alias("ts"),
        (F.col("id") * 31 % 100).alias("vehicle"),
        F.col("id").alias("v"),
    )


def test_ranges_open_few_files(spark, grid):
    path, layout = scratch_path(spark, "zones"), TimeTable(grid.schema, ts="ts", unit="DAY")
    zones.append_clustered(grid, path, layout, ["ts", "vehicle"], rows_per_file=300)
    ranges = {"ts": (DAY + timedelta(hours=5), DAY + timedelta(hours=8)), "vehicle": (20, 30)}
    got = zones.read_ranges(spark, path, layout, ranges)
    want = grid.where(F.col("ts").between(*map(F.lit, ranges["ts"])) & F.col("vehicle").between(20, 30))
    assert sorted(r["v"] for r in got.rows.collect()) == sorted(r["v"] for r in want.collect()) != []
    assert got.files >= 60 and got.opened <= got.files / 6
    assert got.rows.select(F.input_file_name()).distinct().count() <= got.opened
    assert zones.read_ranges(spark, path, layout, {"vehicle": (500, 600)}).opened == 0
    # a part without extents is read whole
    snapshots.append(grid.limit(10).withColumn("vehicle", F.lit(25).cast("bigint")), path, layout)
    assert zones.read_ranges(spark, path, layout, {"vehicle": (25, 25)}).rows.count() == grid.where("vehicle = 25").count() + 10


def test_merged_files_are_skipped_by_key_only(spark, grid):
    path, layout = scratch_path(spark, "zones"), TimeTable(grid.schema, ts="ts", unit="DAY", keys=("ts", "vehicle"))
    first = grid.dropDuplicates(["ts", "vehicle"])
    zones.append_clustered(first, path, layout, ["ts", "vehicle", "v"], rows_per_file=300)
    snapshots.upsert_delta(first.where("vehicle = 25").withColumn("v", F.lit(-1).cast("bigint")), path, layout, ["v"])
    got = zones.read_ranges(spark, path, layout, {"vehicle": (25, 26)})
    assert got.opened < got.files / 2
    assert got.rows.where("vehicle = 25 AND v = -1").count() == first.where("vehicle = 25").count() > 0
    assert got.rows.where("vehicle = 26").count() == first.where("vehicle = 26").count()
    with pytest.raises(ValueError):
        zones.read_ranges(spark, path, layout, {"v": (0, 1)})


def test_z_order_places_null_and_ties(spark):
    df = spark.createDataFrame([(None, 1), (1, None), (1, 1), (9, 9)], "a int, b int")
    assert df.select(zones.z_order(df, ["a", "b"])).count() == 4
    with pytest.raises(ValueError):
        zones.z_order(spark.createDataFrame([("x",)], "s string"), ["s"])


def source_of(spark, grid, keys=()):
    path, layout = scratch_path(spark, "source"), TimeTable(grid.schema, ts="ts", unit="DAY", keys=keys)
    for i in range(3):
        put = snapshots.append if not keys else lambda df, p, t: snapshots.upsert_delta(df, p, t, ["v"])
        put(grid.where(F.col("v") % 3 >= i).withColumn("v", F.col("v") + i).repartition(4), path, layout)
    return path, layout


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("keys", [(), ("ts", "vehicle")])
def test_a_cut_off_copy_takes_up_the_rest(spark, grid, monkeypatch, keys):
    grid = grid.limit(600)
    source, layout = source_of(spark, grid, keys)
    target = scratch_path(spark, "target")
    real, calls = snapshots.transact, []

    def crash(spark_, path, build):
        if path == target:
            calls.append(1)
            if len(calls) == 3:
                raise IOError("driver lost")
        return real(spark_, path, build)

    with monkeypatch.context() as patched:
        patched.setattr(snapshots, "transact", crash)
        with pytest.raises(IOError):
            copying.copy_snapshot(spark, source, target, layout, step_bytes=6_000)
    half = copying.ledger(spark, target).count()
    assert half > 0
    done = copying.copy_snapshot(spark, source, target, layout, step_bytes=6_000)
    assert done.before == half and done.files > 0
    assert rows(snapshots.read(spark, target, layout)) == rows(snapshots.read(spark, source, layout))
    assert copying.copy_snapshot(spark, source, target, layout).files == 0
    told = copying.ledger(spark, target)
    assert told.count() == done.files + half == told.select("file").distinct().count()
    # the source grows: only its new files are copied
    snapshots.append(grid.limit(5).withColumn("ts", F.col("ts") + F.make_dt_interval(days=F.lit(9))), source, layout)
    assert copying.copy_snapshot(spark, source, target, layout).files >= 1
    assert rows(snapshots.read(spark, target, layout)) == rows(snapshots.read(spark, source, layout))


def test_a_copy_of_a_rewritten_source_is_refused_and_wrong_rows_are_seen(spark, grid, monkeypatch):
    grid = grid.limit(100)
    source, layout = source_of(spark, grid)
    target = scratch_path(spark, "target")
    copying.copy_snapshot(spark, source, target, layout)
    snapshots.overwrite(grid, source, layout)
    with pytest.raises(ValueError):
        copying.copy_snapshot(spark, source, target, layout)
    write = snapshots.write_as_arranged
    monkeypatch.setattr(snapshots, "write_as_arranged", lambda df, p, t: write(df.limit(50), p, t))
    other = scratch_path(spark, "target")
    with pytest.raises(copying.ChecksumError):
        copying.copy_snapshot(spark, source, other, layout)
    assert snapshots.latest(spark, other).version == 0


def test_columns_are_added_renamed_and_widened_without_rewriting(spark):
    path = scratch_path(spark, "evolving")
    evolving.add_columns(spark, path, {"id": "int", "x": "float"})
    evolving.append(spark.createDataFrame([(1, 1.5), (2, None)], "id int, x float"), path)
    files = lambda: {r[0] for r in evolving.read(spark, path).select(F.input_file_name()).distinct().collect()}
    before = files()
    evolving.add_columns(spark, path, {"y": "string", "x": "float"})
    evolving.rename_column(spark, path, "x", "speed")
    evolving.widen_column(spark, path, "id", "bigint")
    evolving.widen_column(spark, path, "speed", "double")
    evolving.append(spark.createDataFrame([(2**40, 0.1, "new")], "id bigint, speed double, y string"), path)
    got = evolving.read(spark, path)
    assert got.dtypes == [("id", "bigint"), ("speed", "double"), ("y", "string")]
    assert sorted(map(tuple, got.collect())) == [(1, 1.5, None), (2, None, None), (2**40, 0.1, "new")]
    assert before < files()
    # a dropped column's values do not come back under its old name
    evolving.drop_column(spark, path, "y")
    evolving.add_columns(spark, path, {"y": "string"})
    assert evolving.read(spark, path).where("y IS NOT NULL").count() == 0
    for wrong in (lambda: evolving.widen_column(spark, path, "id", "int"), lambda: evolving.rename_column(spark, path, "id", "y")):
        with pytest.raises(ValueError):
            wrong()
    with pytest.raises(KeyError):
        evolving.append(spark.createDataFrame([(1,)], "nobody int"), path)


def test_batches_widen_a_column_as_they_come(spark):
    path = scratch_path(spark, "evolving")
    write = evolving.evolving_writer(path)
    batches = [
        spark.createDataFrame([(1, 1.0)], "id int, x float"),
        spark.createDataFrame([(2**40, "a")], "id bigint, new string"),
        spark.createDataFrame([(3, 2.5)], "id int, x double"),
    ]
    for number, batch in enumerate(batches):
        write(batch, number)
        write(batch, number)
    got = evolving.read(spark, path)
    assert got.dtypes == [("id", "bigint"), ("x", "double"), ("new", "string")]
    assert sorted(map(tuple, got.collect())) == [(1, 1.0, None), (3, 2.5, None), (2**40, None, "a")]
