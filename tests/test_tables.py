"""Upserts, time tables and upkeep on temporary tables."""

from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.operators import maintenance
from tidemark.operators.upsert import DuplicateKeyError, append_strict, dedup_keep_last, upsert, upsert_into
from tidemark.session import new_database, path_exists, remove_path, scratch_path
from tidemark.sources import catalog
from tidemark.timetable import (
    PARTITION_COLUMN,
    PublishPendingError,
    TimeTable,
    create_statement,
    create_table,
    describe_table,
    insert_into,
    read_time_table,
    set_dedup,
    time_between,
    write_time_table,
)

DAY = datetime(2024, 3, 1)


def readings(spark, data):
    rows = [(DAY + timedelta(hours=h), k, v, i) for i, (h, k, v) in enumerate(data)]
    return spark.createDataFrame(rows, "ts timestamp, k string, v int, arrival int")


def table_of(df):
    return TimeTable(df.drop("arrival").schema, ts="ts", unit="DAY", keys=("ts", "k"))


def stored(spark, path, table):
    found = read_time_table(spark, path, table).collect()
    return {(int((r["ts"] - DAY).total_seconds() // 3600), r["k"]): r["v"] for r in found}, len(found)


def test_upsert_within_a_batch_over_old_partitions_and_again(spark):
    path = scratch_path(spark, "t")
    first = readings(spark, [(1, "a", 1), (1, "a", 2), (30, "a", 3), (60, "b", 4)])
    table = table_of(first)
    upsert(first, path, table, ["arrival"])
    late = readings(spark, [(1, "a", 5), (2, "a", 6), (1, None, 7), (1, None, 8)])
    for _ in range(2):
        upsert(late, path, table, ["arrival"])
        assert stored(spark, path, table) == (
            {(1, "a"): 5, (30, "a"): 3, (60, "b"): 4, (2, "a"): 6, (1, None): 8}, 5,
        )


def test_upsert_leaves_other_partitions_alone(spark):
    path = scratch_path(spark, "t")
    first = readings(spark, [(1, "a", 1), (30, "a", 3)])
    table = table_of(first)
    upsert(first, path, table, ["arrival"])
    files = lambda: {r["f"] for r in read_time_table(spark, path, table).select(F.input_file_name().alias("f")).collect()}
    before = files()
    upsert(readings(spark, [(2, "b", 9)]), path, table, ["arrival"])
    assert len(before & files()) == 1


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.tuples(st.integers(0, 50), st.sampled_from("ab"), st.integers(0, 9)), min_size=1, max_size=8), min_size=1, max_size=3))
def test_upserts_equal_a_dictionary(spark, batches):
    path, expected = scratch_path(spark, "t"), {}
    for data in batches:
        batch = readings(spark, data)
        upsert(batch, path, table_of(batch), ["arrival"])
        expected.update({(h, k): v for h, k, v in data})
    assert stored(spark, path, table_of(batch)) == (expected, len(expected))


@pytest.mark.parametrize("writer", ["upsert", "append_strict", "dedup_off", "append"])
def test_upsert_survives_a_crash_while_partitions_are_replaced(spark, monkeypatch, writer):
    path = scratch_path(spark, "t")
    first = readings(spark, [(1, "a", 1), (2, "a", 2), (30, "a", 3)])
    table = table_of(first)
    upsert(first, path, table, ["arrival"])

    def crash(spark, staged, path, inside):
        remove_path(spark, f"{path}/{PARTITION_COLUMN}=2024-03-01")
        raise IOError("driver lost")

    change = readings(spark, [(1, "a", 9), (31, "b", 8)])
    with monkeypatch.context() as patched:
        patched.setattr("tidemark.timetable.replace_folders", crash)
        with pytest.raises(IOError):
            upsert(change, path, table, ["arrival"])
    with pytest.raises(PublishPendingError):
        stored(spark, path, table)
    expected = {(1, "a"): 9, (2, "a"): 2, (30, "a"): 3, (31, "b"): 8}
    new = readings(spark, [(50, "n", 7)])
    if writer == "upsert":
        upsert(new, path, table, ["arrival"])
    elif writer == "append_strict":
        append_strict(new, path, table)
    elif writer == "dedup_off":
        upsert(new, path, replace(table, dedup=False), ["arrival"])
    else:
        write_time_table(new, path, table)
    assert stored(spark, path, table) == ({**expected, (50, "n"): 7}, 5)
    upsert(readings(spark, [(60, "n", 1)]), path, table, ["arrival"])
    assert stored(spark, path, table) == ({**expected, (50, "n"): 7, (60, "n"): 1}, 6)


@pytest.mark.parametrize("writer", ["upsert_into", "insert_into", "update_column", "retention"])
def test_upsert_into_a_catalog_table_finishes_what_was_cut_off(spark, monkeypatch, writer):
    name = f"{new_database(spark)}.r"
    first = readings(spark, [(1, "a", 1), (2, "a", 2), (30, "a", 3), (60, "c", 4)])
    create_table(spark, name, table_of(first))
    upsert_into(spark, first, name, ["arrival"])

    def crash(*args, **kwargs):
        raise IOError("driver lost")

    change = readings(spark, [(1, "a", 9), (31, "b", 8)])
    with monkeypatch.context() as patched:
        patched.setattr("tidemark.timetable._switch", crash)
        with pytest.raises(IOError):
            upsert_into(spark, change, name, ["arrival"])
    expected = {(1, "a"): 9, (2, "a"): 2, (30, "a"): 3, (31, "b"): 8, (60, "c"): 4}
    if writer == "upsert_into":
        upsert_into(spark, readings(spark, [(60, "c", 5)]), name, ["arrival"])
        expected[60, "c"] = 5
    elif writer == "insert_into":
        insert_into(spark, readings(spark, [(61, "c", 5)]), name)
        expected[61, "c"] = 5
    elif writer == "update_column":
        maintenance.update_column(spark, name, "v", F.col("v") * 2)
        expected = {k: 2 * v for k, v in expected.items()}
    else:
        maintenance.drop_expired_partitions(spark, name, 10, now="2024-03-11 09:00:00")
        expected = {k: v for k, v in expected.items() if k[0] >= 24}
    rows = {(int((r["ts"] - DAY).total_seconds() // 3600), r["k"]): r["v"] for r in spark.table(name).collect()}
    assert rows == expected and spark.table(name).count() == len(expected)


@pytest.mark.parametrize("unit", ["DAY", "NONE"])
def test_a_reader_sees_the_old_rows_while_a_publish_is_cut_off(spark, monkeypatch, unit):
    name = f"{new_database(spark)}.r"
    first = readings(spark, [(1, "a", 1), (30, "a", 3)])
    create_table(spark, name, replace(table_of(first), unit=unit))
    upsert_into(spark, first, name, ["arrival"])
    upsert_into(spark, readings(spark, [(1, "a", 2)]), name, ["arrival"])
    rows = lambda: {(int((r["ts"] - DAY).total_seconds() // 3600), r["k"]): r["v"] for r in spark.table(name).collect()}

    def crash(*args, **kwargs):
        raise IOError("driver lost")

    with monkeypatch.context() as patched:
        patched.setattr("tidemark.timetable._switch", crash)
        with pytest.raises(IOError):
            upsert_into(spark, readings(spark, [(1, "a", 9), (31, "b", 8)]), name, ["arrival"])
    assert rows() == {(1, "a"): 2, (30, "a"): 3}
    maintenance.truncate_table(spark, name)
    assert rows() == {}
    insert_into(spark, readings(spark, [(2, "c", 2)]), name)
    upsert_into(spark, readings(spark, [(2, "c", 4), (50, "c", 5)]), name, ["arrival"])
    upsert_into(spark, readings(spark, [(50, "c", 6)]), name, ["arrival"])
    assert rows() == {(2, "c"): 4, (50, "c"): 6} and spark.table(name).count() == 2
    location = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()["data_type"]
    maintenance.drop_table(spark, name)
    assert not spark.catalog.tableExists(name) and not path_exists(spark, location)


def test_rows_without_a_time_are_upserted_like_others(spark):
    path = scratch_path(spark, "t")
    batch = lambda k, v: spark.createDataFrame([(None, k, v, 1)], "ts timestamp, k string, v int, arrival int")
    table = table_of(batch("a", 1))
    for k, v in (("a", 1), ("b", 2), ("a", 3)):
        upsert(batch(k, v), path, table, ["arrival"])
    assert sorted((r["k"], r["v"]) for r in read_time_table(spark, path, table).collect()) == [("a", 3), ("b", 2)]


def test_partitions_do_not_depend_on_the_session_zone(spark):
    path = scratch_path(spark, "t")
    batch = readings(spark, [(22, "a", 1)])
    table = table_of(batch)
    try:
        for zone, v in (("UTC", 1), ("Asia/Tokyo", 2), ("America/New_York", 3)):
            spark.conf.set("spark.sql.session.timeZone", zone)
            again = batch.withColumn("v", F.lit(v)).withColumn("ts", F.timestamp_seconds(F.lit(1709330400)))
            upsert(again, path, table, ["arrival"])
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [(r["v"], r[PARTITION_COLUMN]) for r in read_time_table(spark, path, table).collect()] == [(3, "2024-03-01")]


def test_copy_into_a_filled_target_keeps_its_rows(spark):
    db = new_database(spark)
    old, new = readings(spark, [(1, "a", 1), (2, "b", 2)]).drop("arrival"), readings(spark, [(2, "b", 9), (30, "c", 3)]).drop("arrival")
    for name, df in (("old", old), ("new", new)):
        create_table(spark, f"{db}.{name}", table_of(df))
        insert_into(spark, df, f"{db}.{name}")
    maintenance.copy_table(spark, f"{db}.new", f"{db}.old")
    assert sorted((r["k"], r["v"]) for r in spark.table(f"{db}.old").collect()) == [("a", 1), ("b", 9), ("c", 3)]
    maintenance.copy_table(spark, f"{db}.new", f"{db}.old", replace=True)
    assert sorted((r["k"], r["v"]) for r in spark.table(f"{db}.old").collect()) == [("b", 9), ("c", 3)]


def test_dedup_off_appends(spark):
    path = scratch_path(spark, "t")
    batch = readings(spark, [(1, "a", 1)])
    table = TimeTable(batch.drop("arrival").schema, ts="ts", unit="DAY", keys=("ts", "k"), dedup=False)
    upsert(batch, path, table, ["arrival"])
    upsert(batch, path, table, ["arrival"])
    assert stored(spark, path, table)[1] == 2


def test_keys_must_hold_the_time(spark):
    schema = readings(spark, []).schema
    with pytest.raises(ValueError):
        TimeTable(schema, ts="ts", unit="DAY", keys=("k",))
    with pytest.raises(ValueError):
        TimeTable(schema, ts="ts", unit="WEEK")


def test_strict_append_refuses_copies(spark):
    path = scratch_path(spark, "t")
    ok = readings(spark, [(1, "a", 1), (2, "a", 1)])
    table = table_of(ok)
    append_strict(ok, path, table)
    append_strict(readings(spark, [(9, None, 1), (9, None, 2)]), path, table)
    for bad in ([(3, "a", 1), (3, "a", 2)], [(2, "a", 9)]):
        with pytest.raises(DuplicateKeyError):
            append_strict(readings(spark, bad), path, table)
    assert stored(spark, path, table)[1] == 4


@pytest.mark.parametrize("other", ["CAST(id AS DOUBLE)", "CAST(id AS STRING)"])
def test_dedup_orders_null_arrivals_first(spark, other):
    rows = spark.createDataFrame([("a", None, 1), ("a", 5, 2), ("b", None, 3)], "k string, arrival int, id int")
    got = dedup_keep_last(rows.withColumn("v", F.expr(other)), ["k"], ["arrival"]).collect()
    assert sorted((r["k"], r["arrival"], r["id"], float(r["v"])) for r in got) == [("a", 5, 2, 2.0), ("b", None, 3, 3.0)]


def test_upsert_of_rows_that_are_all_key(spark):
    path = scratch_path(spark, "t")
    batch = readings(spark, [(1, "a", 1), (1, "a", 2), (30, "b", 3)]).drop("v")
    for _ in range(2):
        upsert(batch, path, table_of(batch), ["arrival"])
    assert spark.read.parquet(path).count() == 2


def test_dedup_keep_last_of_one_key_that_is_every_row(spark):
    df = spark.range(10_000).select(F.lit("k").alias("k"), F.col("id").alias("arrival"))
    assert [tuple(r) for r in dedup_keep_last(df, ["k"], ["arrival"]).collect()] == [("k", 9_999)]


@pytest.mark.parametrize("unit, folder", [("HOUR", "2024-03-02-06"), ("DAY", "2024-03-02"), ("MONTH", "2024-03"), ("YEAR", "2024")])
def test_partition_units(spark, unit, folder):
    path = scratch_path(spark, "t")
    df = readings(spark, [(30, "a", 1)]).drop("arrival")
    table = TimeTable(df.schema, ts="ts", unit=unit)
    write_time_table(df, path, table)
    assert read_time_table(spark, path, table).first()[PARTITION_COLUMN] == folder


def test_time_between_prunes_partitions(spark):
    path = scratch_path(spark, "t")
    df = readings(spark, [(h, "a", h) for h in range(0, 240, 6)]).drop("arrival")
    table = TimeTable(df.schema, ts="ts", unit="DAY")
    write_time_table(df, path, table)
    some = time_between(read_time_table(spark, path, table), "ts", "2024-03-02 06:00:00", "2024-03-03 12:00:00", "DAY")
    assert sorted(r["v"] for r in some.collect()) == [30, 36, 42, 48, 54, 60]
    assert len(some.select(F.input_file_name()).distinct().collect()) <= 2


def test_catalog_create_describe_alter_and_drop(spark):
    db = new_database(spark)
    df = readings(spark, [(1, "a", 1), (30, "b", 2)]).drop("arrival")
    create_table(spark, f"{db}.r", table_of(df))
    create_table(spark, f"{db}.r", table_of(df))
    insert_into(spark, df, f"{db}.r")
    assert describe_table(spark, f"{db}.r") == table_of(df)
    listed = catalog.tables(spark, db).collect()
    assert [tuple(r) for r in listed] == [("r", "ts", "DAY", True)]
    columns = [(r["column_name"], r["designated"], r["upsertKey"]) for r in catalog.table_columns(spark, f"{db}.r").collect()]
    assert columns == [("ts", True, True), ("k", False, True), ("v", False, False)]
    assert sorted(r[0] for r in catalog.partitions(spark, f"{db}.r").collect()) == ["2024-03-01", "2024-03-02"]
    set_dedup(spark, f"{db}.r", False)
    assert not describe_table(spark, f"{db}.r").dedup
    maintenance.truncate_table(spark, f"{db}.r")
    assert spark.table(f"{db}.r").count() == 0
    maintenance.drop_table(spark, f"{db}.r")
    assert not spark.catalog.tableExists(f"{db}.r")


def test_copy_keeps_values_and_facts(spark):
    db = new_database(spark)
    df = readings(spark, [(1, "", 0), (30, None, 2)]).drop("arrival")
    create_table(spark, f"{db}.a", table_of(df))
    insert_into(spark, df, f"{db}.a")
    assert maintenance.copy_table(spark, f"{db}.a", f"{db}.b") == describe_table(spark, f"{db}.b")
    assert spark.table(f"{db}.a").exceptAll(spark.table(f"{db}.b")).count() == 0
    lossy = maintenance.falsy_to_null(spark.table(f"{db}.b")).orderBy("ts").collect()
    assert [(r["k"], r["v"]) for r in lossy] == [(None, None), (None, 2)]


def test_retention_drops_only_day_tables_up_to_the_deadline(spark):
    db = new_database(spark)
    df = readings(spark, [(1, "a", 1), (30, "b", 2), (55, "c", 3)]).drop("arrival")
    create_table(spark, f"{db}.days", table_of(df))
    create_table(spark, f"{db}.years", TimeTable(df.schema, ts="ts", unit="YEAR"))
    for name in ("days", "years"):
        insert_into(spark, df, f"{db}.{name}")
    dropped = maintenance.drop_expired_everywhere(spark, 10, now="2024-03-12 09:00:00", database=db)
    assert {k.split(".")[-1]: v for k, v in dropped.items()} == {"days": ["2024-03-01", "2024-03-02"], "years": []}
    assert spark.table(f"{db}.days").count() == 1
    assert maintenance.retained(df, "ts", 10, "2024-03-12 09:00:00").count() == 1


def test_bulk_create_insert_rows_and_drop(spark):
    db = new_database(spark)
    names = maintenance.create_tables(spark, f"{db}.sensor_", 3, "CREATE TABLE {table_name} (ts timestamp, name string) USING parquet")
    assert names == [f"{db}.sensor_{i}" for i in (1, 2, 3)]
    maintenance.insert_rows(spark, names[1], [(DAY, "x"), (DAY, "y")])
    assert spark.table(names[1]).count() == 2
    maintenance.drop_tables(spark, f"{db}.sensor_", 3)
    assert catalog.tables(spark, db).count() == 0


def test_create_statement_text(spark):
    text = create_statement("t", table_of(readings(spark, [])))
    assert "PARTITIONED BY (time_part)" in text and "'tidemark.keys'='ts,k'" in text
