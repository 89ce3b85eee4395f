"""Records of CSV files whatever their splits, and rejected rows."""

import csv
import io
import os

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.session import scratch_path
from tidemark.sources.quoted_csv import csv_records, load_csv


def put(spark, *texts):
    """Files with these contents."""
    folder = scratch_path(spark, "csv").removeprefix("file:")
    os.makedirs(folder)
    for i, text in enumerate(texts):
        with open(f"{folder}/{i}.csv", "w", newline="", encoding="utf-8") as file:
            file.write(text)
    return folder


def told(rows):
    text = io.StringIO(newline="")
    csv.writer(text, lineterminator="\n").writerows(rows)
    return text.getvalue()


VALUES = st.text(st.sampled_from(['"', ",", "\n", "a", "é", " "]), max_size=12)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 99), VALUES), min_size=1, max_size=25), st.sampled_from([3, 17, 64, 1_000_000]))
def test_any_values_and_splits(spark, rows, split_bytes):
    text = told([("n", "v"), *rows])
    folder = put(spark, text, text)
    load = load_csv(spark, folder, "n int, v string", split_bytes=split_bytes, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    assert sorted((r["n"], r["v"] or "") for r in load.rows.collect()) == sorted(2 * rows)
    assert load.counts == {"records": 2 * len(rows), "good": 2 * len(rows), "rejected": 0}


def test_splits_of_one_file_are_read_by_several_tasks(spark):
    rows = [(i, "line\n" * (i % 7) + '"') for i in range(2_000)]
    folder = put(spark, told([("n", "v"), *rows]))
    records = csv_records(spark, folder, 4_000)
    assert records.count() == 2_001
    lines = {r["record"]: r["line"] for r in records.collect()}
    assert lines[0] == 1 and lines[1] == 2 and lines[8] == 2 + sum(1 + i % 7 for i in range(7))
    blocks = spark.read.text(folder).select("_metadata.file_block_start").distinct().count()
    assert blocks == 1  # the session's own splits are what they were


def test_rejected_records(spark):
    text = 'n,v,t\r\n1,a,2024-01-01 10:00:00\r\n\r\nx,"b\nc",2024-01-01\r\n2,too few\r\n3,a,b,c\r\n4,,never\r\n5,"",\r\n6,"open\nto the end\n'
    load = load_csv(spark, put(spark, text), "n int, v string, t timestamp", split_bytes=10)
    assert [(r["n"], r["v"]) for r in load.rows.orderBy("n").collect()] == [(1, "a"), (5, "")]
    rejects = [(r["line"], r["reason"]) for r in load.rejects.orderBy("line").collect()]
    assert rejects == [(4, "n is no int"), (6, "not 3 columns"), (7, "not 3 columns"), (8, "t is no timestamp"), (10, "quote left open")]
    assert load.counts == {"records": 7, "good": 2, "rejected": 5}
    assert load.rejects.where("line = 4").first()["text"].startswith('x,"b\nc"')


@pytest.mark.parametrize("header", [True, False])
def test_empty_and_wide_files(spark, header):
    assert load_csv(spark, put(spark, ""), "n int", header).counts == {"records": 0, "good": 0, "rejected": 0}
    if header:
        load = load_csv(spark, put(spark, "a,b,c\n1,2,3\n4,5,6\n"), "n int, m int")
        assert sorted(map(tuple, load.rows.collect())) == [(1, 2), (4, 5)]
        assert load_csv(spark, put(spark, "a,b\n"), "n int").rows.count() == 0


def test_a_quote_over_many_splits(spark):
    long = "word\n" * 500
    load = load_csv(spark, put(spark, told([("n", "v"), (1, long), (2, "x"), (3, long)])), "n int, v string", split_bytes=100)
    assert {r["n"]: r["v"] for r in load.rows.collect()} == {1: long, 2: "x", 3: long}
    assert load.rows.select(F.max("n")).first()[0] == 3
