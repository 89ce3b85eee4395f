"""Scalar functions and samples with known answers."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions import geo, keys, text, times
from tidemark.functions.arrays import order_book
from tidemark.operators.combine import union_all, with_each
from tidemark.operators.ordering import order_key
from tidemark.operators.paging import assign_pages, first_n, last_n, row_range
from tidemark.operators.sample import sample_by, sample_last


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("lon, lat, code", [(10.40744, 57.64911, "u4pruyd"), (-5.6, 42.6, "ezs42e4"), (180.0, 90.0, "zzzzzzz"), (-180.0, -90.0, "0000000"), (181.0, 0.0, None)])
def test_geohash(spark, lon, lat, code):
    got = value(spark, geo.make_geohash(F.lit(lon), F.lit(lat), 35))
    assert got == code


def test_geohash_prefix_for_even_and_odd_bits(spark):
    full = value(spark, geo.make_geohash(F.lit(10.40744), F.lit(57.64911), 60))
    assert full.startswith("u4pruydqqvj")
    assert value(spark, geo.make_geohash(F.lit(10.40744), F.lit(57.64911), 30)) == full[:6]


@pytest.mark.parametrize("t, utc", [("07/04/2023 12:00:00 AM", "2023-07-04 05:00:00"), ("01/04/2023 12:00:00 PM", "2023-01-04 18:00:00"), ("03/12/2023 03:30:00 AM", "2023-03-12 08:30:00")])
def test_clock_12h_follows_daylight_saving(spark, t, utc):
    assert str(value(spark, times.parse_clock_12h(F.lit(t)))) == utc


def test_clock_with_a_fixed_offset(spark):
    assert str(value(spark, times.parse_clock_12h(F.lit("07/04/2023 12:00:00 AM"), "-06:00"))) == "2023-07-04 06:00:00"


@pytest.mark.parametrize("t, ns", [("2024-05-01T10:00:00Z", 1714557600000000000), ("2024-05-01T10:00:00.25Z", 1714557600250000000), ("yesterday", None), (None, None)])
def test_iso(spark, t, ns):
    assert value(spark, times.nanos(times.parse_iso(F.lit(t).cast("string")))) == ns


def test_nanos_floor_before_the_epoch(spark):
    assert str(value(spark, times.from_nanos(F.lit(-1).cast("bigint")).cast("string"))) == "1969-12-31 23:59:59.999999"


@pytest.mark.parametrize("n, expected", [(75, "a" * 75), (76, "a" * 75 + "..")])
def test_summary_length(spark, n, expected):
    assert value(spark, text.summarize(F.lit("a" * n))) == expected


def test_text_clean_up(spark):
    assert value(spark, text.summarize(F.lit('a "b"'))) == "a &quot;b&quot;"
    assert value(spark, text.sanitize(F.lit("Zoë's café #1\n"))) == "Zoë_s_café__1_"
    assert value(spark, text.strip_empty_fields(F.lit("t,a=,b=1,c= d=,e=2 5"))) == "t,b=1 e=2 5"
    assert value(spark, text.strip_empty_fields(F.lit("t,a=1 x=,y=2 5"))) == "t,a=1 y=2 5"
    assert value(spark, text.strip_empty_fields(F.lit('t,a=,b=\\= s="x= ,y=",z= 5'))) == 't,b=\\= s="x= ,y=" 5'


def test_vehicle_ids(spark):
    ids = [0, 255, 65536, 65536 * 26, 65536 * 27 + 10, 65536 * 26 * 26 * 26 - 1]
    got = spark.createDataFrame([(i,) for i in ids], "i bigint").select(keys.vehicle_id(F.col("i")).alias("v")).collect()
    assert [r["v"] for r in got] == ["AAA0000", "AAA00FF", "AAB0000", "ABA0000", "ABB000A", "ZZZFFFF"]


@pytest.mark.parametrize("limit", ["1000000", "2"])
def test_order_book(spark, limit):
    data = [("a", 1.00004, 10), ("a", 1.00003, 20), ("a", 3.0, 30), ("b", 2.0, 1), (None, 4.0, 1), (None, 5.0, 2), (None, 6.0, 3)]
    df = spark.createDataFrame(data, "s string, p double, q int")
    spark.conf.set("spark.tidemark.rowsPerTask", limit)
    rows = {r["s"]: r for r in order_book(df, ["s"], "p", "q", 2).collect()}
    spark.conf.unset("spark.tidemark.rowsPerTask")
    assert rows["a"]["bids"] == [[3.0, 30.0], [1.0, 10.0]] and rows["a"]["asks"] == [[1.0, 20.0], [1.0, 10.0]]
    assert rows["b"]["bids"] == rows["b"]["asks"] == [[2.0, 1.0]]
    assert rows[None]["bids"] == [[6.0, 3.0], [5.0, 2.0]] and rows[None]["asks"] == [[4.0, 1.0], [5.0, 2.0]]


@pytest.mark.parametrize("limit", [2, 1000])
def test_order_book_of_many_hot_keys_and_a_huge_one(spark, limit):
    small = spark.range(36_000).selectExpr("id % 12000 AS s", "id * 7919 % 1000 / 8.0D AS p", "id % 5 AS q")
    huge = spark.range(3_000).selectExpr("CAST(NULL AS BIGINT) AS s", "IF(id < 3, NULL, id / 2.0D) AS p", "id AS q")
    rows = small.union(huge).collect()
    expected = {}
    for r in rows:
        expected.setdefault(r["s"], []).append((r["p"] is not None, r["p"] or 0.0, float(r["q"])))
    book = order_book(spark.createDataFrame(rows, "s bigint, p double, q bigint"), ["s"], "p", "q", 4, rows_per_key=limit)
    got = book.collect()
    assert len(got) == len(expected) == 12_001
    for r in got:
        up = sorted(expected[r["s"]])
        for side, best in (("bids", up[::-1][:4]), ("asks", up[:4])):
            assert r[side] == [[round(p, 4) if known else None, q] for known, p, q in best], (r["s"], side)


def test_limits(spark, monkeypatch):
    df = spark.range(500)
    take = lambda d: [r["id"] for r in d.collect()]
    for top_k in (True, False):
        monkeypatch.setattr("tidemark.operators.paging._one_task_can_merge", lambda df, n: top_k)
        assert take(first_n(df, 3, ["id"])) == [0, 1, 2]
        assert take(last_n(df, 3, ["id"])) == [497, 498, 499]
        assert take(row_range(df, 10, 13, ["id"])) == [10, 11, 12]
        assert take(row_range(df, 498, 600, ["id"])) == [498, 499]
        assert take(last_n(df.limit(2), 3, ["id"])) == [0, 1]
    sizes = assign_pages(df, 200, ["id"]).groupBy("page").count().orderBy("page").collect()
    assert [tuple(r) for r in sizes] == [(0, 200), (1, 200), (2, 100)]


def test_sample_buckets_and_all_null_buckets(spark):
    data = [("2024-01-01 00:00:59", "a", None, 1), ("2024-01-01 00:00:10", "a", None, 2), ("2024-01-01 00:01:00", "a", 5.0, 3), ("2024-01-01 00:01:00", "a", 6.0, 4), ("2024-01-01 00:01:30", "a", None, 5), (None, "a", 1.0, 6)]
    df = spark.createDataFrame(data, "ts string, k string, v double, id int").withColumn("ts", F.col("ts").cast("timestamp"))
    got = {str(r["ts"]): r["v"] for r in sample_last(df, "ts", "1m", ["k"], ["v"], ["id"]).collect()}
    assert got == {"2024-01-01 00:00:00": None, "2024-01-01 00:01:00": 6.0}
    months = sample_by(df, "ts", "1M", ["k"], [F.count("*").alias("n")]).collect()
    assert [(str(r["ts"]), r["n"]) for r in months] == [("2024-01-01 00:00:00", 5)]
    for kind in ("timestamp", "timestamp_ntz"):
        typed = df.withColumn("ts", F.col("ts").cast(kind))
        assert {dict(sample_by(typed, "ts", every, ["k"], [F.count("*")]).dtypes)["ts"] for every in ("1h", "3M", "1y")} == {kind}
    with pytest.raises(ValueError):
        sample_by(df, "ts", "0m", ["k"], [F.count("*")])


def test_with_each_deals_out_a_large_product_of_a_table_in_one_split(spark, split_keys):
    one = spark.range(0, 40, 1, 1).withColumnRenamed("id", "x")
    few = spark.range(0, 2, 1, 1).selectExpr("IF(id = 0, 'a', 'b') AS c")
    for product in (with_each(one, few), with_each(few, one)):
        got = product.select("x", "c", F.spark_partition_id().alias("task")).collect()
        assert sorted((r["x"], r["c"]) for r in got) == [(x, c) for x in range(40) for c in "ab"]
        tasks = [r["task"] for r in got]
        assert len(set(tasks)) > 8 and max(map(tasks.count, tasks)) <= 20


def test_with_each_and_union(spark):
    few = spark.createDataFrame([("x", None), ("y", 2)], "a string, b int")
    got = with_each(spark.range(2), few, spark.createDataFrame([(1.5,)], "c double"))
    assert sorted(map(tuple, got.collect()), key=str) == [(0, "x", None, 1.5), (0, "y", 2, 1.5), (1, "x", None, 1.5), (1, "y", 2, 1.5)]
    assert with_each(few, spark.range(3000)).count() == 6000
    assert union_all(few, spark.createDataFrame([(9,)], "b int")).where("a IS NULL").count() == 1


@pytest.mark.parametrize("columns", [1, 16, 17, 110])
def test_a_later_microsecond_beats_any_tiebreak(spark, columns):
    data = [(0, 9 * 10**18, 1.0), (1, -9 * 10**18, 2.0), (100, 8 * 10**17, 3.0), (101, None, 4.0)]
    df = spark.createDataFrame(data, "us bigint, id bigint, v double").withColumn("ts", F.timestamp_micros("us"))
    wide = df.select("ts", "id", F.lit("k").alias("k"), *[F.col("v").alias(f"s{i}") for i in range(columns)])
    first = sample_last(wide.where("ts < TIMESTAMP '1970-01-01 00:00:00.000050'"), "ts", "1s", ["k"], [f"s{i}" for i in range(columns)], ["id"])
    assert set(first.first()[2:]) == {2.0}
    assert set(sample_last(wide, "ts", "1s", ["k"], [f"s{i}" for i in range(columns)], ["id"]).first()[2:]) == {4.0}


def test_integer_times_are_ordered_too(spark):
    df = spark.createDataFrame([(1, 9 * 10**18, 1.0), (2, -1, 2.0)], "ts bigint, id bigint, v double")
    assert df.agg(F.max_by("v", order_key(df, "ts", ["id"]))).first()[0] == 2.0


def test_date_add_and_default_time(spark):
    ts = F.lit("2024-02-29 12:34:56").cast("timestamp")
    assert str(value(spark, times.timestamp_floor("d", times.date_add("d", -5000, ts)))) == "2010-06-22 00:00:00"
    assert value(spark, times.default_ts(F.lit(None).cast("timestamp"))) is not None
