"""As-of and latest joins on hand-made rows: ties, gaps, NULLs, and hot keys."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.asof import asof_join, asof_wide
from tidemark.operators.latest import latest_on, latest_wide
from tidemark.operators.ordering import hot_keys, ordered_splits, row_number_by, with_row_index

LEFT = "k string, t int, lid int"
RIGHT = "k string, t int, rid int, v double"


def asof(left, right, **kw):
    return asof_join(left, right, ["k"], "t", {"rid": "rid", "v": "v"}, tiebreak=["rid"], **kw)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


@pytest.fixture(params=["plain", "split"])
def path(request, spark):
    """Both ways a key can be handled."""
    if request.param == "split":
        spark.conf.set("spark.tidemark.rowsPerTask", "3")
    yield request.param
    spark.conf.unset("spark.tidemark.rowsPerTask")


def test_asof_is_inclusive_and_ties_take_the_highest_id(spark, path):
    left = spark.createDataFrame([("a", 5, 1), ("a", 5, 2), ("a", 4, 3), ("a", 9, 4)], LEFT)
    right = spark.createDataFrame([("a", 5, 10, 1.0), ("a", 5, 11, 2.0), ("a", 7, 12, 3.0)], RIGHT)
    assert rows(asof(left, right), "lid", "rid") == [(1, 11), (2, 11), (3, None), (4, 12)]


def test_asof_keeps_left_rows_without_a_match(spark, path):
    left = spark.createDataFrame([("a", 1, 1), ("b", 1, 2), (None, 1, 3), ("a", None, 4)], LEFT)
    right = spark.createDataFrame([("a", 0, 10, 1.0), (None, 0, 11, 2.0), ("a", None, 12, 3.0)], RIGHT)
    assert rows(asof(left, right), "lid", "rid") == [(1, 10), (2, None), (3, None), (4, None)]


def test_asof_with_an_empty_right_side(spark, path):
    left = spark.createDataFrame([("a", 1, 1)], LEFT)
    assert rows(asof(left, spark.createDataFrame([], RIGHT)), "lid", "rid", "v") == [(1, None, None)]


def test_asof_carries_a_null_value_of_the_matching_row(spark, path):
    left = spark.createDataFrame([("a", 9, 1)], LEFT)
    right = spark.createDataFrame([("a", 1, 10, 1.0), ("a", 2, 11, None)], RIGHT)
    assert rows(asof(left, right), "rid", "v") == [(11, None)]


def test_asof_against_brute_force_with_one_hot_key_and_one_hot_time(spark, path):
    rng = random.Random(3)
    make = lambda n: [("hot" if rng.random() < 0.6 else rng.choice("abc"), 50 if rng.random() < 0.4 else rng.randint(0, 99), i) for i in range(n)]
    left, right = make(300), [(k, t, i, float(i)) for k, t, i in make(300)]
    expected = []
    for k, t, lid in left:
        before = [(rt, rid) for rk, rt, rid, _ in right if rk == k and rt <= t]
        expected.append((lid, max(before)[1] if before else None))
    got = rows(asof(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT)), "lid", "rid")
    assert got == sorted(expected, key=str)


def test_asof_wide_equals_a_chain_of_asof_joins(spark, path):
    rng = random.Random(5)
    data = [(rng.choice("ab"), rng.choice(["s1", "s2", "s3"]), rng.randint(0, 40), i, float(i)) for i in range(200)]
    long = spark.createDataFrame(data, "k string, s string, t int, id int, v double")
    wide = asof_wide(long, "k", "s", ["s1", "s2", "s3"], "t", "v", ["id"], full_ts=True)
    chain = long.where("s = 's1'").select("t", "k", F.col("v").alias("value_1"))
    for i in (2, 3):
        right = long.where(f"s = 's{i}'")
        chain = asof_join(chain, right, ["k"], "t", {"t": f"timestamp_{i}", "v": f"value_{i}"}, tiebreak=["id"])
    columns = ["t", "k", "value_1", "timestamp_2", "value_2", "timestamp_3", "value_3"]
    assert rows(wide, *columns) == rows(chain, *columns)


@pytest.mark.parametrize("sensors", [2, 17, 110])
def test_asof_and_latest_of_neighbouring_microseconds(spark, path, sensors):
    names = [f"s{i}" for i in range(1, sensors + 1)]
    data = [("k", s, t, i, v) for s in names for t, i, v in ((0, 9 * 10**18, 1.0), (1, -9 * 10**18, 2.0))]
    long = spark.createDataFrame(data, "k string, s string, us bigint, id bigint, v double").withColumn("t", F.timestamp_micros("us"))
    latest = latest_wide(long, "k", "s", names, "t", "v", ["id"]).first()
    assert set(latest[2:]) == {2.0}
    newest = asof_wide(long, "k", "s", names, "t", "v", ["id"]).orderBy("t").collect()
    assert set(newest[-1][2:]) == {2.0} and len(newest) == 2


def test_left_rows_without_a_key_keep_any_columns(spark, path):
    left = spark.createDataFrame([("a", 2, 1), (None, 2, 2)], LEFT).withColumn("m", F.array(F.create_map(F.lit("x"), F.lit(1))))
    got = asof(left, spark.createDataFrame([("a", 1, 10, 1.0), (None, 1, 11, 2.0)], RIGHT))
    assert rows(got, "lid", "rid") == [(1, 10), (2, None)]


def test_latest_on_ties_and_missing_times(spark):
    df = spark.createDataFrame(
        [("a", 1, 1, "x"), ("a", 2, 2, "y"), ("a", 2, 3, None), ("b", None, 4, "z")], "k string, t int, id int, v string"
    )
    assert rows(latest_on(df, "t", ["k"], ["id"]), "k", "t", "id", "v") == [("a", 2, 3, None)]


def test_latest_wide_left_and_inner(spark):
    data = [("a", "s1", 1, 1, 1.0), ("a", "s2", 5, 2, None), ("b", "s2", 1, 3, 3.0), ("c", "s1", 2, 4, 4.0)]
    long = spark.createDataFrame(data, "k string, s string, t int, id int, v double").withColumn(
        "t", F.timestamp_micros(F.col("t") * 1_000_000)
    )
    left = latest_wide(long, "k", "s", ["s1", "s2"], "t", "v", ["id"])
    assert rows(left, "k", "value_1", "value_2") == [("a", 1.0, None), ("c", 4.0, None)]
    inner = latest_wide(long, "k", "s", ["s1", "s2"], "t", "v", ["id"], how="inner")
    assert rows(inner, "k", "value_1", "value_2") == [("a", 1.0, None)]


def test_row_numbers_with_a_hot_key(spark, path):
    data = [(("hot", None, "cold")[i % 3] if i < 95 else "cold", (i * 37) % 100, i) for i in range(100)]
    df = spark.createDataFrame(data, "k string, o int, id int")
    got = {r["id"]: r["n"] for r in row_number_by(df, ["k"], ["o", "id"], "n").collect()}
    for key in ("hot", None, "cold"):
        ordered = sorted((o, i) for k, o, i in data if k == key)
        assert [got[i] for _, i in ordered] == list(range(1, len(ordered) + 1))


def test_a_key_made_of_copies_is_split(spark):
    df = spark.range(2000).select(F.lit("k").alias("k"), F.lit(1).alias("o"))
    hot = hot_keys(df, ["k"], 100)
    sizes = [r["count"] for r in hot.splits(df, ["o"], unique=False).groupBy("_split").count().collect()]
    assert sum(sizes) == 2000 and max(sizes) < 400
    spark.conf.set("spark.tidemark.rowsPerTask", "100")
    numbers = row_number_by(df, ["k"], ["o"], "n")
    spark.conf.unset("spark.tidemark.rowsPerTask")
    assert numbers.agg(F.count_distinct("n"), F.min("n"), F.max("n")).first()[:] == (2000, 1, 2000)


def test_row_index_is_the_position_in_the_order(spark):
    df = spark.range(1000).select(((F.col("id") * 7919) % 1000).alias("v"))
    assert with_row_index(df, ["v"], "i").where("i != v").count() == 0
    copies = with_row_index(df.select(F.lit(1).alias("v")), ["v"], "i", unique=False)
    assert copies.agg(F.count_distinct("i"), F.max("i")).first()[:] == (1000, 999)


def test_hot_keys_counts_a_sample_of_large_inputs(spark):
    df = spark.range(200_000).select(F.when(F.col("id") < 150_000, F.lit(-1)).otherwise(F.col("id")).alias("k"))
    hot = hot_keys(df, ["k"], 50_000)
    assert [r["k"] for r in hot.values.collect()] == [-1]
    assert 6 <= hot.split_count <= 8
    assert hot.others(df).count() == 50_000
    assert hot_keys(df, ["k"], 190_000) is None


def test_overfull_ranges_are_cut_again(spark):
    """Bounds drawn from hardly any rows: splits still hold about what they should, in order."""
    conf = "spark.sql.execution.rangeExchange.sampleSizePerPartition"
    before = spark.conf.get(conf)
    rows = spark.range(3000).select((F.col("id") * 7919 % 3000).alias("n"), F.lit("x").alias("k")).repartition(6)
    spark.conf.set(conf, "1")
    try:
        placed = ordered_splits(rows, ["n"], True, 4, 100).collect()
    finally:
        spark.conf.set(conf, before)
    sizes = {}
    for r in placed:
        sizes.setdefault(r["_split"], []).append(r)
    assert max(map(len, sizes.values())) <= 200 and len(placed) == 3000
    assert all(sorted(r["_pos"] for r in part) == list(range(len(part))) for part in sizes.values())
    in_order = sorted(placed, key=lambda r: (r["_split"], r["_pos"]))
    assert [r["n"] for r in in_order] == list(range(3000))


def test_ties_that_no_range_can_cut(spark):
    rows = spark.range(50).select(F.lit(1).alias("n"), "id")
    assert {r["_split"] for r in ordered_splits(rows, ["n"], True, 4, 5).collect()} == {0}
    assert sorted(r["row_index"] for r in with_row_index(rows, ["n"], unique=False, rows_per_split=5).collect()) == list(range(50))
