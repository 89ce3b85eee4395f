"""Plan shapes that the scale of the operators rests on."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from tidemark.functions.arrays import order_book
from tidemark.operators.asof import asof_join, asof_wide
from tidemark.operators.latest import latest_on, latest_wide
from tidemark.operators.paging import first_n, last_n
from tidemark.operators.sample import sample_last
from tidemark.operators.upsert import dedup_keep_last, merge_keep_last
from tidemark.plans import PLANS
from tidemark.plans.registry import SENSORS
from tidemark.session import scratch_path
from tidemark.timetable import TimeTable, read_time_table, time_between, write_time_table

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def events(spark):
    return spark.read.parquet(f"{SF_DIR}/events.parquet")


def plan_of(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


def exchanges(plan):
    return len(re.findall(r"\bExchange\b", plan))


def test_wide_asof_is_one_shuffle_without_joins(events):
    plan = plan_of(asof_wide(events, "user_id", "event_type", SENSORS, "ts", "value", ["event_id"]))
    assert exchanges(plan) == 1 and "Join" not in plan and "props" not in plan


def test_asof_join_is_one_shuffle_without_joins(events):
    left, right = events.where("event_type = 'click'"), events.where("event_type = 'view'")
    plan = plan_of(asof_join(left, right, ["user_id"], "ts", {"value": "v"}, tiebreak=["event_id"]))
    assert exchanges(plan) == 1 and "Join" not in plan


def test_samples_combine_before_the_shuffle_and_read_few_columns(events):
    plan = plan_of(sample_last(events, "ts", "1m", ["user_id"], ["value"], ["event_id"]))
    assert exchanges(plan) == 1 and "partial_max_by" in plan and "SortAggregate" not in plan
    assert "PushedFilters: [IsNotNull(ts)]" in plan and "props" not in plan


def test_latest_and_keep_last_combine_before_the_shuffle(events):
    for df in (latest_on(events, "ts", ["user_id"], ["event_id"]), dedup_keep_last(events, ["user_id", "ts"], ["event_id"])):
        plan = plan_of(df)
        assert exchanges(plan) == 1 and "partial_max_by" in plan and "Window" not in plan
    fixed = plan_of(dedup_keep_last(events.drop("props", "event_type"), ["user_id", "ts"], ["event_id"]))
    assert "SortAggregate" not in fixed


def test_latest_wide_reduces_before_it_turns_sideways(events):
    plan = plan_of(latest_wide(events, "user_id", "event_type", SENSORS, "ts", "value", ["event_id"]))
    assert exchanges(plan) == 2 and "Join" not in plan and "SortAggregate" not in plan


def test_short_limits_are_top_k(events):
    for df in (first_n(events, 5, ["ts", "event_id"]), last_n(events, 5, ["ts", "event_id"])):
        assert "TakeOrderedAndProject" in plan_of(df)


def test_levels_take_one_shuffle_and_hot_keys_are_cut_before_theirs(spark):
    assert exchanges(plan_of(PLANS["price_levels"].run(spark, SF_DIR))) == 1
    spark.conf.set("spark.tidemark.rowsPerTask", "5")
    plan = plan_of(PLANS["price_levels"].run(spark, SF_DIR))
    spark.conf.unset("spark.tidemark.rowsPerTask")
    assert plan.count("row_number(), 5, Partial") == 2


def test_a_great_many_hot_keys_are_cut_without_joins_and_sides_sorted_apart(spark):
    rows = spark.range(36_000).selectExpr("id % 12000 AS s", "id / 8.0D AS p", "id % 5 AS q")
    plan = plan_of(order_book(rows, ["s"], "p", "q", rows_per_key=2))
    assert "Join" not in plan and plan.count("row_number(), 5, Partial") == 2
    assert plan.count("REPARTITION_BY_NUM") == 2


def test_expansion_by_lists_shuffles_nothing(spark):
    plan = plan_of(PLANS["cross_join_seasonal"].run(spark, SF_DIR))
    assert "CartesianProduct" not in plan and exchanges(plan) == 0


def test_time_ranges_reach_the_partitions(spark, events):
    table, path = TimeTable(events.schema, ts="ts", unit="DAY"), scratch_path(spark, "t")
    write_time_table(events, path, table)
    stored = read_time_table(spark, path, table)
    plan = plan_of(time_between(stored, "ts", "2024-01-05", "2024-01-06", "DAY").select("event_id"))
    assert re.search(r"PartitionFilters: \[[^\]]*time_part#\d+ >= 2024-01-05", plan)
    assert "props" not in plan


def test_a_small_batch_does_not_shuffle_the_table(events):
    batch = events.where("event_id < 3")
    plan = plan_of(merge_keep_last(events, batch, ["ts", "user_id"]))
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan and "Exchange hashpartitioning" not in plan


#: The products that are asked for, and rows joined with the one row of a count.
PRODUCTS = {"cross_join_seasonal", "line_protocol_bad_lines", "catalog_scan"}


def test_no_query_plan_runs_python_or_an_unasked_cross_join(spark):
    for name, plan in PLANS.items():
        if not name.startswith(("stream_", "upsert_", "append_", "dedup_", "table_copy", "bulk_", "csv_", "insert_")):
            text = plan_of(plan.run(spark, SF_DIR))
            assert not re.search(r"ArrowEvalPython|BatchEvalPython|MapInPandas|CartesianProduct", text), name
            assert name in PRODUCTS or "NestedLoop" not in text, name
