"""Limits, paging and per-key clocks."""

from __future__ import annotations

from tidemark.functions.times import synthetic_clock
from tidemark.operators.paging import assign_pages, first_n, last_n, row_range
from tidemark.plans.aggregates import wide_sensors
from tidemark.plans.registry import SENSORS, plan, rows_per_split, table
from tidemark.operators.sample import sample_last

ORDER = ["ts", "event_id"]


@plan("SELECT * FROM events ORDER BY ts, event_id LIMIT 100", name="first_n")
def first_rows(spark, sf_dir):
    return first_n(table(spark, sf_dir, "events"), 100, ORDER)


@plan("SELECT * FROM (SELECT * FROM events ORDER BY ts DESC, event_id DESC LIMIT 20) ORDER BY ts, event_id", name="last_n")
def last_rows(spark, sf_dir):
    return last_n(table(spark, sf_dir, "events"), 20, ORDER)


@plan("SELECT * FROM events ORDER BY ts, event_id LIMIT 50 OFFSET 250", name="row_range")
def row_range_rows(spark, sf_dir):
    return row_range(table(spark, sf_dir, "events"), 250, 300, ORDER)


@plan("SELECT event_id, CAST((row_number() OVER (ORDER BY ts, event_id) - 1) // 1000 AS BIGINT) AS page FROM events")
def page_assignment(spark, sf_dir):
    return assign_pages(table(spark, sf_dir, "events").select(*ORDER), 1000, ORDER).select("event_id", "page")


@plan("SELECT event_id, CAST((row_number() OVER (ORDER BY ts, event_id) - 1) // 100 AS BIGINT) AS page FROM events")
def page_assignment_split(spark, sf_dir):
    """Pages over a fixed number of splits, which pages do not fit."""
    rows = table(spark, sf_dir, "events").select(*ORDER)
    return assign_pages(rows, 100, ORDER, rows_per_split=rows_per_split(rows)).select("event_id", "page")


_CLOCK = """
    SELECT event_type, event_id, TIMESTAMP '2022-07-15 12:32:45' + to_minutes(CAST(row_number() OVER
             (PARTITION BY event_type ORDER BY event_id) - 1 AS BIGINT)) AS clock
    FROM events
"""


@plan(_CLOCK)
def synthetic_clock_split(spark, sf_dir):
    """Clocks with every key split over tasks."""
    rows = table(spark, sf_dir, "events").select("event_type", "event_id")
    timed = synthetic_clock(rows, ["event_type"], ["event_id"], "2022-07-15 12:32:45", 60_000_000, "clock", rows_per_key=rows_per_split(rows))
    return timed.withColumn("clock", timed["clock"].cast("timestamp_ntz"))


@plan(_CLOCK, name="synthetic_clock")
def synthetic_clock_per_key(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_type", "event_id")
    timed = synthetic_clock(rows, ["event_type"], ["event_id"], "2022-07-15 12:32:45", 60_000_000, "clock")
    return timed.withColumn("clock", timed["clock"].cast("timestamp_ntz"))


@plan("""
    SELECT CAST(date_trunc('minute', ts) AS TIMESTAMP) AS ts, user_id, {lasts}
    FROM events GROUP BY 1, 2 ORDER BY ts, user_id LIMIT 100
""".format(lasts=", ".join(f"last(value ORDER BY ts, event_id) FILTER (WHERE event_type = '{s}') AS {s}" for s in SENSORS)))
def sparse_sensor_report(spark, sf_dir):
    """The flagship: SAMPLE BY 1m with last_not_null of every sensor, first 100 rows."""
    wide = wide_sensors(table(spark, sf_dir, "events"))
    return first_n(sample_last(wide, "ts", "1m", ["user_id"], SENSORS, ["event_id"]), 100, ["ts", "user_id"])
