"""Counts, sampling and latest rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.latest import latest_on
from tidemark.operators.ordering import order_key
from tidemark.operators.sample import last_not_null, sample_by, sample_last
from tidemark.operators.upsert import dedup_keep_last, duplicate_keys
from tidemark.plans.registry import MANY, MANY_SQL, SENSORS, many_sensors, plan, table

_LAST = "last(value ORDER BY ts, event_id)"


def _wide_sample_sql(bucket: str) -> str:
    lasts = ", ".join(f"{_LAST} FILTER (WHERE event_type = '{s}') AS {s}" for s in SENSORS)
    return f"SELECT {bucket} AS ts, user_id, {lasts} FROM events GROUP BY 1, 2"


def wide_sensors(events):
    """One nullable column per sensor, as a wide sparse table has them."""
    readings = [F.when(F.col("event_type") == s, F.col("value")).alias(s) for s in SENSORS]
    return events.select("event_id", "ts", "user_id", *readings)


@plan("SELECT count(*) AS rows FROM lineitem")
def count_all(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").agg(F.count("*").alias("rows"))


@plan(f"""
    SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS ts, user_id, {_LAST} AS last_value,
           count(*) AS readings, min(value) AS low, max(value) AS high,
           CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM events GROUP BY 1, 2
""")
def sample_by_1h(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    rows = events.withColumn("_order", order_key(events, "ts", ["event_id"]))
    return sample_by(
        rows,
        "ts",
        "1h",
        ["user_id"],
        [
            last_not_null("value", "_order").alias("last_value"),
            F.count("*").alias("readings"),
            F.min("value").alias("low"),
            F.max("value").alias("high"),
            F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total"),
        ],
    )


@plan(f"SELECT CAST(date_trunc('minute', ts) AS TIMESTAMP) AS ts, user_id, {_LAST} AS value FROM events GROUP BY 1, 2")
def sample_by_1m(spark, sf_dir):
    return sample_last(table(spark, sf_dir, "events"), "ts", "1m", ["user_id"], ["value"], ["event_id"])


@plan("""
    SELECT CAST(date_trunc('quarter', o_orderdate) AS TIMESTAMP) AS o_orderdate, o_orderpriority,
           count(*) AS orders, max(o_totalprice) AS largest
    FROM orders GROUP BY 1, 2
""")
def sample_by_quarter(spark, sf_dir):
    return sample_by(
        table(spark, sf_dir, "orders"),
        "o_orderdate",
        "3M",
        ["o_orderpriority"],
        [F.count("*").alias("orders"), F.max("o_totalprice").alias("largest")],
    )


@plan(_wide_sample_sql("CAST(date_trunc('hour', ts) AS TIMESTAMP)"))
def sample_last_not_null(spark, sf_dir):
    wide = wide_sensors(table(spark, sf_dir, "events"))
    return sample_last(wide, "ts", "1h", ["user_id"], SENSORS, ["event_id"])


def _last_of(sensor: str) -> str:
    order = "ts, tie NULLS FIRST"
    return f"last(value ORDER BY {order}) FILTER (WHERE sensor = '{sensor}' AND value IS NOT NULL) AS {sensor}"


@plan(f"""
    WITH {MANY_SQL}
    SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS ts, vehicle, {', '.join(map(_last_of, MANY))}
    FROM readings GROUP BY 1, 2
""")
def sample_last_wide_110(spark, sf_dir):
    readings = many_sensors(spark, sf_dir)
    wide = readings.select("ts", "vehicle", "tie", *[F.when(F.col("sensor") == s, F.col("value")).alias(s) for s in MANY])
    return sample_last(wide, "ts", "1d", ["vehicle"], MANY, ["tie"])


@plan("""
    SELECT * FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
""", name="latest_on")
def latest_on_user(spark, sf_dir):
    return latest_on(table(spark, sf_dir, "events"), "ts", ["user_id"], ["event_id"])


@plan("""
    SELECT * FROM (SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, user_id, event_type, value, event_id FROM events)
    QUALIFY row_number() OVER (PARTITION BY day, user_id, event_type ORDER BY event_id DESC) = 1
""")
def upsert_keep_last(spark, sf_dir):
    return dedup_keep_last(daily_readings(table(spark, sf_dir, "events")), ["day", "user_id", "event_type"], ["event_id"])


@plan("""
    SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, user_id, event_type, count(*) AS copies
    FROM events GROUP BY 1, 2, 3 HAVING count(*) > 1
""", name="duplicate_keys")
def duplicate_key_report(spark, sf_dir):
    return duplicate_keys(daily_readings(table(spark, sf_dir, "events")), ["day", "user_id", "event_type"])


@plan("""
    SELECT conv_id, count(*) AS files, CAST(sum(length(text)) AS BIGINT) AS size,
           CAST(sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) AS BIGINT) AS insertions,
           CAST(sum(CASE WHEN role <> 'user' THEN 1 ELSE 0 END) AS BIGINT) AS deletions,
           CAST(sum(length(text) - length(replace(text, chr(10), '')) + 1) AS BIGINT) AS lines
    FROM conversations GROUP BY conv_id
""")
def totals_per_group(spark, sf_dir):
    """Per-group totals of changes: turns as files, roles as the two kinds of change."""
    newlines = F.length("text") - F.length(F.replace(F.col("text"), F.lit("\n"), F.lit("")))
    return table(spark, sf_dir, "conversations").groupBy("conv_id").agg(
        F.count("*").alias("files"),
        F.sum(F.length("text")).alias("size"),
        F.count_if(F.col("role") == "user").alias("insertions"),
        F.count_if(F.col("role") != "user").alias("deletions"),
        F.sum(newlines + 1).alias("lines"),
    )


def daily_readings(events):
    """Events keyed by day, user and type."""
    day = F.date_trunc("DAY", "ts").cast("timestamp_ntz").alias("day")
    return events.select(day, "user_id", "event_type", "value", "event_id")
