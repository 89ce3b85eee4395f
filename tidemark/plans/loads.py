"""Loads of the sample datasets, fed from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark import datasets
from tidemark.functions.times import CLOCK_12H, timestamp_sequence
from tidemark.operators.upsert import dedup_keep_last
from tidemark.plans.registry import plan, table
from tidemark.session import scratch_path
from tidemark.sinks.files import export_csv, read_routed, route_by_key
from tidemark.sources.csv_files import read_csv
from tidemark.timetable import PARTITION_COLUMN, read_time_table, write_time_table


@plan("""
    SELECT TIMESTAMP '2020-01-01' + to_minutes(CAST(conv_id AS BIGINT)) AS committed_datetime, 'talks' AS repo, role AS author_name,
           replace(CASE WHEN length(text) > 75 THEN concat(substr(text, 1, 75), '..') ELSE text END, '"', '&quot;') AS summary,
           CAST(length(text) AS INTEGER) AS size, CAST(turn AS INTEGER) AS insertions, 0 AS deletions,
           CAST(turn AS INTEGER) AS lines, 1 AS files
    FROM conversations
    QUALIFY row_number() OVER (PARTITION BY conv_id, role ORDER BY turn DESC) = 1
""")
def commit_log(spark, sf_dir):
    """Turns as commits: one row per time, repository and author survives."""
    raw = table(spark, sf_dir, "conversations").select(
        timestamp_sequence(F.col("conv_id") + 1, "2020-01-01", 60_000_000).alias("committed_datetime"),
        F.col("role").alias("author_name"),
        F.col("text").alias("summary"),
        F.length("text").alias("size"),
        F.col("turn").alias("insertions"),
        F.lit(0).alias("deletions"),
        F.col("turn").alias("lines"),
        F.lit(1).alias("files"),
    )
    keys = datasets.target("gitlog").keys
    last = dedup_keep_last(datasets.commits(raw, "talks"), keys, ["insertions"])
    return last.withColumn("committed_datetime", F.col("committed_datetime").cast("timestamp_ntz"))


def _measured(spark, name, columns, landed):
    """``landed`` rows as text in CSV files, a column that is not in them empty; read back, typed, from a MONTH table."""
    fields = [f.name for f in StructType.fromDDL(columns).fields]
    raw = landed.select(*[F.col(c) if c in landed.columns else F.lit(None).cast("string").alias(c) for c in fields])
    files, path, target = scratch_path(spark, f"{name}-csv"), scratch_path(spark, name), datasets.target(name)
    export_csv(raw, files)
    text = ", ".join(f"`{c}` string" for c in fields)
    write_time_table(datasets.measurements(read_csv(spark, files, text), columns), path, target)
    stored = read_time_table(spark, path, target).drop(PARTITION_COLUMN)
    return stored.withColumn("MeasurementTimestamp", F.col("MeasurementTimestamp").cast("timestamp_ntz"))


@plan("""
    SELECT date_trunc('second', ts)::TIMESTAMP + INTERVAL 6 HOUR AS "MeasurementTimestamp", event_type AS "BeachName",
           value AS "WaterTemperature", CASE WHEN event_type <> 'error' THEN value / 2 END AS "Turbidity",
           CAST(user_id AS INTEGER) AS "WavePeriod", CAST(event_id AS VARCHAR) AS "MeasurementID"
    FROM events
""")
def water_sensors(spark, sf_dir):
    """Landed text with local winter times and some unreadable numbers, to a typed MONTH table."""
    landed = table(spark, sf_dir, "events").select(
        F.date_format("ts", CLOCK_12H).alias("MeasurementTimestamp"),
        F.col("event_type").alias("BeachName"),
        F.col("value").alias("WaterTemperature"),
        F.when(F.col("event_type") == "error", "n/a").otherwise((F.col("value") / 2).cast("string")).alias("Turbidity"),
        F.col("user_id").alias("WavePeriod"),
        F.col("event_id").alias("MeasurementID"),
    )
    stored = _measured(spark, "water_sensors", datasets.WATER, landed)
    return stored.select("MeasurementTimestamp", "BeachName", "WaterTemperature", "Turbidity", "WavePeriod", "MeasurementID")


@plan("""
    SELECT date_trunc('second', ts)::TIMESTAMP + INTERVAL 6 HOUR AS "MeasurementTimestamp", event_type AS "StationName",
           value AS "AirTemperature", NULL::DOUBLE AS "WetBulbTemperature", CAST(user_id % 100 AS INTEGER) AS "Humidity",
           CASE WHEN event_type <> 'error' THEN value / 4 END AS "RainIntensity", NULL::DOUBLE AS "IntervalRain", NULL::DOUBLE AS "TotalRain",
           CASE WHEN event_id % 3 > 0 THEN CAST(event_id % 3 * 30 AS INTEGER) END AS "PrecipitationType", CAST(event_id % 360 AS INTEGER) AS "WindDirection",
           value * 2 AS "WindSpeed", value * 3 AS "MaximumWindSpeed", NULL::DOUBLE AS "BarometricPressure", CAST(user_id AS INTEGER) AS "SolarRadiation",
           CAST(event_id % 360 - 180 AS INTEGER) AS "Heading", 11.9::DOUBLE AS "BatteryLife", NULL::VARCHAR AS "MeasurementTimestampLabel",
           CAST(event_id AS VARCHAR) AS "MeasurementID"
    FROM events
""")
def weather_stations(spark, sf_dir):
    """The wide one: eighteen columns, four of them never measured, numbers and codes that are missing in some rows."""
    i, value = F.col("event_id"), F.col("value")
    landed = table(spark, sf_dir, "events").select(
        F.date_format("ts", CLOCK_12H).alias("MeasurementTimestamp"),
        F.col("event_type").alias("StationName"),
        value.alias("AirTemperature"),
        (F.col("user_id") % 100).alias("Humidity"),
        F.when(F.col("event_type") == "error", "n/a").otherwise((value / 4).cast("string")).alias("RainIntensity"),
        F.when(i % 3 > 0, i % 3 * 30).alias("PrecipitationType"),
        (i % 360).alias("WindDirection"),
        (value * 2).alias("WindSpeed"),
        (value * 3).alias("MaximumWindSpeed"),
        F.col("user_id").alias("SolarRadiation"),
        (i % 360 - 180).alias("Heading"),
        F.lit("11.9").alias("BatteryLife"),
        i.alias("MeasurementID"),
    )
    return _measured(spark, "weather_stations", datasets.WEATHER, landed)


@plan("""
    SELECT concat(event_type, '.', user_id) AS "Ticker", first(value ORDER BY ts, event_id) AS "Open", max(value) AS "High", min(value) AS "Low",
           last(value ORDER BY ts, event_id) AS "Close", last(value ORDER BY ts, event_id) / 2 AS "AdjClose", count(*) AS "Volume",
           CAST(date_trunc('day', ts) AS TIMESTAMP) AS "Timestamp"
    FROM events GROUP BY event_type, user_id, date_trunc('day', ts)
""")
def price_history(spark, sf_dir):
    """Readings as daily bars, landed in one folder of files per kind of ticker, loaded with the source's two column names replaced."""
    order = F.struct("ts", "event_id")
    bars = table(spark, sf_dir, "events").groupBy("event_type", "user_id", F.to_date("ts").alias("Date")).agg(
        F.min_by("value", order).alias("Open"),
        F.max("value").alias("High"),
        F.min("value").alias("Low"),
        F.max_by("value", order).alias("Close"),
        (F.max_by("value", order) / 2).alias("Adj Close"),
        F.count("*").alias("Volume"),
    )
    files, path, target = scratch_path(spark, "bars"), scratch_path(spark, "price-history"), datasets.target("price_history")
    route_by_key(bars, "event_type", files)
    raw = read_routed(spark, files, bars.schema).withColumn("Ticker", F.concat_ws(".", "event_type", "user_id"))
    write_time_table(datasets.price_history(raw), path, target)
    stored = read_time_table(spark, path, target).drop(PARTITION_COLUMN)
    return stored.withColumn("Timestamp", F.col("Timestamp").cast("timestamp_ntz"))
