"""The sample datasets: typed targets, and the transforms that fill them from landed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from tidemark.functions.geo import make_geohash
from tidemark.functions.text import summarize
from tidemark.functions.times import parse_clock_12h
from tidemark.timetable import TimeTable

#: Columns of the landed and the typed tables.
STATS = "ts timestamp, country string, category string, visits bigint, unique_visitors bigint, sales double, number_of_products int"
SAMPLE = "ts timestamp, country string, category string, visits bigint, unique_visitors bigint, avg_unit_price double, sales double"
LOCATIONS = "UpdatedAt timestamp, SensorName string, SensorType string, Latitude double, Longitude double, G7c string"
WATER = (
    "MeasurementTimestamp timestamp, BeachName string, WaterTemperature double, Turbidity double, "
    "TransducerDepth double, WaveHeight double, WavePeriod int, BatteryLife double, "
    "MeasurementTimestampLabel string, MeasurementID string"
)
WEATHER = (
    "MeasurementTimestamp timestamp, StationName string, AirTemperature double, WetBulbTemperature double, "
    "Humidity int, RainIntensity double, IntervalRain double, TotalRain double, PrecipitationType int, "
    "WindDirection int, WindSpeed double, MaximumWindSpeed double, BarometricPressure double, SolarRadiation int, "
    "Heading int, BatteryLife double, MeasurementTimestampLabel string, MeasurementID string"
)
COMMITS = (
    "committed_datetime timestamp, repo string, author_name string, summary string, size int, insertions int, "
    "deletions int, lines int, files int"
)
PRICE_HISTORY = "Ticker string, Open double, High double, Low double, Close double, AdjClose double, Volume bigint, Timestamp timestamp"
TRADES = "symbol string, side string, price double, amount double, timestamp timestamp"
TICKS = (
    "timestamp timestamp, id string, exchange string, quoteType bigint, price double, marketHours bigint, "
    "changePercent double, dayVolume double, change double, priceHint bigint"
)


#: Columns, designated timestamp, partition unit and upsert keys per table.
TARGETS = {
    "ecommerce_stats": (STATS, "ts", "DAY", ("ts", "country", "category")),
    "ecommerce_sample": (SAMPLE, "ts", "DAY", ("ts", "country", "category")),
    "sensor_locations": (LOCATIONS, "UpdatedAt", "YEAR", ()),
    "water_sensors": (WATER, "MeasurementTimestamp", "MONTH", ()),
    "weather_stations": (WEATHER, "MeasurementTimestamp", "MONTH", ()),
    "gitlog": (COMMITS, "committed_datetime", "MONTH", ("committed_datetime", "repo", "author_name")),
    "price_history": (PRICE_HISTORY, "Timestamp", "MONTH", ()),
    "trades": (TRADES, "timestamp", "DAY", ()),
    "ticks": (TICKS, "timestamp", "DAY", ()),
}


def target(name: str) -> TimeTable:
    """The time table a dataset is loaded into."""
    columns, ts, unit, keys = TARGETS[name]
    return TimeTable(StructType.fromDDL(columns), ts=ts, unit=unit, keys=keys)


def locations(raw: DataFrame, updated_at: str = "2023-09-04T00:00:00.000000Z") -> DataFrame:
    """Landed sensor locations with a geohash."""
    return raw.select(
        F.lit(updated_at).cast("timestamp").alias("UpdatedAt"),
        "SensorName",
        "SensorType",
        F.col("Latitude").cast("double").alias("Latitude"),
        F.col("Longitude").cast("double").alias("Longitude"),
        make_geohash(F.col("Longitude").cast("double"), F.col("Latitude").cast("double"), 35).alias("G7c"),
    )


def measurements(raw: DataFrame, columns: str, zone: str = "America/Chicago") -> DataFrame:
    """Landed text columns as typed ones (``WATER`` or ``WEATHER``); the local 12-hour time becomes an instant.

    An unreadable number becomes NULL, so that one bad reading does not stop a load.
    """
    out = []
    for f in StructType.fromDDL(columns).fields:
        if f.name == "MeasurementTimestamp":
            out.append(parse_clock_12h(F.col(f.name), zone).alias(f.name))
        else:
            out.append(F.col(f.name).try_cast(f.dataType).alias(f.name))
    return raw.select(*out)


def commits(raw: DataFrame, repo: str) -> DataFrame:
    """Commit rows with the summary cut to symbol length."""
    return raw.select(
        "committed_datetime",
        F.lit(repo).alias("repo"),
        "author_name",
        summarize("summary").alias("summary"),
        *[F.col(c).cast("int").alias(c) for c in ("size", "insertions", "deletions", "lines", "files")],
    )


def price_history(raw: DataFrame) -> DataFrame:
    """Keyed daily bars with the source's spelling of two columns replaced."""
    renamed = raw.withColumnRenamed("Adj Close", "AdjClose").withColumnRenamed("Date", "Timestamp")
    return renamed.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in StructType.fromDDL(PRICE_HISTORY).fields])


def ticks(raw: DataFrame) -> DataFrame:
    """Ticks whose source time is in milliseconds."""
    return raw.withColumn("timestamp", F.timestamp_millis("timestamp")).select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in StructType.fromDDL(TICKS).fields]
    )
