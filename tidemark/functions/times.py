"""Epoch units, timestamp parsing, flooring and sequences."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.operators.ordering import row_number_by

#: Text formats of the sources.
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss'Z'"
ISO_FRACTION = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
CLOCK_12H = "MM/dd/yyyy hh:mm:ss a"

_FLOOR_UNITS = {"s": "SECOND", "m": "MINUTE", "h": "HOUR", "d": "DAY", "M": "MONTH", "y": "YEAR"}
_ADD_UNITS = {"s": "SECOND", "m": "MINUTE", "h": "HOUR", "d": "DAY", "w": "WEEK", "M": "MONTH", "y": "YEAR"}


def micros(ts: Column | str) -> Column:
    """Epoch microseconds of either timestamp type."""
    return F.unix_micros(F.col(ts).cast("timestamp") if isinstance(ts, str) else ts.cast("timestamp"))


def nanos(ts: Column | str) -> Column:
    return micros(ts) * F.lit(1000).cast("bigint")


def from_millis(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def from_nanos(ns: Column) -> Column:
    """Timestamp of epoch nanoseconds; Spark keeps microseconds, so keep ``ns`` too if they matter."""
    return F.timestamp_micros(F.floor(ns / F.lit(1000).cast("decimal(4,0)")).cast("bigint"))


def parse_iso(text: Column) -> Column:
    """ISO time in UTC with or without a fraction; NULL if it is neither."""
    whole, fraction = F.lit(ISO_SECONDS), F.lit(ISO_FRACTION)
    # a failed parse is the slow case, so only the format that can fit is tried
    return F.when(F.contains(text, F.lit(".")), F.try_to_timestamp(text, fraction)).otherwise(
        F.try_to_timestamp(text, whole)
    )


def parse_clock_12h(text: Column, zone: str = "America/Chicago") -> Column:
    """``MM/dd/yyyy hh:mm:ss AM`` local time to an instant; ``zone`` may be a fixed offset."""
    return F.to_utc_timestamp(F.to_timestamp(text, CLOCK_12H), zone)


def timestamp_floor(unit: str, ts: Column | str) -> Column:
    return F.date_trunc(_FLOOR_UNITS[unit], ts)


def date_add(unit: str, count: int, ts: Column) -> Column:
    """``ts`` moved by ``count`` units, backwards if negative."""
    return F.timestamp_add(_ADD_UNITS[unit], F.lit(count), ts)


def default_ts(ts: Column | str, arrival: Column | None = None) -> Column:
    """``ts``, or the arrival time for rows without one."""
    return F.coalesce(F.col(ts) if isinstance(ts, str) else ts, arrival if arrival is not None else F.current_timestamp())


def long_sequence(spark: SparkSession, n: int, name: str = "x") -> DataFrame:
    """Rows 1 .. n."""
    return spark.range(1, n + 1).withColumnRenamed("id", name)


def timestamp_sequence(x: Column, start: datetime | str | Column, step_micros: int) -> Column:
    """Time of the ``x``-th row (1-based): a function of ``x``, so any partitioning gives the same."""
    start = start if isinstance(start, Column) else F.lit(start).cast("timestamp")
    return F.timestamp_micros(F.unix_micros(start) + (x - 1) * F.lit(step_micros))


def synthetic_clock(
    df: DataFrame, keys: list[str], order: list[str], start: datetime | str | Column, step_micros: int, name: str = "ts",
    rows_per_key: int | None = None,
) -> DataFrame:
    """Give each key's rows, in ``order``, times ``step_micros`` apart."""
    numbered = row_number_by(df, keys, order, "_nth", rows_per_key)
    return numbered.withColumn(name, timestamp_sequence(F.col("_nth"), start, step_micros)).drop("_nth")
