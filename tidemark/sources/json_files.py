"""JSON arrays of prediction records to typed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.text import sanitize
from tidemark.functions.times import nanos, parse_iso

#: Fields of a prediction record, by how they are treated.
PLAIN_FIELDS = ["vehicleId", "naptanId", "bearing", "destinationNaptanId"]
SANITIZED_FIELDS = [
    "stationName",
    "lineId",
    "direction",
    "destinationName",
    "currentLocation",
    "towards",
    "modeName",
]
TIME_FIELDS = ["timestamp", "expectedArrival"]
NUMBER_FIELDS = ["timeToStation"]
SYMBOL_ORDER = [
    "vehicleId",
    "naptanId",
    "stationName",
    "lineId",
    "direction",
    "bearing",
    "destinationNaptanId",
    "destinationName",
    "currentLocation",
    "towards",
    "modeName",
]


def prediction_schema() -> str:
    text = [*PLAIN_FIELDS, *SANITIZED_FIELDS, *TIME_FIELDS]
    return ", ".join([f"`{c}` string" for c in text] + [f"`{c}` bigint" for c in NUMBER_FIELDS])


def read_predictions(spark: SparkSession, paths) -> DataFrame:
    """Records of landed JSON files (an array, or one object per line)."""
    return prediction_rows(spark.read.schema(prediction_schema()).option("multiLine", True).json(paths))


def prediction_rows(raw: DataFrame) -> DataFrame:
    """Labels sanitized, times as epoch nanoseconds (NULL if unreadable), NULLs kept."""
    times = {c: nanos(parse_iso(F.col(c))) for c in TIME_FIELDS}
    return raw.select(
        *[sanitize(c).alias(c) if c in SANITIZED_FIELDS else F.col(c) for c in SYMBOL_ORDER],
        times["expectedArrival"].alias("expectedArrival"),
        *NUMBER_FIELDS,
        times["timestamp"].alias("ts_ns"),
    )
