"""Sample datasets: shapes, ranges and typed loads."""

import pytest

from tidemark import datasets
from tidemark.timetable import create_table, describe_table
from tidemark.plans.writes import new_database


def test_locations(spark):
    raw = spark.createDataFrame([("A", "Water", "57.64911", "10.40744")], "SensorName string, SensorType string, Latitude string, Longitude string")
    row = datasets.locations(raw).first()
    assert (row["G7c"], str(row["UpdatedAt"])) == ("u4pruyd", "2023-09-04 00:00:00")


@pytest.mark.parametrize("columns", [datasets.WATER, datasets.WEATHER])
def test_measurements(spark, columns):
    names = [c.split()[0] for c in columns.split(", ")]
    values = {n: "7" for n in names} | {"MeasurementTimestamp": "07/04/2023 12:30:00 AM", "BatteryLife": "n/a"}
    raw = spark.createDataFrame([tuple(values[n] for n in names)], ", ".join(f"`{n}` string" for n in names))
    row = datasets.measurements(raw, columns).first()
    assert str(row["MeasurementTimestamp"]) == "2023-07-04 05:30:00"
    assert row["BatteryLife"] is None and row["MeasurementID"] == "7"


def test_price_history_and_ticks(spark):
    bars = spark.createDataFrame([("T", 1.0, 2.0, 0.5, 1.5, 1.4, 100.0, "2023-01-03")], "Ticker string, Open double, High double, Low double, Close double, `Adj Close` double, Volume double, Date string")
    row = datasets.price_history(bars).first()
    assert (row["AdjClose"], row["Volume"], str(row["Timestamp"])) == (1.4, 100, "2023-01-03 00:00:00")
    fields = [c.split() for c in datasets.TICKS.split(", ")]
    raw = spark.createDataFrame([(1693929600123, "X", "NMS", 8, 1.0, 1, 0.5, 10.0, 0.1, 2)], ", ".join(f"`{n}` {'bigint' if n == 'timestamp' else t}" for n, t in fields))
    assert str(datasets.ticks(raw).first()["timestamp"]) == "2023-09-05 16:00:00.123000"


@pytest.mark.parametrize("name", sorted(datasets.TARGETS))
def test_targets_can_be_created(spark, name):
    table = f"{new_database(spark)}.{name}"
    create_table(spark, table, datasets.target(name))
    assert describe_table(spark, table) == datasets.target(name)
