"""Name -> (Spark query, SQL for the same rows)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.session import utc

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Plan:
    run: Query
    sql: str | None


PLANS: dict[str, Plan] = {}


def plan(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register the decorated query under ``name``, by default its function name."""

    def register(query: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return query(utc(spark), sf_dir)

        PLANS[name or query.__name__] = Plan(run, sql)
        return query

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Keys of the queries that split every key, and their splits, whatever the table's size.
FEW, SPLITS = 7, 20


def rows_per_split(rows: DataFrame) -> int:
    """The rows of a split with which ``rows`` make about `SPLITS` splits."""
    return max(1, rows.count() // SPLITS)


#: The wide workload: readings of 110 sensors of ten vehicles, two readings of a sensor one
#: microsecond apart, and a tiebreak that spans the whole bigint range and is sometimes NULL.
MANY = [f"s{i}" for i in range(110)]
MANY_SQL = """
    readings AS (
        SELECT user_id % 10 AS vehicle, 's' || ((event_id // 2) * 7919 % 110) AS sensor,
               date_trunc('hour', ts) + to_microseconds(event_id) AS ts,
               CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 2 = 0 THEN 9000000000000000000 - event_id
                    ELSE event_id - 9000000000000000000 END AS tie,
               CASE WHEN event_id % 13 = 0 THEN NULL ELSE value END AS value
        FROM events)
"""


def many_sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("event_id")
    far = F.lit(9 * 10**18)
    return table(spark, sf_dir, "events").select(
        (F.col("user_id") % 10).alias("vehicle"),
        F.concat(F.lit("s"), F.floor(i / 2) * 7919 % 110).alias("sensor"),
        F.timestamp_add("MICROSECOND", i, F.date_trunc("HOUR", "ts").cast("timestamp_ntz")).alias("ts"),
        F.when(i % 11 == 0, None).when(i % 2 == 0, far - i).otherwise(i - far).alias("tie"),
        F.when(i % 13 != 0, F.col("value")).alias("value"),
    )


#: Sensors of the events table, the driving one first.
SENSORS = ["view", "signup", "error", "click", "purchase"]
