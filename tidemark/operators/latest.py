"""Latest row per key, in long and in wide form."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.ordering import order_key, pick_last


def latest_on(df: DataFrame, ts: str, by: Sequence[str], tiebreak: Sequence[str] = ()) -> DataFrame:
    """The row with the highest ``ts`` (then ``tiebreak``) per key."""
    return pick_last(df.where(F.col(ts).isNotNull()), by, [ts, *tiebreak])


def latest_wide(
    long: DataFrame,
    by: str,
    sensor: str,
    sensors: Sequence,
    ts: str,
    value: str,
    tiebreak: Sequence[str] = (),
    how: str = "left",
    full_ts: bool = False,
) -> DataFrame:
    """One row per key with the latest value of every sensor.

    ``left`` keeps the keys that have the first sensor, as a chain of left joins onto it would;
    ``inner`` keeps the keys that have all of them, as a cross join of single-key rows would.
    The output time is the first sensor's. The table is reduced to one row per (key, sensor)
    before anything is turned sideways, so N sensors cost one aggregation and no join.
    """
    rows = long.where(F.col(sensor).isin(list(sensors)) & F.col(ts).isNotNull() & F.col(by).isNotNull())
    rows = rows.withColumn("_order", order_key(rows, ts, tiebreak))
    newest = rows.groupBy(by, sensor).agg(
        F.max(ts).alias("_ts"), F.max_by(value, "_order").alias("_value")
    )
    # a single row per (key, sensor) is left, so max() just moves it into its column
    wide = newest.groupBy(by).agg(
        *[F.max(F.when(F.col(sensor) == s, F.col("_ts"))).alias(f"_ts{i}") for i, s in enumerate(sensors, 1)],
        *[F.max(F.when(F.col(sensor) == s, F.col("_value"))).alias(f"value_{i}") for i, s in enumerate(sensors, 1)],
    )
    needed = range(1, len(sensors) + 1) if how == "inner" else [1]
    wide = wide.where(reduce(lambda a, b: a & b, [F.col(f"_ts{i}").isNotNull() for i in needed]))
    out = [F.col("_ts1").alias(ts), F.col(by), F.col("value_1")]
    for i in range(2, len(sensors) + 1):
        if full_ts:
            out.append(F.col(f"_ts{i}").alias(f"timestamp_{i}"))
        out.append(F.col(f"value_{i}"))
    return wide.select(*out)
