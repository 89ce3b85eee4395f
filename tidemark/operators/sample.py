"""SAMPLE BY: calendar-aligned time buckets with an implicit group-by."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.operators.ordering import order_key

_FIXED = {"s": "seconds", "m": "minutes", "h": "hours", "d": "days"}
_MONTHS = {"M": 1, "y": 12}


def bucket_start(ts: Column | str, every: str) -> Column:
    """Start of the bucket holding ``ts``; ``every`` is a count and one of s m h d M y.

    Fixed units go through ``window``, which keeps the timestamp type. Months and years start
    on the first of the month, as a zone-less timestamp that :func:`sample_by` casts back.
    """
    matched = re.fullmatch(r"(\d+)([smhdMy])", every)
    if not matched or int(matched[1]) == 0:
        raise ValueError(f"not a sampling interval: {every!r}")
    n, unit = int(matched[1]), matched[2]
    if unit in _FIXED:
        return F.window(ts, f"{n} {_FIXED[unit]}").getField("start")
    months = n * _MONTHS[unit]
    index = F.year(ts) * 12 + F.month(ts) - 1
    first = index - F.pmod(index, F.lit(months))
    return F.make_date(
        F.floor(first / 12).cast("int"), (F.pmod(first, F.lit(12)) + 1).cast("int"), F.lit(1)
    ).cast("timestamp_ntz")


def sample_by(df: DataFrame, ts: str, every: str, by: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """One row per (bucket, key) that has data; the bucket start keeps the name ``ts``.

    Aggregates combine on the map side, so a hot bucket or key shuffles one row per task.
    """
    bucket, kind = bucket_start(ts, every), df.schema[ts].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        bucket = bucket.cast(kind)
    return df.where(F.col(ts).isNotNull()).groupBy(bucket.alias(ts), *by).agg(*aggs)


def last_not_null(value: Column | str, order: Column | str) -> Column:
    """Aggregate: the last non-null ``value`` in ``order``; unlike last() it ignores arrival order."""
    value = F.col(value) if isinstance(value, str) else value
    order = F.col(order) if isinstance(order, str) else order
    return F.max_by(value, F.when(value.isNotNull(), order))


def sample_last(
    df: DataFrame,
    ts: str,
    every: str,
    by: Sequence[str],
    columns: Sequence[str],
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """last_not_null of many columns per (bucket, key): the wide sparse-sensor query."""
    rows = df.withColumn("_order", order_key(df, ts, tiebreak))
    return sample_by(rows, ts, every, by, [last_not_null(c, "_order").alias(c) for c in columns])
