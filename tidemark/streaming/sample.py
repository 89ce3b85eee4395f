"""Continuous SAMPLE BY."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

_INSTANT = "_instant"


def sample_stream(
    stream: DataFrame, ts: str, every: str, by: Sequence[str], aggs: Sequence[Column], late: str
) -> DataFrame:
    """One row per (bucket, key), emitted once the watermark has passed the bucket.

    ``every`` and ``late`` are durations such as ``1 hour``. State is one row per open
    (bucket, key). Watermarks need an instant, so a zone-less time is read as UTC.
    """
    timed = stream.withColumn(_INSTANT, F.col(ts).cast("timestamp")).withWatermark(_INSTANT, late)
    grouped = timed.groupBy(F.window(_INSTANT, every), *by).agg(*aggs)
    bucket = F.col("window.start").cast(stream.schema[ts].dataType).alias(ts)
    return grouped.select(bucket, *[c for c in grouped.columns if c != "window"])
