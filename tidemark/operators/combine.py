"""Unions, keyed concatenation, expansion by lists, and the first rows per key."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import Window as W

from tidemark.session import rows_per_task


def union_distinct(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.union, frames).distinct()


def union_all(*frames: DataFrame) -> DataFrame:
    """All rows, columns matched by name; a column some frame lacks becomes NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def concat_with_key(frames: Mapping[str, DataFrame], key: str) -> DataFrame:
    """Stack frames and say in ``key`` which one a row came from."""
    return union_all(*[df.withColumn(key, F.lit(name)) for name, df in frames.items()])


def with_each(df: DataFrame, *lists: DataFrame) -> DataFrame:
    """Repeat every row for each combination of rows of the ``lists``.

    The product is what is asked for; Spark's size checks choose the side that is broadcast. A
    small table is one file split, and so one task whatever comes of it: if the product has more
    rows than a task should make, the largest table is dealt out to as many tasks as that takes.
    """
    frames = [df, *lists]
    counts = [frame.count() for frame in frames]
    tasks = min(max(counts), math.ceil(math.prod(counts) / rows_per_task(df.sparkSession)))
    if tasks > 1:
        largest = counts.index(max(counts))
        frames[largest] = frames[largest].repartition(tasks)
    return reduce(DataFrame.crossJoin, frames)


def first_levels(df: DataFrame, by: Sequence[str], order: Sequence[Column], limit: int) -> DataFrame:
    """At most ``limit`` rows per key in ``order`` (a list of Columns), numbered in ``level``.

    The row-number filter is applied before the shuffle too, so no group is ever gathered.
    """
    numbered = df.withColumn("level", F.row_number().over(W.partitionBy(*by).orderBy(*order)))
    return numbered.where(F.col("level") <= limit)
