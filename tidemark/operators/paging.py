"""First, last and in-between rows of a total order, and page numbers.

Every call names its order and ends it on a unique column: rows have no order of their own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.ordering import with_row_index
from tidemark.session import rows_per_task


def first_n(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    return row_range(df, 0, n, order)


def last_n(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The last ``n`` rows, in ascending order (a negative limit)."""
    if _one_task_can_merge(df, n):
        return df.orderBy(*[F.desc(c) for c in order]).limit(n).orderBy(*order)
    total = df.count()
    return row_range(df, max(0, total - n), total, order)


def row_range(df: DataFrame, low: int, high: int, order: Sequence[str]) -> DataFrame:
    """Rows at positions [low, high): ``high`` is an end position, not a count."""
    if _one_task_can_merge(df, high):
        return df.orderBy(*order).offset(low).limit(max(0, high - low))
    indexed = with_row_index(df, order, "_index")
    return indexed.where(F.col("_index").between(low, high - 1)).orderBy("_index").drop("_index")


def _one_task_can_merge(df: DataFrame, n: int) -> bool:
    """Whether the first ``n`` rows of every input split are few enough for a single task."""
    spark = df.sparkSession
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return n * max(1, size // split) <= rows_per_task(spark)


def assign_pages(
    df: DataFrame, page_rows: int, order: Sequence[str], name: str = "page", unique: bool = True, rows_per_split: int | None = None
) -> DataFrame:
    """Add the 0-based page of every row: one pass, instead of one query per page."""
    indexed = with_row_index(df, order, "_index", unique, rows_per_split)
    return indexed.withColumn(name, F.floor(F.col("_index") / page_rows).cast("bigint")).drop("_index")
