"""Upsert with the last arrival winning, and its strict counterpart."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.ordering import pick_last
from tidemark.session import path_exists, written_aside
from tidemark.timetable import (
    PARTITION_COLUMN,
    TimeTable,
    columns_of,
    describe_table,
    finish_publishing,
    finish_publishing_into,
    insert_into,
    publish,
    publish_into,
    read_time_table,
    write_time_table,
)


class DuplicateKeyError(ValueError):
    """A plain insert would have broken a unique key."""


def dedup_keep_last(df: DataFrame, keys: Sequence[str], arrival: Sequence[str]) -> DataFrame:
    """One row per key: the one that arrived last. NULL keys equal each other."""
    return pick_last(df, keys, arrival)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where(F.col("copies") > 1)


def merge_keep_last(existing: DataFrame, latest: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``existing`` with the rows of ``latest`` replaced or added; both unique on ``keys``.

    Only an anti-join touches ``existing``; Spark broadcasts ``latest`` when its size allows,
    and then the existing rows are not shuffled at all.
    """
    same = reduce(lambda a, b: a & b, [F.col(f"e.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys])
    kept = existing.alias("e").join(latest.select(*keys).alias("n"), same, "left_anti")
    return kept.select(*existing.columns).unionByName(latest.select(*existing.columns))


def upsert(batch: DataFrame, path: str, table: TimeTable, arrival: Sequence[str]) -> None:
    """Upsert ``batch`` into the time table at ``path``, rewriting only the partitions it touches.

    The batch is reduced to one row per key and written aside, so that a retried task sees
    the same winners; the merged partitions are written beside the table, then moved over the
    old ones, so that no plan reads what it overwrites. Running it again changes nothing.
    """
    spark = batch.sparkSession
    finish_publishing(spark, path, table)
    if not table.dedup or not table.keys:
        write_time_table(batch, path, table)
        return
    winners = _winners(batch, table, arrival)
    if not path_exists(spark, path):
        write_time_table(winners, path, table)
        return
    with written_aside(winners, "upsert-batch") as latest:
        existing = _touched(read_time_table(spark, path, table), latest, table)
        merged = merge_keep_last(existing, latest, table.keys)
        publish(merged, path, table)


def upsert_into(spark: SparkSession, batch: DataFrame, name: str, arrival: Sequence[str]) -> None:
    """Insert into a catalog table: an upsert while its dedup is on, else an append.

    Works like :func:`upsert`; the note about staged partitions is a table property, and they
    are published by telling the catalog where they lie.
    """
    finish_publishing_into(spark, name)
    table = describe_table(spark, name)
    if not table.dedup or not table.keys:
        insert_into(spark, batch, name)
        return
    with written_aside(_winners(batch, table, arrival), "upsert-batch") as latest:
        existing = _touched(spark.table(name), latest, table)
        publish_into(merge_keep_last(existing, latest, table.keys), name)


def append_strict(batch: DataFrame, path: str, table: TimeTable) -> None:
    """Append, or raise if a key repeats within the batch or already exists."""
    spark = batch.sparkSession
    finish_publishing(spark, path, table)
    with written_aside(batch.select(*columns_of(table)), "strict-batch") as stable:
        # as in SQL, a key with a NULL in it equals no other
        clash = duplicate_keys(stable.dropna(subset=list(table.keys)), table.keys).select(*table.keys)
        if path_exists(spark, path):
            # one row per key on both sides, so neither a hot key nor a copy can skew the join
            ours = stable.select(*table.keys).distinct()
            clash = clash.unionByName(ours.join(_touched(read_time_table(spark, path, table), stable, table), list(table.keys), "left_semi"))
        example = clash.limit(1).collect()
        if example:
            raise DuplicateKeyError(f"duplicate key {example[0].asDict()}")
        write_time_table(stable, path, table)


def _winners(batch: DataFrame, table: TimeTable, arrival: Sequence[str]) -> DataFrame:
    order = [f"_arrival{i}" for i in range(len(arrival))]
    incoming = batch.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema.fields],
        *[F.col(a).alias(o) for a, o in zip(arrival, order)],
    )
    return pick_last(incoming, table.keys, order, drop=order)


def _touched(existing: DataFrame, batch: DataFrame, table: TimeTable) -> DataFrame:
    """Existing rows of the partitions that ``batch`` has rows in.

    The batch's first and last partition prune the folders before the scan; the semi-join on
    the partition column, which Spark may prune by at run time, leaves out those in between.
    """
    if table.partitioned:
        parts = batch.select(table.partition_of(F.col(table.ts)).alias("_part")).distinct()
        low, high = parts.agg(F.min("_part"), F.max("_part")).first()
        existing = existing.where(F.col(PARTITION_COLUMN).between(low, high))
        existing = existing.join(parts, F.col(PARTITION_COLUMN) == F.col("_part"), "left_semi")
    return existing.select(*columns_of(table))
