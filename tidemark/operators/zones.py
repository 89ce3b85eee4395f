"""File skipping inside partitions: rows clustered along a Z-order curve, and the extent of every file.

A write is sorted along a curve that interleaves the bits of several columns' ranks, so a file
holds a small range of each of them. The smallest and largest value of those columns in every
file are kept beside the write, from one pass over its files. A range filter then reads only
files whose extents meet it, and filters their rows.

The columns' ranks come from approximate quantiles. They shape the files, never the result.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark import snapshots

ZONES = "_zones"
ROWS_PER_FILE = 1_000_000
#: Bits of each column's rank on the curve.
BITS = 5


def _number(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(column).cast("timestamp"))
    if isinstance(kind, T.DateType):
        return F.unix_date(column)
    if isinstance(kind, T.NumericType):
        return F.col(column)
    raise ValueError(f"{column} is neither a number nor a time")


def z_order(df: DataFrame, columns: Sequence[str]) -> Column:
    """A row's place on the curve over `columns`, numbers or times; NULL counts as smallest."""
    shares = [i / (1 << BITS) for i in range(1, 1 << BITS)]
    found = df.agg(*[F.percentile_approx(_number(df, c), F.lit(shares)).alias(f"q{i}") for i, c in enumerate(columns)]).first()
    place = F.lit(0).cast("bigint")
    for i, column in enumerate(columns):
        bounds = sorted(set(found[i] or []))
        value = _number(df, column)
        rank = F.lit(0)
        for bound in bounds:
            rank = rank + F.coalesce((value >= F.lit(bound)).cast("int"), F.lit(0))
        for bit in range(BITS):
            place = place + F.shiftleft(F.shiftright(rank, bit).bitwiseAND(F.lit(1)).cast("bigint"), bit * len(columns) + i)
    return place


def append_clustered(
    df: DataFrame, path: str, layout: snapshots.Layout, columns: Sequence[str], rows_per_file: int = ROWS_PER_FILE
) -> snapshots.Snapshot:
    """Add rows in files of about `rows_per_file`, clustered by `columns`, with the extents of every file."""
    spark = df.sparkSession
    stamped = layout.stamp(df)
    files = max(1, math.ceil(stamped.count() / rows_per_file))
    order = [*layout.partition_columns, "_z"]
    arranged = stamped.withColumn("_z", z_order(stamped, columns)).repartitionByRange(files, *order).sortWithinPartitions(*order)
    parts = snapshots.write_as_arranged(arranged.drop("_z"), path, layout)
    for name in {p.write for p in parts}:
        _note_extents(spark, f"{path}/{snapshots.WRITE_COLUMN}={name}", layout, columns)
    return snapshots.transact(spark, path, lambda base: snapshots.Change("append", tuple(parts)))


def _note_extents(spark: SparkSession, folder: str, layout: snapshots.Layout, columns: Sequence[str]) -> None:
    rows = spark.read.schema(layout.stored_schema).parquet(folder)
    extents = [f(c).alias(f"{name}_{i}") for i, c in enumerate(columns) for name, f in (("low", F.min), ("high", F.max))]
    by_file = rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("rows"), *extents)
    by_file.withColumn("columns", F.lit(",".join(columns))).write.mode("overwrite").parquet(f"{folder}/{ZONES}")


@dataclass(frozen=True)
class Skipped:
    """Rows within ranges, and how many of the table's files with extents were opened for them."""

    rows: DataFrame
    opened: int
    files: int


def read_ranges(spark: SparkSession, path: str, layout: snapshots.Layout, ranges: Mapping[str, tuple], version: int | None = None) -> Skipped:
    """Rows of a snapshot with `low <= column <= high` for every column of `ranges`.

    Parts written without extents are read whole. Where parts are merged by key, the ranges
    must be on key columns, for else a skipped file could hold the last row of a key.
    """
    snapshot = snapshots.latest(spark, path) if version is None else snapshots.read_entry(spark, path, version)
    several = any(len(p) > 1 for p in snapshot.by_partition().values())
    if layout.keys and getattr(layout, "dedup", True) and several and not set(ranges) <= set(layout.keys):
        raise ValueError("ranges on columns outside the keys cannot skip files that are merged by key")
    noted, total = {}, 0
    for write in sorted({p.write for p in snapshot.parts}):
        folder = f"{path}/{snapshots.WRITE_COLUMN}={write}"
        if not snapshots.path_exists(spark, f"{folder}/{ZONES}"):
            continue
        extents = spark.read.parquet(f"{folder}/{ZONES}")
        columns = (extents.select("columns").first() or [""])[0].split(",")
        meets = F.lit(True)
        for i, column in enumerate(columns):
            if column in ranges:
                low, high = (F.lit(x).cast(layout.schema[column].dataType) for x in ranges[column])
                meets = meets & (F.col(f"high_{i}") >= low) & (F.col(f"low_{i}") <= high)
        # the files to open, which a scan lists on the driver in any case
        noted[write] = [r["file"] for r in extents.where(meets).select("file").collect()]
        total += extents.count()

    def paths(part: snapshots.Part) -> list[str]:
        folder = snapshots.part_folder(path, layout, part)
        if part.write not in noted:
            return [folder]
        inner = folder[len(path) :] + "/"
        return [f for f in noted[part.write] if inner in f]

    rows = snapshots.rows_of(spark, path, layout, snapshot.parts, paths)
    for column, (low, high) in ranges.items():
        kind = layout.schema[column].dataType
        rows = rows.where(F.col(column).between(F.lit(low).cast(kind), F.lit(high).cast(kind)))
    return Skipped(rows, sum(len(paths(p)) for p in snapshot.parts if p.write in noted), total)
