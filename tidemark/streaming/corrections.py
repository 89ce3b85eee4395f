"""Continuous SAMPLE BY that corrects itself: late rows change their bucket, however late they are.

Aggregates are kept in parts that can be merged: a count and a sum add up, a last value is the
largest (order, value). Each micro-batch is reduced to one row per (bucket, key) and added to a
snapshot table as a delta; readers merge the deltas of a bucket, compaction makes them one. The
state of the aggregation is that table, so it needs no watermark and no memory, and no row is
ever too late. Each batch also writes the buckets it changed, merged, to a feed of corrections:
the newest correction of a bucket is its value.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark import snapshots
from tidemark.operators.ordering import pick_last
from tidemark.operators.sample import sample_by
from tidemark.streaming.ingest import BATCH_FOLDER, BatchWriter, folder_per_batch, write_batches
from tidemark.timetable import TimeTable

#: How parts of the same bucket become one.
_MERGES = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max, "last": F.max}


@dataclass(frozen=True)
class Kept:
    """An aggregate named `name`: count, sum, min, max or last of `value`; last and NULL-skipping in the order of `order`."""

    name: str
    how: str
    value: str
    order: tuple[str, ...] = ()

    def first(self) -> Column:
        """Over rows."""
        value = F.col(self.value)
        if self.how == "last":
            return F.max(F.when(value.isNotNull(), F.struct(*self.order, value.alias("_value")))).alias(self.name)
        made = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}[self.how]
        return made(value).alias(self.name)

    def shown(self) -> Column:
        return F.col(f"{self.name}._value" if self.how == "last" else self.name).alias(self.name)


@dataclass(frozen=True)
class Buckets(TimeTable):
    """A time table whose rows of one (bucket, key) are merged by their aggregates."""

    kept: tuple[Kept, ...] = ()

    def merge(self, rows: DataFrame) -> DataFrame:
        by = [*self.keys, *self.partition_columns]
        return rows.groupBy(*by).agg(*[_MERGES[k.how](k.name).alias(k.name) for k in self.kept])


def buckets(rows: DataFrame, ts: str, every: str, by: Sequence[str], kept: Sequence[Kept], unit: str = "DAY") -> Buckets:
    """The layout of the buckets of `rows`."""
    schema = sample_by(rows, ts, every, by, [k.first() for k in kept]).schema
    nullable = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
    return Buckets(nullable, ts, unit, (ts, *by), kept=tuple(kept))


def correcting_writer(path: str, layout: Buckets, every: str, stream: str = "stream", compact_every: int = 8) -> BatchWriter:
    """Merge each batch into the buckets at `path` and write the changed ones to the feed beside them."""
    by = [k for k in layout.keys if k != layout.ts]
    put = folder_per_batch(_feed(path))

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        partial = sample_by(batch, layout.ts, every, by, [k.first() for k in layout.kept])
        snapshot = snapshots.append_delta(partial, path, layout, (stream, batch_id))
        touched = [p.partition for p in snapshot.parts if p.order == snapshot.version] or None
        changed = partial.select(*layout.keys).distinct()
        rows = snapshots.read(spark, path, layout, snapshot.version, touched).alias("r")
        same = [F.col(f"r.{k}").eqNullSafe(F.col(f"c.{k}")) for k in layout.keys]
        put(rows.join(changed.alias("c"), same, "left_semi").select(*layout.keys, *[k.shown() for k in layout.kept]), batch_id)
        if (batch_id + 1) % compact_every == 0:
            snapshots.compact(spark, path, layout)

    return write


def sample_corrected(
    stream: DataFrame, path: str, layout: Buckets, every: str, checkpoint: str, trigger: dict | None = None, compact_every: int = 8
) -> StreamingQuery:
    """:func:`correcting_writer` as a stream."""
    return write_batches(stream, correcting_writer(path, layout, every, checkpoint, compact_every), checkpoint, trigger)


def read_buckets(spark: SparkSession, path: str, layout: Buckets) -> DataFrame:
    """All buckets as they are now."""
    rows = snapshots.read(spark, path, layout)
    return rows.select(*layout.keys, *[k.shown() for k in layout.kept])


def read_corrections(spark: SparkSession, path: str, layout: Buckets) -> DataFrame:
    """The feed: the number of the batch with each bucket it changed."""
    return spark.read.parquet(_feed(path))


def newest_corrections(spark: SparkSession, path: str, layout: Buckets) -> DataFrame:
    """The last correction of each bucket."""
    return pick_last(read_corrections(spark, path, layout), layout.keys, [BATCH_FOLDER], drop=[BATCH_FOLDER])


def _feed(path: str) -> str:
    return f"{path}__corrections"
