"""A maintained table of the latest row per key.

Keys are dealt into buckets by hash, and the table is a snapshot table partitioned by bucket. A
batch is reduced to its latest row per key; only the buckets its keys fall in are read and
rewritten, and a late row that is older than the stored one changes nothing. Reading is a plain
scan, for one key a scan of one bucket.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark import snapshots
from tidemark.operators.latest import latest_on
from tidemark.operators.ordering import pick_last

BUCKET = "bucket"


@dataclass(frozen=True)
class LatestTable:
    """Layout of a latest-per-key table: rows of `schema`, newest by `ts`, then `tiebreak`."""

    schema: T.StructType
    ts: str
    keys: tuple[str, ...]
    tiebreak: tuple[str, ...] = ()
    buckets: int = 64

    @property
    def partition_columns(self) -> list[str]:
        return [BUCKET]

    @property
    def stored_schema(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField(BUCKET, T.StringType())])

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("string")

    def stamp(self, df: DataFrame) -> DataFrame:
        typed = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields])
        return typed.withColumn(BUCKET, self.bucket())

    @property
    def order(self) -> list[str]:
        return [self.ts, *self.tiebreak]


def update_latest(batch: DataFrame, path: str, table: LatestTable) -> snapshots.Snapshot:
    """Take a batch's rows into the table; rows without a time are left out. Repeating a batch changes nothing."""

    def newer(old: DataFrame, new: DataFrame) -> DataFrame:
        return pick_last(old.unionByName(new), table.keys, table.order)

    return snapshots.merge(latest_on(batch, table.ts, table.keys, table.tiebreak), path, table, newer, "latest")


def read_latest(spark: SparkSession, path: str, table: LatestTable, key: Sequence | None = None) -> DataFrame:
    """The latest row of every key, or of one, for which only its bucket is read."""
    if key is None:
        return snapshots.read(spark, path, table).drop(BUCKET)
    types = [table.schema[k].dataType for k in table.keys]
    values = [F.lit(v).cast(t) for v, t in zip(key, types)]
    bucket = spark.range(1).select(F.pmod(F.xxhash64(*values), F.lit(table.buckets)).cast("string")).first()[0]
    rows = snapshots.read(spark, path, table, partitions=[bucket])
    for name, value in zip(table.keys, values):
        rows = rows.where(F.col(name).eqNullSafe(value))
    return rows.drop(BUCKET)
