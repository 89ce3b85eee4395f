"""Table upkeep: retention, copies, column changes, bulk create and drop."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.operators.upsert import upsert_into
from tidemark.session import written_aside
from tidemark.timetable import (
    PARTITION_COLUMN,
    TimeTable,
    columns_of,
    create_table,
    describe_table,
    discard_publishing,
    finish_publishing_into,
    insert_into,
)

_DROPS_PER_STATEMENT = 200


def deadline(days: int, now: Column | datetime | str | None = None) -> Column:
    """Midnight of the day ``days`` before ``now``."""
    now = F.current_timestamp() if now is None else now if isinstance(now, Column) else F.lit(now)
    return F.date_trunc("DAY", F.dateadd(F.to_date(now.cast("timestamp")), -days))


def retained(df: DataFrame, ts: str, days: int, now=None) -> DataFrame:
    """Rows a DAY-partitioned table keeps: a day goes when its start is at or before the deadline."""
    return df.where(F.to_date(F.col(ts)) > F.to_date(deadline(days, now)))


def drop_expired_partitions(spark: SparkSession, name: str, days: int, now=None) -> list[str]:
    """Drop a DAY table's expired partitions; other tables are left alone. Returns what was dropped.

    Works on the partition list only, no row is read.
    """
    if describe_table(spark, name).unit != "DAY":
        return []
    finish_publishing_into(spark, name)
    cut = spark.range(1).select(F.date_format(deadline(days, now), "yyyy-MM-dd").alias("d")).first()["d"]
    listed = spark.sql(f"SHOW PARTITIONS {name}").collect()
    values = [r["partition"].split("=", 1)[1] for r in listed]
    expired = sorted(v for v in values if v <= cut)
    for start in range(0, len(expired), _DROPS_PER_STATEMENT):
        specs = ", ".join(
            f"PARTITION ({PARTITION_COLUMN}='{v}')" for v in expired[start : start + _DROPS_PER_STATEMENT]
        )
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {specs}")
    return expired


def drop_expired_everywhere(spark: SparkSession, days: int, now=None, database: str | None = None) -> dict[str, list[str]]:
    """Retention over all DAY tables of a database."""
    tables = [t for t in spark.catalog.listTables(database) if not t.isTemporary]
    names = [f"{'.'.join([*(t.namespace or []), t.name])}" for t in tables]
    return {n: drop_expired_partitions(spark, n, days, now) for n in names}


def copy_table(spark: SparkSession, source: str, target: str, replace: bool = False) -> TimeTable:
    """Copy rows, schema, partitioning and keys of a catalog table, values unchanged.

    A target that exists keeps its rows: the copy is upserted on the target's keys, or appended
    if it has none or its dedup is off; ``replace`` takes the place of all its rows. A new
    target and ``replace`` need no shuffle, as the files of the source lie by partition.
    """
    finish_publishing_into(spark, source)
    fresh = not spark.catalog.tableExists(target)
    if fresh:
        create_table(spark, target, describe_table(spark, source))
    table = describe_table(spark, target)
    rows = spark.table(source)
    if fresh or replace:
        insert_into(spark, rows, target, overwrite=True, gather=False)
    else:
        # a keyed source has one row per key, so the arrival order never decides
        upsert_into(spark, rows, target, arrival=[table.ts] if table.ts else columns_of(table)[:1])
    return table


def falsy_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Zero, false and the empty string become NULL (an opt-in, lossy copy rule)."""
    chosen = columns if columns is not None else df.columns
    return df.withColumns({c: _nullif_falsy(df.schema[c]) for c in chosen if _nullif_falsy(df.schema[c]) is not None})


def _nullif_falsy(f: T.StructField) -> Column | None:
    if isinstance(f.dataType, T.NumericType):
        return F.nullif(f.name, F.lit(0).cast(f.dataType))
    if isinstance(f.dataType, T.StringType):
        return F.nullif(f.name, F.lit(""))
    if isinstance(f.dataType, T.BooleanType):
        return F.nullif(f.name, F.lit(False))
    return None


def insert_rows(spark: SparkSession, name: str, rows: Sequence[tuple]) -> None:
    """INSERT literal rows, all in one write; columns in table order."""
    table = describe_table(spark, name)
    insert_into(spark, spark.createDataFrame(rows, table.schema), name)


def truncate_table(spark: SparkSession, name: str) -> None:
    """Remove all rows, those of a publish that was cut off included."""
    discard_publishing(spark, name)
    spark.sql(f"TRUNCATE TABLE {name}")


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop a table if it exists, with the folders that publishes left."""
    if spark.catalog.tableExists(name):
        discard_publishing(spark, name)
        spark.sql(f"DROP TABLE {name}")


def add_column(spark: SparkSession, name: str, column: str, data_type: str) -> None:
    finish_publishing_into(spark, name)
    spark.sql(f"ALTER TABLE {name} ADD COLUMNS (`{column}` {data_type})")


def update_column(spark: SparkSession, name: str, column: str, value: Column) -> None:
    """Whole-table UPDATE: the new rows are written aside, then replace the old ones."""
    finish_publishing_into(spark, name)
    with written_aside(spark.table(name).withColumn(column, value), "update") as rows:
        insert_into(spark, rows, name, overwrite=True, gather=False)


def table_names(base: str, count: int) -> list[str]:
    return [f"{base}{i}" for i in range(1, count + 1)]


def create_tables(spark: SparkSession, base: str, count: int, template: str) -> list[str]:
    """Run a CREATE statement holding ``{table_name}`` for ``base1 .. baseN``."""
    names = table_names(base, count)
    for name in names:
        spark.sql(template.format(table_name=name))
    return names


def drop_tables(spark: SparkSession, base: str, count: int) -> list[str]:
    names = table_names(base, count)
    for name in names:
        drop_table(spark, name)
    return names
