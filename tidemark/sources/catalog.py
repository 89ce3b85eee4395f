"""The catalog as relations. These rows describe tables, they are not table data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.timetable import PARTITION_COLUMN, describe_table

_TABLES = "name string, designatedTimestamp string, partitionBy string, dedup boolean"
_COLUMNS = "position int, column_name string, column_type string, designated boolean, upsertKey boolean"


def tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    rows = []
    for t in spark.catalog.listTables(database):
        if t.isTemporary:
            continue
        meta = describe_table(spark, ".".join([*(t.namespace or []), t.name]))
        rows.append((t.name, meta.ts, meta.unit, bool(meta.keys) and meta.dedup))
    return spark.createDataFrame(rows, _TABLES)


def table_columns(spark: SparkSession, name: str) -> DataFrame:
    meta = describe_table(spark, name)
    rows = [
        (i, f.name, f.dataType.simpleString(), f.name == meta.ts, f.name in meta.keys)
        for i, f in enumerate(meta.schema.fields)
    ]
    return spark.createDataFrame(rows, _COLUMNS)


def partitions(spark: SparkSession, name: str) -> DataFrame:
    """Time partitions of a table, oldest first by text order."""
    listed = spark.sql(f"SHOW PARTITIONS {name}")
    return listed.selectExpr(f"split(partition, '=', 2)[1] AS {PARTITION_COLUMN}")
