"""Export manifests: warehouse column types to ours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.sources.csv_files import SPARK_TYPES

#: Warehouse type names by the column type they become; others become STRING.
WAREHOUSE_TYPES = {
    "SYMBOL": ["character varying", "char", "character", "nchar", "varchar", "nvarchar", "bpchar"],
    "STRING": ["text"],
    "SHORT": ["smallint", "int2"],
    "INT": ["integer", "int", "int4"],
    "LONG": ["bigint", "int8"],
    "FLOAT": ["float4"],
    "DOUBLE": ["decimal", "float8", "float"],
    "BOOLEAN": ["boolean"],
    "DATE": ["date"],
    "TIMESTAMP": ["timestamp", "timestamptz"],
    "BINARY": ["varbyte"],
}

_MANIFEST = "schema struct<elements: array<struct<name: string, type: struct<base: string>>>>"


def column_type(base: Column) -> Column:
    """The column type name for a warehouse type name."""
    known = None
    for name, spellings in WAREHOUSE_TYPES.items():
        test = base.isin(spellings)
        known = F.when(test, name) if known is None else known.when(test, name)
    return known.otherwise("STRING")


def manifest_columns(spark: SparkSession, path: str, by: str | None = None, multi_line: bool = True) -> DataFrame:
    """(position, column_name, column_type) listed by manifest JSON files.

    Without ``multi_line`` every line is a manifest of its own. ``by`` is a field, with its
    type, that tells several manifests apart; it comes first.
    """
    fields = _MANIFEST if by is None else f"{by}, {_MANIFEST}"
    raw = spark.read.schema(fields).option("multiLine", multi_line).json(path)
    own = [by.split()[0]] if by else []
    listed = raw.select(*own, F.posexplode("schema.elements").alias("position", "e"))
    kind = column_type(F.col("e.type.base"))
    return listed.select(*own, "position", F.col("e.name").alias("column_name"), kind.alias("column_type"))


def schema_of(columns: DataFrame) -> T.StructType:
    rows = columns.orderBy("position").collect()
    return T.StructType([T.StructField(r["column_name"], SPARK_TYPES[r["column_type"]]) for r in rows])
