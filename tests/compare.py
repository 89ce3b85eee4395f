"""Compare a Spark result with the SQL result over the same Parquet files, value by value."""

import glob
import os
from datetime import date, datetime
from decimal import Decimal

import duckdb


def views(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return ("float", "nan" if value != value else repr(value + 0.0))
    if isinstance(value, bool):
        return ("bool", value)
    if isinstance(value, int):
        return ("int", value)
    if isinstance(value, Decimal):
        return ("decimal", str(value.normalize()))
    if isinstance(value, (datetime, date)):
        return ("time", value.isoformat())
    return (type(value).__name__, str(value))


def rows_of(arrow):
    names = sorted(arrow.column_names)
    columns = [[_plain(v) for v in arrow.column(n).to_pylist()] for n in names]
    return names, sorted(zip(*columns)) if columns else []


def difference(spark_df, connection, sql):
    """None if both sides agree, else a short description."""
    ours_names, ours = rows_of(spark_df.toArrow())
    theirs_names, theirs = rows_of(connection.sql(sql).to_arrow_table())
    if ours_names != theirs_names:
        return f"columns {ours_names} != {theirs_names}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)}"
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(wrong)} of {len(ours)} rows differ, first {wrong[0]}" if wrong else None
