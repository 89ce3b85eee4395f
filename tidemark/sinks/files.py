"""Exports, imports and routed writes."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from tidemark.sources.csv_files import infer_schema, read_csv, read_csv_text

PAGE_ROWS = 50_000
#: Times to the microsecond; quotes doubled and blanks kept. Text with line breaks reads back as
#: it was with ``multi_line``, other text without.
TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
CSV_TEXT = {**TIMES, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def export_csv(df: DataFrame, path: str, order: Sequence[str] | None = None, page_rows: int = PAGE_ROWS) -> None:
    """CSV files with a header, at most ``page_rows`` rows each.

    With ``order`` the rows are range-sorted, so file names sort in row order; no task sees it all.
    """
    if order:
        df = df.repartitionByRange(*order).sortWithinPartitions(*order)
    df.write.options(header=True, maxRecordsPerFile=page_rows, **CSV_TEXT).csv(path)


def export_json(df: DataFrame, path: str) -> None:
    """JSON lines with NULL fields kept."""
    df.write.options(ignoreNullFields=False, **TIMES).json(path)


def json_row(df: DataFrame, time_format: str = "yyyy-MM-dd HH:mm:ss.SSSSSS") -> Column:
    """Each row as a JSON object, NULLs kept and times as text."""

    def plain(name, kind):
        if kind.startswith("timestamp"):
            return F.date_format(name, time_format).alias(name)
        return F.col(name).cast("string").alias(name) if kind == "date" else F.col(name)

    return F.to_json(F.struct(*[plain(c, t) for c, t in df.dtypes]), {"ignoreNullFields": "false"})


def import_csv(spark: SparkSession, paths, table: str, overwrite: bool, schema=None, multi_line: bool = False) -> None:
    """Load CSV files into a catalog table: replace its rows, or add to them.

    Without a ``schema`` it is inferred from all values.
    """
    schema = schema or infer_schema(read_csv_text(spark, paths, multi_line))
    rows = read_csv(spark, paths, schema, multi_line)
    rows.write.mode("overwrite" if overwrite else "append").saveAsTable(table)


def route_by_key(df: DataFrame, key: str, path: str) -> None:
    """One folder per key value; a key holding much of the data is written by several tasks."""
    df.hint("rebalance", key).write.partitionBy(key).parquet(path)


def read_routed(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """What :func:`route_by_key` wrote, keys as ``schema`` has them: folder names alone would make text numbers."""
    return spark.read.schema(schema).parquet(path)


def write_observed(df: DataFrame, path: str, fmt: str = "parquet") -> dict:
    """Append, and report ``rows`` written, without a second pass over them, and ``seconds`` taken."""
    seen, start = Observation("ingest"), time.perf_counter()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("append").format(fmt).save(path)
    return {**seen.get, "seconds": time.perf_counter() - start}
