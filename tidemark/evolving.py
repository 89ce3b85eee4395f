"""Tables whose columns change: added, renamed and widened without rewriting files.

Every column has a number that it keeps for good. Files carry the numbers as Parquet field ids,
and are read by them: a column added later is NULL in older files, a renamed one is found under
its new name, and a widened one is converted by the reader. The columns lie in a log of
numbered versions beside the rows; two writers cannot take the same number.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import asdict, dataclass, replace

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.session import create_once, listed
from tidemark.streaming.ingest import BATCH_FOLDER, BatchWriter

_LOG, _ROWS = "_columns", "rows"
_READ_BY_ID = "spark.sql.parquet.fieldId.read.enabled"
#: Conversions that a Parquet reader makes without loss.
WIDER = {
    "tinyint": ("smallint", "int", "bigint", "double"),
    "smallint": ("int", "bigint", "double"),
    "int": ("bigint", "double"),
    "float": ("double",),
    "date": ("timestamp_ntz",),
}


@dataclass(frozen=True)
class NumberedColumn:
    id: int
    name: str
    type: str


@dataclass(frozen=True)
class Columns:
    """The columns of one version; `used` is the highest number ever given."""

    version: int
    used: int
    columns: tuple[NumberedColumn, ...]

    def schema(self) -> T.StructType:
        """Current names and types, with the numbers that files are read by."""
        return T.StructType([T.StructField(c.name, _parsed(c.type), True, {"parquet.field.id": c.id}) for c in self.columns])

    def named(self, name: str) -> NumberedColumn:
        for c in self.columns:
            if c.name == name:
                return c
        raise KeyError(f"no column {name}")


def _parsed(kind: str) -> T.DataType:
    return T.StructType.fromDDL(f"c {kind}")["c"].dataType


def columns(spark: SparkSession, path: str) -> Columns:
    """The newest version."""
    versions = sorted(name for name, _, _ in listed(spark, f"{path}/{_LOG}") if name.endswith(".json") and name[0] != ".")
    if not versions:
        return Columns(0, 0, ())
    entry = json.loads(spark.read.text(f"{path}/{_LOG}/{versions[-1]}", wholetext=True).first()["value"])
    return Columns(entry["version"], entry["used"], tuple(NumberedColumn(**c) for c in entry["columns"]))


def _change(spark: SparkSession, path: str, change: Callable[[Columns], Columns]) -> Columns:
    while True:
        now = columns(spark, path)
        new = change(now)
        if new == now:
            return now
        new = replace(new, version=now.version + 1)
        entry = {**asdict(new), "columns": [asdict(c) for c in new.columns]}
        if create_once(spark, f"{path}/{_LOG}/{new.version:020d}.json", json.dumps(entry)):
            return new


def add_columns(spark: SparkSession, path: str, new: dict[str, str]) -> Columns:
    """Columns by name and type; names that are there already are left alone."""

    def change(now: Columns) -> Columns:
        known = {c.name for c in now.columns}
        fresh = [n for n in new if n not in known]
        made = tuple(NumberedColumn(now.used + i, n, _parsed(new[n]).simpleString()) for i, n in enumerate(fresh, 1))
        return replace(now, used=now.used + len(made), columns=now.columns + made)

    return _change(spark, path, change)


def rename_column(spark: SparkSession, path: str, old: str, new: str) -> Columns:
    def change(now: Columns) -> Columns:
        if any(c.name == new for c in now.columns):
            raise ValueError(f"there is a column {new}")
        found = now.named(old)
        return replace(now, columns=tuple(replace(c, name=new) if c == found else c for c in now.columns))

    return _change(spark, path, change)


def drop_column(spark: SparkSession, path: str, name: str) -> Columns:
    """Forget a column; its number is not given again, so a later column of that name starts empty."""
    return _change(spark, path, lambda now: replace(now, columns=tuple(c for c in now.columns if c != now.named(name))))


def widen_column(spark: SparkSession, path: str, name: str, kind: str) -> Columns:
    """Give a column a type that holds all values of its own; files stay as they are."""

    def change(now: Columns) -> Columns:
        found = now.named(name)
        if found.type != kind and kind not in WIDER.get(found.type, ()):
            raise ValueError(f"{found.type} is not widened to {kind}")
        return replace(now, columns=tuple(replace(c, type=kind) if c == found else c for c in now.columns))

    return _change(spark, path, change)


def append(df: DataFrame, path: str) -> None:
    """Add rows by column name; columns that the rows lack are NULL, unknown ones an error."""
    _put(df, path, f"{path}/{_ROWS}", "append")


def _put(df: DataFrame, path: str, folder: str, mode: str) -> None:
    known = columns(df.sparkSession, path).schema()
    if unknown := set(df.columns) - set(known.names):
        raise KeyError(f"no columns {sorted(unknown)}")
    typed = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name, metadata=f.metadata) for f in known.fields if f.name in df.columns]
    df.select(*typed).write.mode(mode).parquet(folder)


def read(spark: SparkSession, path: str) -> DataFrame:
    """All rows under the current names and types.

    Turns reading by field id on in the session; files without ids are read by name as before.
    """
    spark.conf.set(_READ_BY_ID, "true")
    return spark.read.schema(columns(spark, path).schema()).option("recursiveFileLookup", True).parquet(f"{path}/{_ROWS}")


def evolving_writer(path: str) -> BatchWriter:
    """Append each batch, after adding the columns it brings and widening those it needs wider.

    A batch is a folder that a replay replaces. A column whose type neither holds the table's
    values nor is held by the table's type is an error.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        now = add_columns(spark, path, dict(batch.dtypes))
        for name, kind in batch.dtypes:
            known = now.named(name).type
            if kind != known and known not in WIDER.get(kind, ()):
                now = widen_column(spark, path, name, kind)
        _put(batch, path, f"{path}/{_ROWS}/{BATCH_FOLDER}={batch_id}", "overwrite")

    return write
