"""Time tables: a designated timestamp, a partition unit, and upsert keys over Parquet."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.session import folder_names, path_exists, remove_path, replace_folders

#: Stored partition column and the characters of ``yyyy-MM-dd HH`` it keeps; text order is time order.
PARTITION_COLUMN = "time_part"
_CHARS = {"HOUR": 13, "DAY": 10, "MONTH": 7, "YEAR": 4}
#: Partition of the rows without a time; it sorts after all others.
NO_TIME = "none"
_PROPERTY = "tidemark."
_NOTE = "__publishing"
_PUBLISHING, _RETIRED = "publishing", "retired"
_OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


@dataclass(frozen=True)
class TimeTable:
    """What a plain Parquet table does not say about itself."""

    schema: T.StructType
    ts: str | None = None
    unit: str = "NONE"
    keys: tuple[str, ...] = field(default=())
    dedup: bool = True

    def __post_init__(self):
        if self.unit != "NONE" and (self.unit not in _CHARS or self.ts is None):
            raise ValueError(f"cannot partition by {self.unit} on {self.ts}")
        if self.keys and self.ts is not None and self.ts not in self.keys:
            raise ValueError("upsert keys must contain the designated timestamp")

    @property
    def partitioned(self) -> bool:
        return self.unit != "NONE"

    @property
    def partition_columns(self) -> list[str]:
        return [PARTITION_COLUMN] if self.partitioned else []

    @property
    def stored_schema(self) -> T.StructType:
        extra = [T.StructField(c, T.StringType()) for c in self.partition_columns]
        return T.StructType([*self.schema.fields, *extra])

    def stamp(self, df: DataFrame) -> DataFrame:
        """Schema columns in order plus the stored partition column."""
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields]
        if self.partitioned:
            columns.append(self.partition_of(F.col(self.ts)).alias(PARTITION_COLUMN))
        return df.select(*columns)

    def partition_of(self, ts: Column) -> Column:
        """The partition of a time of the type the table stores."""
        kind = self.schema[self.ts].dataType
        return partition_value(ts.cast(kind), self.unit, kind)

    def properties(self) -> dict[str, str]:
        return {
            f"{_PROPERTY}ts": self.ts or "",
            f"{_PROPERTY}unit": self.unit,
            f"{_PROPERTY}keys": ",".join(self.keys),
            f"{_PROPERTY}dedup": str(self.dedup).lower(),
        }


def partition_value(ts: Column, unit: str, kind: T.DataType) -> Column:
    """The partition of a time, the same whatever the session's time zone: instants count in UTC."""
    if isinstance(kind, T.TimestampType):
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        ts = F.timestamp_add("MICROSECOND", F.unix_micros(ts), epoch)
    text = F.substring(ts.cast("timestamp_ntz").cast("string"), 1, _CHARS[unit])
    return F.coalesce(F.replace(text, F.lit(" "), F.lit("-")), F.lit(NO_TIME))


def create_statement(name: str, table: TimeTable) -> str:
    """CREATE TABLE IF NOT EXISTS with partitioning, and the time-table facts as properties."""
    columns = ",\n  ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.stored_schema.fields)
    parts = f"\nPARTITIONED BY ({PARTITION_COLUMN})" if table.partitioned else ""
    props = ", ".join(f"'{k}'='{v}'" for k, v in table.properties().items())
    return f"CREATE TABLE IF NOT EXISTS {name} (\n  {columns}\n) USING parquet{parts}\nTBLPROPERTIES ({props})"


def create_table(spark: SparkSession, name: str, table: TimeTable) -> None:
    spark.sql(create_statement(name, table))


def describe_table(spark: SparkSession, name: str) -> TimeTable:
    """Read back what :func:`create_table` recorded."""
    props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    unit = props.get(f"{_PROPERTY}unit", "NONE")
    stored = spark.table(name).schema
    schema = T.StructType([f for f in stored.fields if unit == "NONE" or f.name != PARTITION_COLUMN])
    keys = props.get(f"{_PROPERTY}keys", "")
    return TimeTable(
        schema=schema,
        ts=props.get(f"{_PROPERTY}ts") or None,
        unit=unit,
        keys=tuple(k for k in keys.split(",") if k),
        dedup=props.get(f"{_PROPERTY}dedup", "true") == "true",
    )


def set_property(spark: SparkSession, name: str, key: str, value: str) -> None:
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{_PROPERTY}{key}'='{value}')")


def get_property(spark: SparkSession, name: str, key: str) -> str | None:
    props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    return props.get(f"{_PROPERTY}{key}")


def set_dedup(spark: SparkSession, name: str, enabled: bool) -> None:
    """Switch a table between upsert and plain append."""
    set_property(spark, name, "dedup", str(enabled).lower())


def time_between(df: DataFrame, ts: str, low, high, unit: str | None = None) -> DataFrame:
    """Rows with ``low <= ts <= high``.

    For a time table pass its ``unit``: a range on ``ts`` alone prunes no directories, so the
    same range is also put on the stored partition column.
    """
    kind = df.schema[ts].dataType
    low, high = F.lit(low).cast(kind), F.lit(high).cast(kind)
    rows = df.where(F.col(ts).between(low, high))
    if unit and unit != "NONE":
        rows = rows.where(F.col(PARTITION_COLUMN).between(partition_value(low, unit, kind), partition_value(high, unit, kind)))
    return rows


def write_time_table(
    df: DataFrame, path: str, table: TimeTable, mode: str = "append", compression: str | None = None
) -> None:
    """Write ``df`` below ``path``, one folder per time partition.

    The rebalance hint gathers a partition's rows into few files and lets a partition that
    holds much of the data be written by several tasks. A publish that was cut off is ended
    first, so that it cannot replace what is written here.
    """
    finish_publishing(df.sparkSession, path, table)
    _write(df, path, table, mode, compression)


def _write(df: DataFrame, path: str, table: TimeTable, mode: str, compression: str | None = None) -> None:
    stamped = table.stamp(df)
    if table.partitioned:
        stamped = stamped.hint("rebalance", PARTITION_COLUMN)
    writer = stamped.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    if compression:
        writer = writer.option("compression", compression)
    if table.partitioned:
        writer = writer.partitionBy(PARTITION_COLUMN)
    writer.parquet(path)


def insert_into(
    spark: SparkSession, df: DataFrame, name: str, overwrite: bool | str = False, gather: bool = True
) -> None:
    """INSERT … SELECT into a catalog table, with the table's own types.

    ``overwrite`` replaces all rows, or with ``"touched"`` those of the partitions that ``df``
    has rows in. ``gather=False`` skips the shuffle, for rows that already lie by time partition.
    A publish that was cut off is ended first.
    """
    finish_publishing_into(spark, name)
    _insert(spark, df, name, overwrite, gather)


def _insert(spark: SparkSession, df: DataFrame, name: str, overwrite: bool | str, gather: bool = True) -> None:
    table = describe_table(spark, name)
    stamped = table.stamp(df)
    if table.partitioned and gather:
        stamped = stamped.hint("rebalance", PARTITION_COLUMN)
    with _overwrite_mode(spark, "dynamic" if overwrite == "touched" else "static"):
        stamped.write.insertInto(name, overwrite=bool(overwrite))


@contextlib.contextmanager
def _overwrite_mode(spark: SparkSession, mode: str) -> Iterator[None]:
    before = spark.conf.get(_OVERWRITE_MODE)
    spark.conf.set(_OVERWRITE_MODE, mode)
    try:
        yield
    finally:
        spark.conf.set(_OVERWRITE_MODE, before)


class PublishPendingError(RuntimeError):
    """A table is between two states."""


def publish(merged: DataFrame, path: str, table: TimeTable) -> None:
    """Put ``merged`` in place of the partitions it has rows in, or of an unpartitioned table.

    The rows are written once, beside the table and already by partition; publishing only
    moves folders.
    """
    spark = merged.sparkSession
    staged = f"{path}__staged-{uuid.uuid4().hex}"
    _write(merged, staged, table, "overwrite")
    note = spark.createDataFrame([(staged,)], "value string").coalesce(1)
    note.write.mode("overwrite").text(path + _NOTE)
    finish_publishing(spark, path, table)


def finish_publishing(spark: SparkSession, path: str, table: TimeTable) -> None:
    """Put staged partitions in place, if a note next to the table says that some are waiting.

    Replacing several folders is not atomic. Should the driver die in the middle, the folders
    not moved yet still lie in the staged copy, and whatever writes next moves them first.
    """
    if not path_exists(spark, path + _NOTE):
        return
    noted = spark.read.schema("value string").text(path + _NOTE).collect()
    if noted:
        replace_folders(spark, noted[0]["value"], path, table.partitioned)
        # the catalog of files that this session keeps by path
        spark.catalog.refreshByPath(path)
    remove_path(spark, path + _NOTE)


def publish_into(merged: DataFrame, name: str) -> None:
    """Put ``merged`` in place of a catalog table's partitions it has rows in, or of all rows of one without.

    The rows are written once, to a folder of their own; the catalog is then told where the
    partitions lie now. Old folders stay until the next publish, so a reader sees the old or
    the new rows of a partition and never none.
    """
    spark = merged.sparkSession
    table, location = describe_table(spark, name), _location(spark, name)
    # below the table's folder, where names with an underscore are no data; beside it if the table itself moves
    staged = f"{location}/_rows-{uuid.uuid4().hex}" if table.partitioned else f"{location}__rows-{uuid.uuid4().hex}"
    _write(merged, staged, table, "overwrite")
    set_property(spark, name, _PUBLISHING, staged)
    finish_publishing_into(spark, name)


def finish_publishing_into(spark: SparkSession, name: str) -> None:
    """The same for a catalog table, whose note is a property."""
    staged = get_property(spark, name, _PUBLISHING)
    if not staged:
        return
    _drop_retired(spark, name)
    retired = _switch(spark, name, staged)
    set_property(spark, name, _RETIRED, ",".join(retired))
    set_property(spark, name, _PUBLISHING, "")


def discard_publishing(spark: SparkSession, name: str) -> None:
    """Forget a publish that was cut off, and what earlier ones left, before all rows go."""
    staged = get_property(spark, name, _PUBLISHING)
    _drop_retired(spark, name)
    if staged:
        set_property(spark, name, _PUBLISHING, "")
        if staged not in _locations(spark, name):
            remove_path(spark, staged)


def _drop_retired(spark: SparkSession, name: str) -> None:
    for folder in filter(None, (get_property(spark, name, _RETIRED) or "").split(",")):
        remove_path(spark, folder)
    set_property(spark, name, _RETIRED, "")


def _switch(spark: SparkSession, name: str, staged: str) -> list[str]:
    """Tell the catalog that partitions, or the table, lie in ``staged``; returns the folders they lay in. Safe to repeat."""
    if not describe_table(spark, name).partitioned:
        old = _location(spark, name)
        if old == staged:
            return []
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{staged}'")
        spark.catalog.refreshTable(name)
        return [old]
    values = [f[len(PARTITION_COLUMN) + 1 :] for f in folder_names(spark, staged) if f.startswith(f"{PARTITION_COLUMN}=")]
    known = {r["partition"].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    retired = []
    for value in sorted(values):
        spec, folder = f"PARTITION ({PARTITION_COLUMN}='{value}')", f"{staged}/{PARTITION_COLUMN}={value}"
        if value not in known:
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {spec} LOCATION '{folder}'")
            continue
        old = _location(spark, name, spec)
        if old != folder:
            spark.sql(f"ALTER TABLE {name} {spec} SET LOCATION '{folder}'")
            retired.append(old)
    spark.catalog.refreshTable(name)
    return retired


def _location(spark: SparkSession, name: str, spec: str = "") -> str:
    """The folder of a table or of one of its partitions."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name} {spec}").collect()
    # a partition's description holds its own folder first, then the table's
    return next(r["data_type"] for r in described if r["col_name"] == "Location").rstrip("/")


def _locations(spark: SparkSession, name: str) -> set[str]:
    """The folders a table's rows lie in, and those around them."""
    found = {_location(spark, name)}
    if describe_table(spark, name).partitioned:
        for row in spark.sql(f"SHOW PARTITIONS {name}").collect():
            folder = _location(spark, name, f"PARTITION ({PARTITION_COLUMN}='{row['partition'].split('=', 1)[1]}')")
            found |= {folder, folder.rsplit("/", 1)[0]}
    return found


def read_time_table(spark: SparkSession, path: str, table: TimeTable) -> DataFrame:
    """All rows, with the partition column kept as text for pruning.

    While a publish is cut off, partitions may be missing: reading fails until a write or
    :func:`finish_publishing` has ended it.
    """
    if path_exists(spark, path + _NOTE):
        raise PublishPendingError(f"{path} waits for finish_publishing")
    return _stored(spark, path, table)


def _stored(spark: SparkSession, path: str, table: TimeTable) -> DataFrame:
    return spark.read.schema(table.stored_schema).parquet(path)


def columns_of(table: TimeTable) -> Sequence[str]:
    return [f.name for f in table.schema.fields]
