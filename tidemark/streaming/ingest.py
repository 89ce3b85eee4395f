"""Streams of rows into tables: append, several sinks, retries, new columns."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.session import path_exists

BatchWriter = Callable[[DataFrame, int], None]

#: Defaults of the polled and the micro-batched source.
POLL = {"processingTime": "60 seconds"}
ONCE = {"availableNow": True}
BATCH_FOLDER = "batch"
#: Text of records that do not fit their columns, and the entries beyond the widest table.
CORRUPT, MORE = "_corrupt_record", "_more"
#: New columns a table takes from one batch; further entries stay in a map column.
WIDEST = 1_000
#: Column types for the types of JSON values; all others become text.
_COLUMN_TYPES = {"BIGINT": "bigint", "DOUBLE": "double", "BOOLEAN": "boolean"}


def read_stream(
    spark: SparkSession, path: str, schema, fmt: str = "parquet", max_files: int | None = None, **options
) -> DataFrame:
    """Files landing below ``path``; ``max_files`` bounds a micro-batch."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def append_stream(
    stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, partition_by: Sequence[str] = ()
) -> StreamingQuery:
    """Append to Parquet, exactly once: the file sink logs which batch wrote which files."""
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.trigger(**(trigger or ONCE)).start()


def write_batches(stream: DataFrame, write: BatchWriter, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Hand each micro-batch to ``write``, which must be safe to repeat for the same batch number."""
    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or ONCE)).start()


def folder_per_batch(path: str) -> BatchWriter:
    """Write each batch to its own folder and replace that folder if the batch is replayed."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{BATCH_FOLDER}={batch_id}")

    return write


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """All batches written by :func:`folder_per_batch`; columns of some batches are NULL in others."""
    return spark.read.option("mergeSchema", True).parquet(path).drop(BATCH_FOLDER)


def to_all(*writers: BatchWriter) -> BatchWriter:
    """Send each batch to several sinks, computing it once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for writer in writers:
                writer(batch, batch_id)
        finally:
            batch.unpersist()

    return write


def retrying(writer: BatchWriter, attempts: int = 5, delay_seconds: float = 0.5) -> BatchWriter:
    """Repeat a failing write after a growing pause.

    When the attempts run out the query fails; started again from its checkpoint it replays
    the batch, so nothing is lost, and the writer's idempotence prevents copies.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        for attempt in range(1, attempts + 1):
            try:
                return writer(batch, batch_id)
            except Exception:
                if attempt == attempts:
                    raise
                time.sleep(delay_seconds * 2 ** (attempt - 1))

    return write


def widen(batch: DataFrame, value: str, known: dict[str, str], widest: int = WIDEST) -> DataFrame:
    """JSON text rows to columns: the known ones as typed, new keys with the type of their values.

    A record that is no JSON object, or has a value that does not fit its column, keeps its
    text in the column ``_corrupt_record``. Only names and types of new keys come to the
    driver; beyond ``widest`` of them, in order of their names, entries go as text into the map
    column ``_more``.
    """
    parsed = batch.select(F.try_parse_json(value).alias("_record"))
    entries = parsed.lateralJoin(batch.sparkSession.tvf.variant_explode(F.col("_record").outer()))
    entries = entries.where(~F.col("key").isin([*known, CORRUPT, MORE]))
    types = entries.groupBy("key").agg(F.schema_of_variant_agg("value").alias("type"))
    found = types.orderBy("key").limit(widest + 1).collect()
    new = {r["key"]: _column_type(r["type"]) for r in found[:widest]}
    fields = {**known, **new, CORRUPT: "string"}
    schema = ", ".join(f"`{c.replace('`', '``')}` {t}" for c, t in fields.items())
    record = F.from_json(value, schema, {"columnNameOfCorruptRecord": CORRUPT})
    if len(found) <= widest and MORE not in known:
        return batch.select(record.alias("r")).select("r.*")
    whole = F.from_json(value, "map<string,string>")
    more = F.map_filter(whole, lambda k, _: ~k.isin(list(fields)))
    return batch.select(record.alias("r"), more.alias(MORE)).select("r.*", MORE)


def _column_type(seen: str) -> str:
    return "double" if seen.startswith(("DECIMAL", "FLOAT")) else _COLUMN_TYPES.get(seen, "string")


def widening_writer(path: str, value: str, known: dict[str, str], widest: int = WIDEST) -> BatchWriter:
    """:func:`folder_per_batch` of :func:`widen`: a key keeps the type it had when it was first seen.

    A batch that brings more than ``widest`` new keys gets columns for the first of them; the
    values of the others are kept as text in ``_more``, whatever their type. A later batch with
    fewer new keys gives such a key a column from then on.

    The columns so far lie as JSON lines next to the batches, one file per batch that brought
    new ones, so a restarted stream goes on with them and reading needs no footers.
    """
    put = folder_per_batch(path)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = {**known, **_noted_columns(spark, path, batch_id)}
        wide = widen(batch, value, before, widest)
        new = [(batch_id, i, f.name, f.dataType.simpleString()) for i, f in enumerate(wide.schema.fields) if f.name not in before]
        if new:
            note = spark.createDataFrame(new, _NOTED).coalesce(1)
            note.write.mode("overwrite").json(f"{path}__columns/{BATCH_FOLDER}={batch_id}")
        put(wide, batch_id)

    return write


_NOTED = "id bigint, position int, name string, type string"


def _noted_columns(spark: SparkSession, path: str, before: int | None = None) -> dict[str, str]:
    if not path_exists(spark, f"{path}__columns"):
        return {}
    rows = spark.read.schema(_NOTED).json(f"{path}__columns").orderBy("id", "position").collect()
    return {r["name"]: r["type"] for r in rows if before is None or r["id"] < before}


def read_widened(spark: SparkSession, path: str, known: dict[str, str]) -> DataFrame:
    """All batches of a :func:`widening_writer`, with the columns noted next to them."""
    columns = {**known, **_noted_columns(spark, path)}
    schema = ", ".join(f"`{c.replace('`', '``')}` {t}" for c, t in columns.items())
    return spark.read.schema(schema).parquet(path).drop(BATCH_FOLDER)


def default_time(stream: DataFrame, ts: str) -> DataFrame:
    """Rows without a time get the time their batch was started."""
    return stream.withColumn(ts, F.coalesce(F.col(ts), F.current_timestamp().cast(stream.schema[ts].dataType)))
