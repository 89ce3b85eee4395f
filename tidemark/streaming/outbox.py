"""Several sinks behind a durable outbox: one that is down does not hold up the stream.

Each batch is first written to the outbox, then handed to every sink that has had all batches
before it. A sink that fails keeps its place; the stream goes on, and the sink gets the batches
it missed, in order, when a later batch or :func:`drain` finds it up again. What each sink has
had is marked beside the batches. Sinks must be safe to repeat for the same batch number, since
a crash may fall between a write and its mark. Batches that all sinks have had are deleted.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, types as T

from tidemark.session import create_once, listed, remove_path
from tidemark.streaming.ingest import BATCH_FOLDER, BatchWriter, folder_per_batch


def outbox_writer(path: str, sinks: Mapping[str, BatchWriter]) -> BatchWriter:
    """Log each batch, then drain as far as the sinks can take it."""
    put = folder_per_batch(f"{path}/rows")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch_id <= min(_had(spark, path, name) for name in sinks):
            return
        put(batch, batch_id)
        create_once(spark, f"{path}/logged/{batch_id}", batch.schema.json())
        drain(spark, path, sinks)

    return write


def drain(spark: SparkSession, path: str, sinks: Mapping[str, BatchWriter]) -> dict[str, str]:
    """Hand waiting batches to the sinks, in order; returns the errors of sinks that are still behind."""
    logged = _numbers(spark, f"{path}/logged")
    errors = {}
    for name, sink in sinks.items():
        had = _had(spark, path, name)
        for batch_id in (n for n in logged if n > had):
            schema = T.StructType.fromJson(_json(spark, f"{path}/logged/{batch_id}"))
            try:
                sink(spark.read.schema(schema).parquet(f"{path}/rows/{BATCH_FOLDER}={batch_id}"), batch_id)
            except Exception as error:  # whatever a sink raises leaves its place as it was
                errors[name] = str(error)
                break
            create_once(spark, f"{path}/had/{name}/{batch_id}", "")
            if had >= 0:
                remove_path(spark, f"{path}/had/{name}/{had}")
            had = batch_id
    for batch_id in logged:
        if batch_id <= min(_had(spark, path, name) for name in sinks):
            remove_path(spark, f"{path}/rows/{BATCH_FOLDER}={batch_id}")
            remove_path(spark, f"{path}/logged/{batch_id}")
    return errors


def waiting(spark: SparkSession, path: str, sinks: Mapping[str, BatchWriter]) -> dict[str, int]:
    """How many batches each sink has still to get."""
    logged = _numbers(spark, f"{path}/logged")
    return {name: sum(n > _had(spark, path, name) for n in logged) for name in sinks}


def _had(spark: SparkSession, path: str, name: str) -> int:
    """The last batch a sink has had, -1 before the first."""
    return max(_numbers(spark, f"{path}/had/{name}"), default=-1)


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    return sorted(int(name) for name, _, _ in listed(spark, folder) if name.isdigit())


def _json(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path, wholetext=True).first()["value"])
