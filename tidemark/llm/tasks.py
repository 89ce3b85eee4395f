"""Running Python functions over Arrow batches inside Spark tasks."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


#: Bytes of an Arrow batch, so that a task's buffers stay far below an executor's memory.
BATCH_BYTES = 8 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"

BatchFunction = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def map_batches(df: DataFrame, function: BatchFunction, schema: StructType | str) -> DataFrame:
    """``df.mapInArrow`` over small batches, with this package on the workers' path.

    The path serves executors that see the driver's installation; elsewhere the package is
    installed or sent with ``--py-files``. The session's limit on the bytes of a batch is
    lowered to `BATCH_BYTES` if it is higher; a longer text is a batch of its own.
    """
    spark = df.sparkSession
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if _ROOT not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(p for p in (_ROOT, known) if p)
    if int(spark.conf.get(_BATCH_CONF).rstrip("bB")) > BATCH_BYTES:
        spark.conf.set(_BATCH_CONF, str(BATCH_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            give_back()

    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Return free memory to the system: workers outlive their tasks and share an executor's limit."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
