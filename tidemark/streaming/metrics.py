"""Rows, seconds and lag of every micro-batch, appended to a table by a query listener."""

from __future__ import annotations

import threading
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

_NEWEST = "tidemark_newest"
_SCHEMA = "query string, run string, batch bigint, rows bigint, seconds double, lag_seconds double, at timestamp"


def observed(stream: DataFrame, ts: str) -> DataFrame:
    """`stream` with its newest time reported by each batch, from which the lag is taken."""
    return stream.observe(_NEWEST, F.max(F.col(ts).cast("timestamp")).cast("double").alias("newest"))


class BatchMetrics(StreamingQueryListener):
    """Appends a row per micro-batch of every query of the session to Parquet files at `path`.

    Register it with ``spark.streams.addListener``. The lag is the time from the newest event of
    an :func:`observed` stream to the start of its batch; other streams have none. Events reach
    a listener after the batch, so wait with :meth:`finished` before reading.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._ended: dict[str, threading.Event] = defaultdict(threading.Event)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        seconds = p.durationMs.get("triggerExecution", 0) / 1000
        seen = p.observedMetrics.get(_NEWEST)
        row = (str(p.id), str(p.runId), p.batchId, p.numInputRows, seconds, None if seen is None else seen["newest"], p.timestamp)
        raw = self.spark.createDataFrame([row], "query string, run string, batch bigint, rows bigint, seconds double, newest double, at string")
        at = F.col("at").cast("timestamp")
        told = raw.select("query", "run", "batch", "rows", "seconds", (at.cast("double") - F.col("newest")).alias("lag_seconds"), at.alias("at"))
        told.coalesce(1).write.mode("append").parquet(self.path)

    def onQueryTerminated(self, event) -> None:
        self._ended[str(event.runId)].set()

    def finished(self, query: StreamingQuery, timeout: float = 60) -> bool:
        """Wait until the events of a query that has ended are in the table."""
        return self._ended[str(query.runId)].wait(timeout)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """One row per query and batch: of a batch that was replayed, the last run's; batches without rows are left out."""
    last = W.partitionBy("query", "batch").orderBy(F.desc("at"))
    rows = spark.read.schema(_SCHEMA).parquet(path).where("rows > 0")
    return rows.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")
