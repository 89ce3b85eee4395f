"""Streaming upsert: later arrivals win, however late they are."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidemark import snapshots
from tidemark.operators.upsert import upsert
from tidemark.streaming.ingest import BatchWriter, append_stream, write_batches
from tidemark.timetable import TimeTable


def upsert_writer(path: str, table: TimeTable, arrival: Sequence[str]) -> BatchWriter:
    """Upsert each batch; ``arrival`` orders rows within it, and later batches beat earlier ones."""

    def write(batch: DataFrame, batch_id: int) -> None:
        upsert(batch, path, table, arrival)

    return write


def upsert_stream(
    stream: DataFrame, path: str, table: TimeTable, arrival: Sequence[str], checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """No watermark: a row for an old partition rewrites that partition. Replays change nothing.

    While the table's dedup is off its rows are appended, exactly once, by the file sink.
    """
    if not table.dedup or not table.keys:
        return append_stream(table.stamp(stream), path, checkpoint, trigger, table.partition_columns)
    return write_batches(stream, upsert_writer(path, table, arrival), checkpoint, trigger)


def delta_writer(path: str, layout: snapshots.Layout, arrival: Sequence[str], stream: str = "stream", compact_every: int = 8) -> BatchWriter:
    """Upsert each batch into a snapshot table by adding its own rows; every `compact_every` batches small parts are merged.

    A late row adds a small part to its old partition instead of rewriting it. The table knows
    the last batch of each `stream`, so a replayed batch is left out.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        snapshots.upsert_delta(batch, path, layout, arrival, (stream, batch_id))
        if (batch_id + 1) % compact_every == 0:
            snapshots.compact(batch.sparkSession, path, layout)

    return write


def upsert_delta_stream(
    stream: DataFrame,
    path: str,
    layout: snapshots.Layout,
    arrival: Sequence[str],
    checkpoint: str,
    trigger: dict | None = None,
    compact_every: int = 8,
) -> StreamingQuery:
    """:func:`delta_writer` as a stream; read the table with :func:`tidemark.snapshots.read`."""
    return write_batches(stream, delta_writer(path, layout, arrival, checkpoint, compact_every), checkpoint, trigger)
