"""Copies of snapshot tables that go on where they were cut off.

A copy is made in steps of some of the source's files. A step writes their rows to a folder of
its own, with a ledger of the files, their rows and a checksum over all values, checks what it
wrote against the ledger, and commits rows and ledger as one. Started again, a copy reads the
ledgers of the target and takes up only files that are in none. The source's snapshot is
pinned by the first step, so all steps copy the same table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark import snapshots
from tidemark.session import materialize

LEDGER = "_ledger"
STEP_BYTES = 64 << 30
_FILES = "file string, bytes long, rows long, checksum long"


class ChecksumError(RuntimeError):
    """What a step wrote is not what it read."""


@dataclass(frozen=True)
class Copied:
    """The source's snapshot, and the files that this run and earlier ones copied."""

    version: int
    files: int
    before: int


def copy_snapshot(spark: SparkSession, source: str, target: str, layout: snapshots.Layout, step_bytes: int = STEP_BYTES, most_steps: int | None = None) -> Copied:
    """Copy the rows of a snapshot table, in steps of about `step_bytes`; safe to run again after any failure.

    Steps follow the order of the source's commits, so a target with keys merges as the source
    does; `most_steps` stops after so many. A finished copy is brought up to a newer snapshot if the source only added parts.
    """
    begun = snapshots.latest(spark, target)
    pinned = begun.batches.get(_name(source)) if begun.notes else None
    version = snapshots.latest(spark, source).version if pinned is None else pinned
    done = ledger(spark, target)
    todo = materialize(_left(spark, source, layout, version, done), "to-copy")
    newest = snapshots.latest(spark, source)
    if pinned is not None and newest.version > version and todo.isEmpty():
        gone = set(snapshots.read_entry(spark, source, version).parts) - set(newest.parts)
        if gone:
            raise ValueError(f"{source} has replaced parts since it was copied: copy it to a new target")
        version = newest.version
        todo = materialize(_left(spark, source, layout, version, done), "to-copy")
    before, copied, made = done.count(), 0, 0
    # commits in order, and a commit's files dealt into steps
    for order, size in sorted((r["order"], r["size"]) for r in todo.groupBy("order").agg(F.sum("bytes").alias("size")).collect()):
        steps = -(-max(1, size) // step_bytes)
        for step in range(steps):
            chosen = todo.where((F.col("order") == order) & (F.pmod(F.xxhash64("file"), F.lit(steps)) == step))
            files = {r["file"]: r["bytes"] for r in chosen.collect()}
            if most_steps is not None and made >= most_steps:
                return Copied(version, copied, before)
            if files:
                _step(spark, source, target, layout, files, version)
                copied, made = copied + len(files), made + 1
    return Copied(version, copied, before)


def _name(source: str) -> str:
    return f"copy of {source}"


def _left(spark: SparkSession, source: str, layout: snapshots.Layout, version: int, done: DataFrame) -> DataFrame:
    """(file, bytes, order) of the snapshot's files that are in no ledger."""
    parts = snapshots.read_entry(spark, source, version).parts if version else ()
    if not parts:
        return spark.createDataFrame([], "file string, bytes long, order long")
    folders = {snapshots.part_folder("", layout, p): p.order for p in parts}
    # lists the files without reading them
    found = spark.read.format("binaryFile").load([f"{source}{f}" for f in folders])
    listed = found.select(F.col("path").alias("file"), F.col("length").alias("bytes"), F.regexp_extract("path", r"(/write=[^/]*(?:/[^/=]+=[^/]*)?)/[^/]*$", 1).alias("folder"))
    orders = spark.createDataFrame(list(folders.items()), "folder string, order long")
    return listed.join(orders, "folder").join(done.select("file"), "file", "left_anti").select("file", "bytes", "order")


def _step(spark: SparkSession, source: str, target: str, layout: snapshots.Layout, files: dict[str, int], version: int) -> None:
    schema = layout.stored_schema
    rows = spark.read.schema(schema.add(snapshots.WRITE_COLUMN, "string")).option("basePath", source).parquet(*files)
    names = [f.name for f in layout.schema.fields]
    checksum = F.bit_xor(F.xxhash64(*names))
    read = materialize(
        rows.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count("*").alias("rows"), checksum.alias("checksum")), "copy-ledger"
    )
    sizes = spark.createDataFrame(list(files.items()), "file string, bytes long")
    same = F.regexp_replace("file", r"^file:/+", "/") == F.regexp_replace("path", r"^file:/+", "/")
    # a file without rows is in the ledger too
    told = sizes.join(read, same, "left").select("file", "bytes", F.coalesce("rows", F.lit(0)).alias("rows"), F.coalesce("checksum", F.lit(0)).alias("checksum"))
    parts = snapshots.write_as_arranged(rows.select(*[f.name for f in layout.stored_schema.fields]), target, layout)
    write = parts[0].write if parts else None
    if write is None:
        # nothing but files without rows: their ledger goes to an empty write
        return
    folder = f"{target}/{snapshots.WRITE_COLUMN}={write}"
    told.write.mode("overwrite").parquet(f"{target}/{LEDGER}/{write}")
    wanted = read.agg(F.sum("rows"), F.bit_xor("checksum")).first()
    written = spark.read.schema(layout.stored_schema).parquet(folder).agg(F.count("*"), checksum).first()
    if tuple(wanted) != tuple(written):
        raise ChecksumError(f"{folder} holds {tuple(written)}, read were {tuple(wanted)}")
    snapshots.transact(spark, target, lambda base: snapshots.Change("copy", tuple(parts), batch=(_name(source), version), note=write))


def ledger(spark: SparkSession, target: str) -> DataFrame:
    """(file, bytes, rows, checksum) of all source files whose rows a table holds, steps that were not committed left out."""
    folders = [f"{target}/{LEDGER}/{note}" for note in snapshots.latest(spark, target).notes]
    return spark.read.schema(_FILES).parquet(*folders) if folders else spark.createDataFrame([], _FILES)
