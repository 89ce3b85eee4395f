"""Tables as numbered snapshots: a log says which folders of Parquet files are live.

Every write goes to a folder of its own and is invisible until a log entry names it. An entry
lists all live parts, a part being what one write left in one partition, and is created under
the next number only if no other writer took that number: so a snapshot is replaced as a whole,
a reader sees one snapshot however many partitions a later write changes, and a write that was
cut off leaves the table as it was. A writer that loses the number looks at what has changed:
if it was none of the partitions it read, its parts are added to the newer snapshot as they
are, else it merges again.

Upserts come in two kinds. `upsert` merges the partitions it touches and puts new parts in
place of theirs. `upsert_delta` only adds sorted parts of the batch's own rows; readers then
keep the last row of each key, later commits first, and only in partitions that have several
parts. `compact` merges parts of like sizes, so that a row is rewritten about log(table size /
batch size) times.

Log entries hold names and sizes of parts, so they grow with partitions and waiting deltas, not
with rows or files; `expire` removes old entries and the folders that no entry names any more.

Taking a number is atomic where the file system renames without overwriting in one step, as
HDFS does, and on local disks. Stores that can only copy need a lock of their own around
`_commit`.
"""

from __future__ import annotations

import json
import time
import uuid
from collections import defaultdict
from collections.abc import Callable, Iterable, Sequence
from dataclasses import asdict, dataclass, field, replace
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.operators.ordering import pick_last
from tidemark.operators.upsert import merge_keep_last
from tidemark.session import create_once, listed, path_exists, remove_path, written_aside

LOG = "_log"
WRITE_COLUMN = "write"
_ORDER = "_order"
#: Parts of like sizes that are merged at once, and how much larger the next older part may be.
MERGE_AT, MERGE_RATIO = 4, 2.0


class Layout(Protocol):
    """What a table's rows and folders look like; time tables are layouts."""

    schema: T.StructType
    keys: tuple[str, ...]

    @property
    def partition_columns(self) -> list[str]: ...

    @property
    def stored_schema(self) -> T.StructType: ...

    def stamp(self, df: DataFrame) -> DataFrame: ...


@dataclass(frozen=True)
class Part:
    """What one write left in one partition; `order` is the snapshot that brought its newest rows."""

    write: str
    partition: str
    order: int
    bytes: int


@dataclass(frozen=True)
class Snapshot:
    version: int = 0
    operation: str = "create"
    parts: tuple[Part, ...] = ()
    #: The last batch taken over from each stream.
    batches: dict[str, int] = field(default_factory=dict)
    #: Names of what was noted beside the table since it was last emptied.
    notes: tuple[str, ...] = ()

    def by_partition(self) -> dict[str, list[Part]]:
        """Parts of each partition, oldest first."""
        found = defaultdict(list)
        for part in sorted(self.parts, key=lambda p: p.order):
            found[part.partition].append(part)
        return found


class ConflictError(RuntimeError):
    """Other writers took every number that was tried."""


# -- the log ----------------------------------------------------------------------------------


def latest(spark: SparkSession, path: str) -> Snapshot:
    """The newest snapshot; an empty one of number 0 before the first write."""
    versions = _versions(spark, path)
    return read_entry(spark, path, versions[-1]) if versions else Snapshot()


def read_entry(spark: SparkSession, path: str, version: int) -> Snapshot:
    entry = json.loads(spark.read.text(_entry_path(path, version), wholetext=True).first()["value"])
    return Snapshot(entry["version"], entry["operation"], tuple(Part(**p) for p in entry["parts"]), entry["batches"], tuple(entry["notes"]))


def _entry_path(path: str, version: int) -> str:
    return f"{path}/{LOG}/{version:020d}.json"


def _versions(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(name[:-5]) for name, _, _ in listed(spark, f"{path}/{LOG}") if name.endswith(".json") and name[0] != ".")


def _commit(spark: SparkSession, path: str, snapshot: Snapshot) -> bool:
    """Create the entry of `snapshot`; False if its number is taken."""
    text = json.dumps({**asdict(snapshot), "parts": [asdict(p) for p in snapshot.parts]})
    return create_once(spark, _entry_path(path, snapshot.version), text)


# -- changes ----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Change:
    """Parts to put in place of others. `reads` are the partitions the change was made from, None for all."""

    operation: str
    added: tuple[Part, ...] = ()
    removed: tuple[Part, ...] = ()
    reads: frozenset[str] | None = frozenset()
    batch: tuple[str, int] | None = None
    note: str | None = None


def _changed(base: Snapshot, change: Change) -> Snapshot:
    version = base.version + 1
    gone = set(change.removed)
    # new rows are as new as the snapshot; merged ones keep the order they were given
    added = tuple(p if p.order else replace(p, order=version) for p in change.added)
    batches = {**base.batches, **dict([change.batch] if change.batch else [])}
    notes = (() if change.reads is None else base.notes) + ((change.note,) if change.note else ())
    return Snapshot(version, change.operation, tuple(p for p in base.parts if p not in gone) + added, batches, notes)


def _still_holds(change: Change, before: Snapshot, now: Snapshot) -> bool:
    """Whether what the change was made from is the same in a newer snapshot."""
    if change.reads is None:
        return set(before.parts) == set(now.parts)
    old, new = before.by_partition(), now.by_partition()
    return all(set(old.get(p, ())) == set(new.get(p, ())) for p in change.reads)


def transact(spark: SparkSession, path: str, build: Callable[[Snapshot], Change | None], attempts: int = 20) -> Snapshot:
    """Apply the change that `build` makes from a snapshot; build again only if what it read has changed."""
    base = latest(spark, path)
    change = build(base)
    for _ in range(attempts):
        if change is None:
            return base
        snapshot = _changed(base, change)
        if _commit(spark, path, snapshot):
            return snapshot
        now = latest(spark, path)
        if change.batch and now.batches.get(change.batch[0], -1) >= change.batch[1]:
            return now
        if not _still_holds(change, base, now):
            change = build(now)
        base = now
    raise ConflictError(f"{path}: no number was free in {attempts} attempts")


# -- writing ----------------------------------------------------------------------------------


def _write(df: DataFrame, path: str, layout: Layout, sort: Sequence[str] = (), stamped: bool = False) -> list[Part]:
    """Write rows to a folder of their own, and say what they left in each partition."""
    rows = df if stamped else layout.stamp(df)
    if layout.partition_columns:
        rows = rows.hint("rebalance", *layout.partition_columns)
    if sort:
        rows = rows.sortWithinPartitions(*layout.partition_columns, *sort)
    return write_as_arranged(rows, path, layout)


def write_as_arranged(rows: DataFrame, path: str, layout: Layout) -> list[Part]:
    """Write stamped rows as they lie to a folder of their own."""
    spark, name = rows.sparkSession, uuid.uuid4().hex
    folder = f"{path}/{WRITE_COLUMN}={name}"
    writer = rows.write.mode("overwrite")
    if layout.partition_columns:
        writer = writer.partitionBy(*layout.partition_columns)
    writer.parquet(folder)
    return written_parts(spark, path, layout, name)


def written_parts(spark: SparkSession, path: str, layout: Layout, name: str) -> list[Part]:
    """The parts of one write; their order is open until they are committed."""
    folder = f"{path}/{WRITE_COLUMN}={name}"
    if not layout.partition_columns:
        return [Part(name, "", 0, _size(spark, folder))]
    prefix = f"{layout.partition_columns[0]}="
    found = [n[len(prefix) :] for n, is_folder, _ in listed(spark, folder) if is_folder and n.startswith(prefix)]
    return [Part(name, value, 0, _size(spark, f"{folder}/{prefix}{value}")) for value in sorted(found)]


def _size(spark: SparkSession, folder: str) -> int:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(jvm_path).getLength()


def append(df: DataFrame, path: str, layout: Layout, batch: tuple[str, int] | None = None) -> Snapshot:
    """Add rows as they are. With `batch` (stream, number) a batch that is in already is left out."""
    return _add(df, path, layout, "append", (), batch)


def _add(df: DataFrame, path: str, layout: Layout, operation: str, sort: Sequence[str], batch: tuple[str, int] | None) -> Snapshot:
    spark = df.sparkSession
    if batch and latest(spark, path).batches.get(batch[0], -1) >= batch[1]:
        return latest(spark, path)
    added = tuple(_write(df, path, layout, sort))
    return transact(spark, path, lambda base: Change(operation, added, batch=batch))


def overwrite(df: DataFrame, path: str, layout: Layout) -> Snapshot:
    """Replace all rows, whatever other writers add meanwhile."""
    spark, added = df.sparkSession, None
    added = tuple(_write(df, path, layout))
    return transact(spark, path, lambda base: Change("overwrite", added, base.parts, None))


def truncate(spark: SparkSession, path: str) -> Snapshot:
    """Remove all rows; snapshots before can still be read until they expire."""
    return transact(spark, path, lambda base: Change("truncate", (), base.parts, None))


def drop(spark: SparkSession, path: str) -> bool:
    """Delete the table with its log, and what unfinished writes left."""
    return remove_path(spark, path)


def upsert(batch: DataFrame, path: str, layout: Layout, arrival: Sequence[str]) -> Snapshot:
    """Merge a batch into the partitions it touches; the last arrival of a key wins.

    The batch is reduced to one row per key once. Whoever else writes to other partitions
    meanwhile does not disturb it; if one of its own has changed it is merged anew.
    """
    return merge(winners(batch, layout, arrival), path, layout, lambda old, new: merge_keep_last(old, new, layout.keys), "upsert")


def merge(rows: DataFrame, path: str, layout: Layout, combine: Callable[[DataFrame, DataFrame], DataFrame], operation: str) -> Snapshot:
    """Put ``combine(existing, new)`` in place of the partitions that ``rows`` lie in; others are neither read nor written."""
    spark = rows.sparkSession
    with written_aside(layout.stamp(rows), "merge") as stamped:
        touched = _partition_values(stamped, layout)

        def build(base: Snapshot) -> Change:
            old = [p for p in base.parts if p.partition in touched]
            merged = combine(rows_of(spark, path, layout, old), stamped) if old else stamped
            return Change(operation, tuple(_write(merged, path, layout, stamped=True)), tuple(old), frozenset(touched))

        return transact(spark, path, build)


def upsert_delta(batch: DataFrame, path: str, layout: Layout, arrival: Sequence[str], numbered: tuple[str, int] | None = None) -> Snapshot:
    """Add a batch's own rows, one per key and sorted by key; existing rows are neither read nor written."""
    return append_delta(winners(batch, layout, arrival), path, layout, numbered)


def append_delta(rows: DataFrame, path: str, layout: Layout, numbered: tuple[str, int] | None = None) -> Snapshot:
    """Add rows, one per key, that readers merge with those of their keys; with `numbered` (stream, number) only once."""
    return _add(rows, path, layout, "delta", layout.keys, numbered)


def winners(batch: DataFrame, layout: Layout, arrival: Sequence[str]) -> DataFrame:
    """The last row of each key in a batch."""
    order = [f"_arrival{i}" for i in range(len(arrival))]
    incoming = batch.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in layout.schema.fields], *[F.col(a).alias(o) for a, o in zip(arrival, order)]
    )
    return pick_last(incoming, layout.keys, order, drop=order)


def _partition_values(stamped: DataFrame, layout: Layout) -> set[str]:
    """The partitions that rows lie in; as many names as folders are written."""
    if not layout.partition_columns:
        return {""}
    return {str(r[0]) for r in stamped.select(layout.partition_columns[0]).distinct().collect()}


def compact(spark: SparkSession, path: str, layout: Layout, least: int = MERGE_AT, ratio: float = MERGE_RATIO) -> Snapshot:
    """Merge the newest parts of each partition, as far back as sizes are alike and if there are `least` of them."""

    def build(base: Snapshot) -> Change | None:
        chosen = {p: run for p, parts in base.by_partition().items() if len(run := _run(parts, ratio)) >= least}
        if not chosen:
            return None
        old = [part for run in chosen.values() for part in run]
        rows = rows_of(spark, path, layout, old)
        newest = {partition: run[-1].order for partition, run in chosen.items()}
        written = _write(rows, path, layout, layout.keys, stamped=True)
        return Change("compact", tuple(replace(p, order=newest[p.partition]) for p in written), tuple(old), frozenset(chosen))

    return transact(spark, path, build)


def _run(parts: list[Part], ratio: float) -> list[Part]:
    """The newest parts, as long as the next older one is at most `ratio` times as large as they are together."""
    taken, size = [], 0
    for part in reversed(parts):
        if taken and part.bytes > ratio * size:
            break
        taken.append(part)
        size += part.bytes
    return taken[::-1]


def expire(spark: SparkSession, path: str, keep: int = 1, unfinished_seconds: float = 86_400) -> list[str]:
    """Forget all but the newest `keep` snapshots; delete the folders they alone named.

    A folder that no entry names may belong to a write under way, so it goes only when it has
    not changed for `unfinished_seconds`. Returns the deleted writes.
    """
    versions = _versions(spark, path)
    kept, old = versions[-keep:], versions[:-keep]
    needed = {p.write for v in kept for p in read_entry(spark, path, v).parts}
    known = {p.write for v in old for p in read_entry(spark, path, v).parts}
    for version in old:
        remove_path(spark, _entry_path(path, version))
    gone = []
    for name, is_folder, changed in listed(spark, path):
        write = name[len(WRITE_COLUMN) + 1 :]
        if not is_folder or not name.startswith(f"{WRITE_COLUMN}=") or write in needed:
            continue
        if write in known or time.time() - changed > unfinished_seconds:
            remove_path(spark, f"{path}/{name}")
            gone.append(write)
    return gone


# -- reading ----------------------------------------------------------------------------------


def read(spark: SparkSession, path: str, layout: Layout, version: int | None = None, partitions: Iterable[str] | None = None) -> DataFrame:
    """The rows of one snapshot, by default the newest, with the partition column.

    The snapshot is taken when this is called; later commits do not change the frame. With
    `partitions` only those are read.
    """
    snapshot = latest(spark, path) if version is None else read_entry(spark, path, version)
    chosen = None if partitions is None else set(partitions)
    parts = [p for p in snapshot.parts if chosen is None or p.partition in chosen]
    return rows_of(spark, path, layout, parts)


Paths = Callable[[Part], list[str]]


def rows_of(spark: SparkSession, path: str, layout: Layout, parts: Sequence[Part], paths: Paths | None = None) -> DataFrame:
    """The rows of some parts; where a partition has several and rows have keys, the last row of each key.

    A layout with a ``merge`` of its own merges the rows of a key instead. `paths` narrows a
    part to some of its files.
    """
    by_partition = Snapshot(parts=tuple(parts)).by_partition()
    several = [p for found in by_partition.values() if len(found) > 1 and _upserted(layout) for p in found]
    waiting = set(several)
    rows = _parts(spark, path, layout, [p for p in parts if p not in waiting], paths).drop(WRITE_COLUMN)
    if not several:
        return rows
    # one entry per write that has not been compacted; a part's order is that of its write and partition
    orders = {(p.write, p.partition): p.order for p in several}
    marked = _parts(spark, path, layout, several, paths)
    names = [F.lit(x) for (write, partition), order in orders.items() for x in (f"{write} {partition}", order)]
    folder = F.concat(WRITE_COLUMN, F.lit(" "), *(layout.partition_columns or [F.lit("")]))
    if len(orders) <= 1_000:
        marked = marked.withColumn(_ORDER, F.element_at(F.create_map(*names), folder))
    else:
        listed = spark.createDataFrame([(f"{w} {p}", o) for (w, p), o in orders.items()], f"_folder string, {_ORDER} long")
        marked = marked.join(listed, folder == F.col("_folder")).drop("_folder")
    marked = marked.drop(WRITE_COLUMN)
    own = getattr(layout, "merge", None)
    last = own(marked) if own else pick_last(marked, layout.keys, [_ORDER], drop=[_ORDER])
    return rows.unionByName(last.select(*rows.columns))


def _upserted(layout: Layout) -> bool:
    return bool(layout.keys) and getattr(layout, "dedup", True)


def _parts(spark: SparkSession, path: str, layout: Layout, parts: Sequence[Part], paths: Paths | None = None) -> DataFrame:
    """All rows of some parts, with the partition column and that of the writes."""
    schema = T.StructType([*layout.stored_schema.fields, T.StructField(WRITE_COLUMN, T.StringType())])
    folders = [f for p in parts for f in (paths(p) if paths else [part_folder(path, layout, p)])]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*folders)


def part_folder(path: str, layout: Layout, part: Part) -> str:
    inner = f"/{layout.partition_columns[0]}={part.partition}" if layout.partition_columns else ""
    return f"{path}/{WRITE_COLUMN}={part.write}{inner}"


def exists(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, f"{path}/{LOG}")
