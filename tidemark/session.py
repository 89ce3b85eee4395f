"""Session helpers: time zone, the shared folder, and tables written to cut lineage."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

#: Rows one task should hold of a single key before the key is split over tasks.
ROWS_PER_TASK = 2_000_000
ROWS_PER_TASK_CONF = "spark.tidemark.rowsPerTask"

_written: set[str] = set()
#: Everything named below the shared folder, and the databases that lie there.
_named: set[str] = set()
_databases: set[str] = set()
#: What is written aside on the way to a table of `materialize_last`.
_on_the_way: ContextVar[list[str] | None] = ContextVar("on_the_way", default=None)


def utc(spark: SparkSession) -> SparkSession:
    """Pin the session to UTC, so zoned and zone-less timestamps convert without shifts."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def rows_per_task(spark: SparkSession, given: int | None = None) -> int:
    """Rows of one key a task should hold: ``given``, or else the session's setting."""
    return int(spark.conf.get(ROWS_PER_TASK_CONF, str(ROWS_PER_TASK))) if given is None else given


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a single-machine session without the setting gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing is created yet. :func:`drop_scratch` deletes what comes to lie there."""
    path = f"{shared_dir(spark)}/tidemark/{name}-{uuid.uuid4().hex}"
    _named.add(path)
    return path


def new_database(spark: SparkSession) -> str:
    """A database of its own below the shared folder, so runs never meet."""
    name = f"tidemark_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, name)}'")
    _databases.add(name)
    return name


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Unlike a cached or locally checkpointed plan it survives lost executors, and later
    passes read only the columns they need. The files stay until :func:`drop_scratch`.
    """
    return read_aside(df.sparkSession, write_aside(df, name), df.schema)


def write_aside(df: DataFrame, name: str) -> str:
    path = scratch_path(df.sparkSession, name)
    _written.add(path)
    if (noted := _on_the_way.get()) is not None:
        noted.append(path)
    df.write.parquet(path)
    return path


def read_aside(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


@contextlib.contextmanager
def written_aside(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """:func:`materialize` for work that ends inside the block; the files go with it."""
    path = write_aside(df, name)
    try:
        yield read_aside(df.sparkSession, path, df.schema)
    finally:
        drop_aside(df.sparkSession, path)


def materialize_last(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """:func:`materialize` for the table ``make`` gives; what ``make`` wrote aside goes."""
    noted: list[str] = []
    token = _on_the_way.set(noted)
    try:
        df = make()
    finally:
        _on_the_way.reset(token)
    made = materialize(df, name)
    for path in noted:
        if path in _written:
            drop_aside(df.sparkSession, path)
    return made


def drop_aside(spark: SparkSession, path: str) -> bool:
    _written.discard(path)
    _named.discard(path)
    return remove_path(spark, path)


def drop_scratch(spark: SparkSession) -> int:
    """Delete what this process put below the shared folder, and the databases there; results built on it must be done.

    What lies beside a path under its name and two underscores, such as notes and staged folders, goes too.
    """
    for name in list(_databases):
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
        _databases.discard(name)
    parents = {path.rsplit("/", 1)[0] for path in _named}
    found = {f"{parent}/{name}" for parent in parents for name, _, _ in listed(spark, parent)}
    gone = [path for path in found if path.split("__", 1)[0] in _named or path in _named]
    for path in gone:
        remove_path(spark, path)
    _named.clear()
    _written.clear()
    return len(gone)


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete one path through the Hadoop file system it lives on."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.delete(jvm_path, True)


def rename_files(spark: SparkSession, folder: str, target: str) -> None:
    """Move the data files of ``folder`` to ``target`` (the only one) or ``target`` with numbers before its name."""
    jvm = spark._jvm.org.apache.hadoop.fs
    fs = jvm.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    parent, _, name = target.rpartition("/")
    fs.mkdirs(jvm.Path(target).getParent())
    files = [f.getPath() for f in fs.listStatus(jvm.Path(folder)) if f.getPath().getName().startswith("part-")]
    for i, file in enumerate(files):
        fs.rename(file, jvm.Path(target if len(files) == 1 else f"{parent}/{i}-{name}"))
    fs.delete(jvm.Path(folder), True)


def replace_folders(spark: SparkSession, staged: str, path: str, inside: bool) -> None:
    """Move ``staged``, or each folder inside it, over its namesake at ``path``; safe to repeat."""
    jvm = spark._jvm.org.apache.hadoop.fs
    fs = jvm.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    source = jvm.Path(staged)
    if not fs.exists(source):
        return
    moves = [(source, jvm.Path(path))]
    if inside:
        folders = [f.getPath() for f in fs.listStatus(source) if f.isDirectory()]
        moves = [(f, jvm.Path(path, f.getName())) for f in folders]
    for old, new in moves:
        fs.delete(new, True)
        fs.rename(old, new)
    fs.delete(source, True)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders inside a folder."""
    return [name for name, is_folder, _ in listed(spark, path) if is_folder]


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def listed(spark: SparkSession, folder: str) -> list[tuple[str, bool, float]]:
    """(name, whether a folder, time of change in seconds) of what lies in a folder, if it exists."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(jvm_path):
        return []
    return [(s.getPath().getName(), s.isDirectory(), s.getModificationTime() / 1000) for s in fs.listStatus(jvm_path)]


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file that must not exist yet: of several writers exactly one succeeds."""
    jvm = spark._jvm
    conf, target = spark._jsc.hadoopConfiguration(), jvm.org.apache.hadoop.fs.Path(path)
    staged = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}")
    fs = target.getFileSystem(conf)
    stream = fs.create(staged, False)
    stream.write(bytearray(text.encode("utf-8")))
    stream.close()
    try:
        if fs.getScheme() == "file":
            # a local rename would overwrite; a hard link does not
            os.link(staged.toUri().getPath(), target.toUri().getPath())
        else:
            options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf).rename(staged, target, options)
        return True
    except FileExistsError:
        return False
    except Exception:
        if fs.exists(target):
            return False
        raise
    finally:
        fs.delete(staged, False)
