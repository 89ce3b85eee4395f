"""Exact duplicates through an extendible-hash index, in DataFrame operations only.

Texts are equal when they are the same bytes after deleting ASCII white space. A first pass
writes a narrow row for each text: its hash, SHA-256 digest and code points. The directory is
built over the distinct hashes and grows by doubling: an overfull bucket takes one more leading
bit of the hash, on its own, until it fits `BUCKET_ENTRIES` or `MAX_DEPTH` is reached. It has
a slot for each value of as many bits as the deepest bucket took, so at most 2**`MAX_DEPTH`
slots, 25 MB, whatever the corpus, and is sent to all tasks.

A second pass over the texts looks every text's bucket up in the directory and brings the
texts of each (bucket, hash) to the task that owns it, where they are compared byte by byte
and those that differ are chained. Equal texts meet inside the map tasks first, so one held by
a third of all rows reaches its owner once per task. The narrow rows find the link of their
text by probing the directory, then the chain; the rows of a link are a group. Owners write
the index by ranges of buckets. A text whose slot is in no bucket finds nothing.

Of equal texts the row with the most code points stays, then the smallest doc_id, then the
first row. Defined cases: null text counts as empty, and all empty texts are equal; ids may be
of any type with an order, and a null doc_id ranks after every other; of rows repeated in full
one is kept; an empty table gives an empty result; other columns are ignored here and returned as they
are by `drop_exact_duplicates`.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize, materialize_last, write_aside

BUCKET_ENTRIES = 65_536
#: Bits of the largest directory: at most 2**20 slots.
MAX_DEPTH = 20

_SPACE = r"[\x20\x09-\x0D]+"


def _plain() -> Column:
    return F.regexp_replace(F.coalesce("text", F.lit("")), _SPACE, "")


def _directory(keys: DataFrame, most: int) -> DataFrame:
    """(slot, bucket, depth): the bucket of every slot used by `keys` (hash), named by its first slot.

    All buckets start as one; each turn doubles the directory and splits those still overfull.
    """
    spark = keys.sparkSession
    path = write_aside(keys.groupBy(_slot().alias("slot")).agg(F.count("*").alias("load")), "slots")
    open_slots = spark.read.parquet(path)
    settled = None
    for depth in range(MAX_DEPTH + 1):
        rest = MAX_DEPTH - depth
        named = open_slots.withColumn("bucket", F.shiftleft(F.shiftright("slot", rest), rest))
        sized = named.join(named.groupBy("bucket").agg(F.sum("load").alias("total")), "bucket")
        fits = (F.col("total") <= most) | F.lit(rest == 0)
        done = sized.where(fits).select("slot", "bucket", F.lit(depth).alias("depth"))
        settled = done if settled is None else settled.union(done)
        open_slots = materialize(sized.where(~fits).select("slot", "load"), "overfull")
        if open_slots.isEmpty():
            break
    return settled


def _slot() -> Column:
    return F.shiftrightunsigned("hash", 64 - MAX_DEPTH)


class _Doubled(NamedTuple):
    """A directory as far as it was doubled: (slot, bucket) for the leading `depth` bits."""

    slots: DataFrame
    depth: int


def _doubled(directory: DataFrame) -> _Doubled:
    depth = directory.agg(F.max("depth")).first()[0] or 0
    slots = directory.select(F.shiftright("slot", MAX_DEPTH - depth).alias("slot"), "bucket").distinct()
    return _Doubled(materialize(slots, "doubled"), depth)


def _probed(rows: DataFrame, directory: _Doubled) -> DataFrame:
    """`rows` (hash) with their bucket."""
    slot = F.shiftrightunsigned("hash", 64 - directory.depth) if directory.depth else F.lit(0).cast("long")
    return rows.withColumn("slot", slot).join(F.broadcast(directory.slots), "slot").drop("slot")


def _chains(docs: DataFrame, directory: _Doubled) -> DataFrame:
    """(bucket, hash, link, digest): the different texts of each (bucket, hash), by their bytes."""
    texts = _probed(docs.select(_plain().alias("plain")).withColumn("hash", F.xxhash64("plain")), directory)
    owned = texts.groupBy("bucket", "hash").agg(F.array_sort(F.collect_set("plain")).alias("chain"))
    named = owned.select("bucket", "hash", F.transform("chain", lambda plain: F.sha2(plain, 256)).alias("digests"))
    # narrow rows know their text by its digest; two texts of one digest would need another digest, never a merge
    shared = F.size(F.array_distinct("digests")) < F.size("digests")
    told = F.when(shared, F.raise_error(F.lit("two texts share a SHA-256 digest"))).otherwise(F.col("digests"))
    return materialize(named.select("bucket", "hash", F.posexplode(told).alias("link", "digest")), "chains")


def _index(entries: DataFrame, docs: DataFrame, most: int) -> tuple[_Doubled, DataFrame]:
    """The directory, and one row per link: bucket, hash, link, digest, the row that stays, rows."""
    directory = _doubled(materialize(_directory(entries.select("hash").distinct(), most), "directory"))
    # the row that stays: most code points, then the smallest id, then the first row
    best = F.min(F.struct((-F.col("n_points")).alias("fewer"), F.isnull("doc_id").alias("no_id"), "doc_id", "_row"))
    by_digest = _probed(entries, directory).groupBy("bucket", "hash", "digest").agg(best.alias("best"), F.count("*").alias("group_size"))
    linked = by_digest.join(_chains(docs, directory), ["bucket", "hash", "digest"])
    index = linked.select(
        "bucket",
        "hash",
        "link",
        "digest",
        F.col("best.doc_id").alias("keep_id"),
        F.col("best._row").alias("keep_row"),
        "group_size",
    )
    return directory, materialize(index.repartitionByRange("bucket"), "index")


def _found(rows: DataFrame, bucket_entries: int) -> DataFrame:
    """Every row (_row, doc_id, text) with what the index says of its text."""
    text = F.coalesce("text", F.lit(""))
    narrow = rows.select("_row", "doc_id", F.char_length(text).alias("n_points"), _plain().alias("plain"))
    keys = {"hash": F.xxhash64("plain"), "digest": F.sha2("plain", 256)}
    entries = materialize(narrow.withColumns(keys).drop("plain"), "entries")
    directory, index = _index(entries, rows, bucket_entries)
    chains = index.select("bucket", "hash", "digest", "keep_id", "keep_row", "group_size")
    probed = _probed(entries.select("_row", "doc_id", "hash", "digest"), directory).join(chains, ["bucket", "hash", "digest"])
    return probed.withColumn("kept", F.col("_row") == F.col("keep_row"))


def exact_duplicates(docs: DataFrame, bucket_entries: int = BUCKET_ENTRIES) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256."""
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), "doc_id", "text")
    return _found(rows, bucket_entries).select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame, bucket_entries: int = BUCKET_ENTRIES) -> DataFrame:
    """The rows of `docs` that stay, with all their columns."""
    names = [f"_c{i}" for i in range(len(docs.columns))]
    named = materialize(docs.toDF(*names).withColumn("_row", F.monotonically_increasing_id()), "named")
    ids = [F.col(names[docs.columns.index(c)]).alias(c) for c in ("doc_id", "text")]
    gone = materialize_last(lambda: _found(named.select("_row", *ids), bucket_entries).where("NOT kept").select("_row"), "exact_dropped")
    return named.join(gone, "_row", "left_anti").select(*names).toDF(*docs.columns)
