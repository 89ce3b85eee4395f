"""Alignment of two tokenizers over a corpus, with counts of linked ids.

Both tokenizers cut the same bytes, a space and the text. Offsets where a token of each ends
cut the tokens into groups, and the two tokens that end there are linked.

The first pass encodes every document, writes the ids aside (two bytes each) and gathers the
distinct linked pairs of ids with their number, task by task. The distinct pairs of the corpus
get a minimal perfect hash (`perfect_hash`). Each task then turns its numbers into one dense
vector indexed by that hash, and the vectors are summed up a tree, `FAN` at a time. The second
pass aligns the documents again from their ids and looks each link's count up in the summed
vector, comparing the key that is kept in its slot.

The number of distinct pairs does not grow with the corpus for ever, but with the vocabularies,
so it is counted before a table is sent to tasks: pairs go in shards of at most about
`PAIRS_AT_ONCE`, by ranges of buckets, each with its hash and vector, and the sums per document
of several shards are added up. One shard is the common case.

Defined cases: a text that is null or empty, or whose tokens do not give back a space and the
text byte by byte in either tokenizer, has no tokens, groups or links; special tokens' strings
in a text are plain text; repeated rows and null ids are ordinary rows; only the columns named
are returned, and are told apart from those added; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from tidemark.llm import perfect_hash
from tidemark.llm.arrow_text import bytes_of, row_groups
from tidemark.llm.perfect_hash import PerfectHash
from tidemark.llm.tasks import map_batches
from tidemark.llm.token_files import loaded, read_byte_level, read_pieces
from tidemark.session import materialize

#: Pairs of ids whose table, 24 bytes a pair, is sent to tasks at once.
PAIRS_AT_ONCE = 4_000_000
#: Distinct pairs a task keeps before it writes them out.
PAIRS_IN_TASK = 1_000_000
#: Slots of a block of a vector, and vectors summed in one step of the tree.
BLOCK, FAN = 65_536, 16
_ID_BITS = 32


@dataclass
class Encoded:
    """Documents with the ids of both tokenizers, written aside; `files` are broadcasts of the two files."""

    rows: DataFrame
    files: tuple
    carry: tuple[str, ...]


def encode(docs: DataFrame, path_a: str, path_b: str, carry: tuple[str, ...] = ("doc_id",)) -> Encoded:
    """Ids of a byte-level file (over a space and the text) and a sentencepiece model (which adds the space)."""
    context = docs.sparkSession.sparkContext
    files = context.broadcast(read_byte_level(path_a)), context.broadcast(read_pieces(path_b))
    # the carried columns go by place, so any name may clash with those added
    inside = [f"_c{i}" for i in range(len(carry))]
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(carry, inside)], F.col("text").alias("_text"))

    def encode_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a_tokens, b_tokens = (loaded(f.value) for f in files)
        a_bytes, b_bytes = a_tokens.bytes_of, b_tokens.bytes_of
        for whole in batches:
            _, offsets = bytes_of(whole.column("_text"))
            for lo, hi in row_groups(offsets):
                batch = whole.slice(lo, hi - lo)
                texts = [value.as_py() or "" for value in batch.column("_text")]
                a_ids, b_ids = [], []
                for text, b in zip(texts, b_tokens.encode(texts)):
                    said = (" " + text).encode("utf-8")
                    a = a_tokens.encode(" " + text, False) if text else np.zeros(0, np.uint32)
                    same = text and b"".join([a_bytes[i] for i in a.tolist()]) == said == b"".join([b_bytes[i] for i in b])
                    a_ids.append(a.astype(_id_type(a_tokens.size)).tobytes() if same else b"")
                    b_ids.append(np.array(b, _id_type(b_tokens.size)).tobytes() if same else b"")
                columns = [batch.column(n) for n in inside] + [pa.array(a_ids, pa.binary()), pa.array(b_ids, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, [*inside, "a", "b"])

    schema = StructType()
    for name, column in zip(inside, carry):
        schema = schema.add(name, docs.schema[column].dataType)
    encoded = map_batches(rows, encode_batches, schema.add("a", "binary").add("b", "binary"))
    return Encoded(materialize(encoded.withColumn("_row", F.monotonically_increasing_id()), "token-ids"), files, carry)


def _id_type(size: int) -> str:
    return "<u2" if size <= 1 << 16 else "<u4"


@dataclass
class Aligned:
    """The alignment of some documents: ids of all, and per document, group and side where they lie."""

    a: np.ndarray
    b: np.ndarray
    #: Bounds of the documents in `a`, `b` and the groups.
    a_bounds: np.ndarray
    b_bounds: np.ndarray
    bounds: np.ndarray
    #: Places in `a` and `b` of the linked tokens, which end each group.
    a_last: np.ndarray
    b_last: np.ndarray

    @property
    def keys(self) -> np.ndarray:
        """The linked ids of each group as one number."""
        return (self.a[self.a_last].astype(np.uint64) << np.uint64(_ID_BITS)) | self.b[self.b_last].astype(np.uint64)


def align(a_ids: list[bytes], b_ids: list[bytes], a_lengths: np.ndarray, b_lengths: np.ndarray) -> Aligned:
    """Groups of documents from their ids and the byte lengths of the tokens."""
    sides = []
    for ids, lengths in ((a_ids, a_lengths), (b_ids, b_lengths)):
        kind = np.dtype(_id_type(len(lengths)))
        found = np.frombuffer(b"".join(ids), kind).astype(np.int64)
        bounds = np.concatenate([[0], np.cumsum([len(x) // kind.itemsize for x in ids], dtype=np.int64)])
        sides.append((found, bounds, np.cumsum(lengths[found])))
    (a, a_bounds, a_ends), (b, b_bounds, b_ends) = sides
    # documents have the same bytes on both sides, so offsets can run on over all of them
    at = np.searchsorted(b_ends, a_ends)
    a_last = np.flatnonzero(b_ends[at] == a_ends)
    b_last = at[a_last]
    return Aligned(a, b, a_bounds, b_bounds, np.searchsorted(a_last, a_bounds), a_last, b_last)


def _aligned(files: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Aligned]]:
    """Rows with about a megabyte of ids together, and their alignment."""
    lengths = [np.array([len(x) for x in loaded(f.value).bytes_of], np.int64) for f in files]
    for batch in batches:
        sizes = pc.binary_length(batch.column("a")).to_numpy(zero_copy_only=False)
        for lo, hi in row_groups(np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])):
            part = batch.slice(lo, hi - lo)
            yield part, align(part.column("a").to_pylist(), part.column("b").to_pylist(), *lengths)


def linked_pairs(encoded: Encoded) -> DataFrame:
    """(key, n): linked pairs of ids and their number, summed within tasks only."""
    files = encoded.files

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        waiting, waiting_rows = [], 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            new, n = np.unique(np.concatenate(waiting), return_counts=True)
            both = np.concatenate([keys, new])
            distinct, place = np.unique(both, return_inverse=True)
            return distinct, np.bincount(place, np.concatenate([counts, n]), len(distinct)).astype(np.int64)

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], ["key", "n"])

        for _, found in _aligned(files, batches):
            waiting.append(found.keys)
            waiting_rows += len(waiting[-1])
            if waiting_rows >= 2 * PAIRS_IN_TASK:
                keys, counts = merged()
                waiting, waiting_rows = [], 0
                if len(keys) >= PAIRS_IN_TASK:
                    yield out()
                    keys, counts = keys[:0], counts[:0]
        if waiting:
            keys, counts = merged()
        if len(keys):
            yield out()

    return map_batches(encoded.rows.select("a", "b"), gather, "key long, n long")


def _summed(vectors: DataFrame) -> DataFrame:
    """(block, counts): dense vectors (block, part, counts) summed up a tree of `FAN` at a time."""
    vectors = materialize(vectors, "vectors")
    last = vectors.agg(F.max("part")).first()[0]

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_py(), np.int64) for x in table.column("counts"))
        return pa.table(
            {"block": table.column("block")[:1], "part": pa.array([table.column("part")[0].as_py() // FAN]), "counts": pa.array([total.tobytes()], pa.binary())}
        )

    while last:
        grouped = vectors.groupBy("block", F.expr(f"part div {FAN}").alias("_up"))
        vectors, last = grouped.applyInArrow(add, "block long, part long, counts binary"), last // FAN
    return vectors.select("block", "counts")


def _second(keys: np.ndarray) -> np.ndarray:
    """The second id of each pair."""
    return (keys & np.uint64(2**_ID_BITS - 1)).astype(np.int64)


class PairTable:
    """Counts of the pairs of one shard, by slot, and whether each is the highest of its second id."""

    def __init__(self, hashed: PerfectHash, counts: np.ndarray, best: np.ndarray):
        self.hashed, self.counts, self.best = hashed, counts, best

    def look_up(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(count, whether highest) of each key; nought for keys of other shards."""
        slots = self.hashed.slots(keys)
        known = slots >= 0
        at = np.where(known, slots, 0)
        return np.where(known, self.counts[at], 0), known & self.best[at]


@dataclass
class PairCounts:
    """Counts of all linked pairs, in shards: per shard the buckets of its hash and its summed vector, written aside."""

    buckets: int
    shards: list[tuple[DataFrame, DataFrame]]
    #: The highest count of each id of the second tokenizer.
    highest: np.ndarray

    def shard(self, number: int) -> PairTable:
        built, blocks = self.shards[number]
        hashed = PerfectHash(built.collect(), self.buckets)
        counts = _dense(blocks, len(hashed))
        return PairTable(hashed, counts, counts == self.highest[_second(hashed.keys)])

    def table(self, spark: SparkSession) -> DataFrame:
        """(a_id, b_id, links) of every linked pair: each bucket's keys with the values of their slots."""
        rows = spark.createDataFrame([], "a_id long, b_id long, links long")
        for number, (built, _) in enumerate(self.shards):
            sent = spark.sparkContext.broadcast(self.shard(number))

            def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    for row in batch.column("keys"):
                        keys = np.frombuffer(row.as_py(), np.uint64)
                        ids = (keys >> np.uint64(_ID_BITS)).astype(np.int64), _second(keys)
                        yield pa.RecordBatch.from_arrays([*map(pa.array, ids), pa.array(sent.value.look_up(keys)[0])], ["a_id", "b_id", "links"])

            rows = rows.union(map_batches(built.select("keys"), pairs, rows.schema))
        return rows


def _dense(blocks: DataFrame, size: int) -> np.ndarray:
    counts = np.zeros(-(-size // BLOCK) * BLOCK, np.int64)
    for row in blocks.toLocalIterator():
        counts[row["block"] * BLOCK : (row["block"] + 1) * BLOCK] = np.frombuffer(row["counts"], np.int64)
    return counts[:size]


def count_pairs(encoded: Encoded, pairs_at_once: int = PAIRS_AT_ONCE, bucket_keys: int = perfect_hash.BUCKET_KEYS) -> PairCounts:
    """The corpus-wide counts of linked pairs, by a minimal perfect hash of the distinct ones."""
    context = encoded.rows.sparkSession.sparkContext
    partial = materialize(linked_pairs(encoded), "linked-pairs")
    distinct = materialize(partial.select("key").distinct(), "distinct-pairs")
    buckets = -(-max(1, distinct.count()) // bucket_keys)
    built = materialize(perfect_hash.build(distinct, buckets), "perfect-hash")
    many = max(1, pairs_at_once // bucket_keys)
    shards, highest = [], np.zeros(loaded(encoded.files[1].value).size, np.int64)
    for first in range(0, buckets, many):
        own = built.where(F.col("bucket").between(first, first + many - 1))
        hashed = PerfectHash(own.collect(), buckets)
        if not len(hashed):
            continue
        sent = context.broadcast(hashed)

        def vector(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counts = np.zeros(-(-len(sent.value) // BLOCK) * BLOCK, np.int64)
            for batch in batches:
                slots = sent.value.slots(batch.column("key").to_numpy(zero_copy_only=False).view(np.uint64))
                counts += np.bincount(slots[slots >= 0], batch.column("n").to_numpy(zero_copy_only=False)[slots >= 0], len(counts)).astype(np.int64)
            blocks = [i for i in range(len(counts) // BLOCK) if counts[i * BLOCK : (i + 1) * BLOCK].any()]
            data = [counts[i * BLOCK : (i + 1) * BLOCK].tobytes() for i in blocks]
            part = [TaskContext.get().partitionId()] * len(blocks)
            yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), pa.array(part, pa.int64()), pa.array(data, pa.binary())], ["block", "part", "counts"])

        blocks = materialize(_summed(map_batches(partial, vector, "block long, part long, counts binary")), "summed")
        np.maximum.at(highest, _second(hashed.keys), _dense(blocks, len(hashed)))
        shards.append((own, blocks))
    return PairCounts(buckets, shards, highest)


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of `values` between neighbouring bounds."""
    return np.diff(np.concatenate([[0], np.cumsum(values, dtype=np.int64)])[bounds])


def group_lines(found: Aligned, names: np.ndarray) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` of each document.

    `names` holds each id four times over: as A followed by a comma, as A by a bar, as B by a
    comma, as B by a semicolon, one block of ids after the other.
    """
    ids = len(names) // 4
    a_after, b_after = np.zeros(len(found.a), np.int64), np.zeros(len(found.b), np.int64)
    a_after[found.a_last] = b_after[found.b_last] = 1
    a_group, b_group = np.cumsum(a_after) - a_after, np.cumsum(b_after) - b_after
    # a token stands behind its own side's earlier ones, the other side's earlier groups, and B behind its group's A
    b_firsts = np.concatenate([[0], found.b_last + 1])
    a_firsts = np.concatenate([found.a_last + 1, [len(found.a)]])
    said = np.empty(len(found.a) + len(found.b), np.int64)
    said[np.arange(len(found.a)) + b_firsts[a_group]] = found.a + a_after * ids
    said[np.arange(len(found.b)) + a_firsts[b_group]] = found.b + (2 + b_after) * ids
    words = names[said].tolist()
    ends = (found.a_bounds + found.b_bounds).tolist()
    return ["".join(words[lo:hi])[:-1] for lo, hi in zip(ends[:-1], ends[1:])]


@functools.lru_cache(1)
def _names(size: int) -> np.ndarray:
    return np.array([f"{i}{after}" for after in (",", "|", ",", ";") for i in range(size)], object)


def summarize(encoded: Encoded, counts: PairCounts) -> DataFrame:
    """Per document: `carry`, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    n_best counts links whose count is the highest of their B id, count_sum adds the counts up.
    """
    context, files = encoded.rows.sparkSession.sparkContext, encoded.files
    inside = [f"_c{i}" for i in range(len(encoded.carry))]
    size = max(loaded(f.value).size for f in files)

    def looked_up(number: int, whole: bool) -> DataFrame:
        sent = context.broadcast(counts.shard(number) if counts.shards else None)

        def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names = _names(size) if whole else None
            for part, found in _aligned(files, batches):
                links, best = sent.value.look_up(found.keys) if sent.value else (np.zeros(0, np.int64), np.zeros(0, bool))
                columns = [part.column("_row"), pa.array(_sums(best, found.bounds)), pa.array(_sums(links, found.bounds))]
                if whole:
                    digests = [hashlib.sha256(line.encode()).hexdigest() if line else "" for line in group_lines(found, names)]
                    # a group holds one link, that of the tokens that end it
                    counted = (found.a_bounds, found.b_bounds, found.bounds, found.bounds)
                    columns += [part.column(n) for n in inside] + [pa.array(np.diff(b)) for b in counted] + [pa.array(digests, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

        schema = StructType().add("_row", "long").add("n_best", "long").add("count_sum", "long")
        if whole:
            for name in inside:
                schema = schema.add(name, encoded.rows.schema[name].dataType)
            for name in ("n_a", "n_b", "n_groups", "n_links"):
                schema = schema.add(name, "long")
            schema = schema.add("groups_sha256", "string")
        return map_batches(encoded.rows, summaries, schema)

    rows = looked_up(0, True)
    rest = None
    for number in range(1, len(counts.shards)):
        more = looked_up(number, False)
        rest = more if rest is None else rest.union(more)
    if rest is not None:
        added = rest.groupBy("_row").agg(F.sum("n_best").alias("_best"), F.sum("count_sum").alias("_sum"))
        rows = rows.join(added, "_row").withColumns({"n_best": F.col("n_best") + F.col("_best"), "count_sum": F.col("count_sum") + F.col("_sum")})
    return rows.select(
        *[F.col(n).alias(c) for n, c in zip(inside, encoded.carry)],
        *["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
    )


def groups(encoded: Encoded) -> DataFrame:
    """Per document: `carry` and groups, an array of (a, b) arrays of ids."""
    files, inside = encoded.files, [f"_c{i}" for i in range(len(encoded.carry))]
    kind = pa.list_(pa.struct([("a", pa.list_(pa.int64())), ("b", pa.list_(pa.int64()))]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, found in _aligned(files, batches):
            a_parts, b_parts = np.split(found.a, found.a_last + 1), np.split(found.b, found.b_last + 1)
            pairs = [{"a": a, "b": b} for a, b in zip(a_parts, b_parts)]
            shown = [pairs[lo:hi] for lo, hi in zip(found.bounds[:-1], found.bounds[1:])]
            yield pa.RecordBatch.from_arrays([part.column(n) for n in inside] + [pa.array(shown, kind)], [*inside, "groups"])

    schema, ids = StructType(), ArrayType(LongType())
    for name in inside:
        schema = schema.add(name, encoded.rows.schema[name].dataType)
    told = map_batches(encoded.rows, cut, schema.add("groups", ArrayType(StructType().add("a", ids).add("b", ids))))
    return told.select(*[F.col(n).alias(c) for n, c in zip(inside, encoded.carry)], "groups")
