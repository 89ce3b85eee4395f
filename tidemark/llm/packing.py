"""Best-fit packing planned over a histogram of lengths.

Documents become pieces of at most `capacity` tokens; only their lengths are needed to plan.
A histogram has at most `capacity` lengths, whatever the corpus, so the plan is made on the
driver over counts: lengths go from the longest down, and all pieces of a length fill the open
sequences with the least room that still holds one, many alike sequences at a time. That is
best fit over the documents in order of falling length, without touching a document.

The plan says for each length which ranks go to which sequences and offsets. A piece's rank
within its length is its place among the pieces of that length in its own task, which the task
counts, plus what the tasks before it hold, one row per (task, length). So a length that a
third of all documents share is never sorted or numbered by one task. Pieces then take their
slots by joining on length and rank.

Defined cases: a null or empty text has no ids of its own, so with the end id it is one piece of
one token; special tokens' strings in a text are those tokens, as the tokenizers library reads
them; repeated rows and null ids are ordinary rows, each packed; only the columns named are
returned, and are told apart from those added; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator, Mapping
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.llm.arrow_text import bytes_of, row_groups
from tidemark.llm.tasks import map_batches
from tidemark.llm.token_files import loaded, read_byte_level
from tidemark.session import materialize

CAPACITY = 2048
END_ID = 0

#: What a piece is described by, besides the columns it carries.
_PIECE = [("piece", "integer"), ("start", "long"), ("length", "long"), ("ids_crc32", "long")]
_ARROW = {"integer": pa.int32(), "long": pa.int64(), "binary": pa.binary()}


class Slots(NamedTuple):
    """Ranks `rank_from` up to `rank_to` of a length fill sequences from `sequence_from`, `each` per sequence from `offset` on."""

    length: int
    rank_from: int
    rank_to: int
    sequence_from: int
    each: int
    offset: int


def best_fit(counts: Mapping[int, int], capacity: int = CAPACITY) -> list[Slots]:
    """Slots for `counts[length]` pieces of each length, by best fit in order of falling length."""
    plan: list[Slots] = []
    # room -> ranges (first sequence, how many) of open sequences with that room
    open_with: dict[int, list[tuple[int, int]]] = defaultdict(list)
    rooms: list[int] = []
    sequences = 0

    def put(room: int, first: int, many: int) -> None:
        if room and many:
            if not open_with[room]:
                insort(rooms, room)
            open_with[room].append((first, many))

    for length in sorted(counts, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of {length} tokens does not fit {capacity}")
        rank, left = 0, counts[length]
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, many = open_with[room].pop()
                if not open_with[room]:
                    del rooms[at]
            else:
                room, first, many = capacity, sequences, -(-left // (capacity // length))
                sequences += many
            each = room // length
            full = min(many, left // each)
            if full:
                plan.append(Slots(length, rank, rank + full * each, first, each, capacity - room))
                put(room - each * length, first, full)
                rank, left = rank + full * each, left - full * each
            if full < many and left:
                # fewer than a sequence takes are left
                plan.append(Slots(length, rank, rank + left, first + full, left, capacity - room))
                put(room - left * length, first + full, 1)
                rank, left, full = rank + left, 0, full + 1
            put(room, first + full, many - full)
    return plan


def cut(docs: DataFrame, path: str, capacity: int = CAPACITY, carry: tuple[str, ...] = ("doc_id",), end_id: int = END_ID, ids: bool = False) -> DataFrame:
    """The pieces of `docs` (text and `carry`): `carry`, piece, start, length, ids_crc32, and the task and rank of each.

    A document longer than `capacity` is cut from its end, so only its first piece is shorter.
    With `ids` the pieces' ids come too, as little-endian unsigned 32-bit integers.
    """
    file = docs.sparkSession.sparkContext.broadcast(read_byte_level(path))
    kept = [docs.schema[c] for c in carry]
    # the carried columns go by place, so any name may clash with those added
    inside = [f"_c{i}" for i in range(len(carry))]
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(carry, inside)], F.col("text").alias("_text"))
    added = [*_PIECE, ("part", "long"), ("local_rank", "long")] + ([("ids", "binary")] if ids else [])

    def cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = loaded(file.value)
        part = TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        for whole in batches:
            _, offsets = bytes_of(whole.column("_text"))
            for lo, hi in row_groups(offsets):
                batch = whole.slice(lo, hi - lo)
                source, made = [], []
                for row, value in enumerate(batch.column("_text")):
                    found = np.append(tokens.encode(value.as_py() or "", True), np.uint32(end_id)).astype("<u4")
                    pieces = -(-len(found) // capacity)
                    end = len(found) - (pieces - 1) * capacity
                    start = 0
                    for piece in range(pieces):
                        data, length = found[start:end].tobytes(), end - start
                        made.append((piece, start, length, zlib.crc32(data), part, seen[length]) + ((data,) if ids else ()))
                        source.append(row)
                        seen[length] += 1
                        start, end = end, end + capacity
                taken = [batch.column(n).take(pa.array(source, pa.int64())) for n in inside]
                columns = [pa.array(c, _ARROW[kind]) for c, (_, kind) in zip(zip(*made), added)]
                yield pa.RecordBatch.from_arrays(taken + columns, inside + [n for n, _ in added])

    schema = StructType()
    for name, field in zip(inside, kept):
        schema = schema.add(name, field.dataType)
    for name, kind in added:
        schema = schema.add(name, kind)
    return map_batches(rows, cut_batches, schema)


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, carry: tuple[str, ...] = ("doc_id",), end_id: int = END_ID, ids: bool = False) -> DataFrame:
    """One row per piece of `docs`: `carry`, piece, start, length, ids_crc32, sequence_id, offset, and ids if asked for.

    Every sequence is filled from offset 0 on without gaps to at most `capacity` tokens.
    """
    spark = docs.sparkSession
    # written once, so the task and the rank it gave a piece stay what they are
    pieces = materialize(cut(docs, path, capacity, carry, end_id, ids), "pieces")
    held = materialize(pieces.groupBy("part", "length").agg(F.count("*").alias("held")), "held")
    # at most `capacity` lengths
    counts = {r["length"]: r["n"] for r in held.groupBy("length").agg(F.sum("held").alias("n")).collect()}
    # the plan has a bounded number of slots too: lengths times ranges of open sequences
    by_length: dict[int, list[tuple[int, ...]]] = defaultdict(list)
    for slots in best_fit(counts, capacity):
        by_length[slots.length].append(slots[1:])
    plan_type = "length long, slots array<struct<rank_from: long, rank_to: long, sequence_from: long, each: long, offset: long>>"
    plan = spark.createDataFrame(list(by_length.items()), plan_type)

    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = held.select("part", "length", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("before"), "held")
    last = F.col("before") + F.col("held")
    # the slots that the pieces of one task and length can take
    starts = starts.join(F.broadcast(plan), "length").select(
        "part", "length", "before", F.filter("slots", lambda s: (s["rank_from"] < last) & (s["rank_to"] > F.col("before"))).alias("slots")
    )
    ranked = pieces.join(starts, ["part", "length"]).withColumn("rank", F.col("before") + F.col("local_rank"))
    slot = F.get(F.filter("slots", lambda s: (s["rank_from"] <= F.col("rank")) & (F.col("rank") < s["rank_to"])), F.lit(0))
    placed = ranked.withColumn("slot", slot).withColumn("among", F.col("rank") - F.col("slot.rank_from"))
    sequence = F.col("slot.sequence_from") + F.expr("among div slot.each")
    offset = F.col("slot.offset") + F.expr("among % slot.each") * F.col("length")
    return placed.select(
        *[F.col(f"_c{i}").alias(c) for i, c in enumerate(carry)],
        *[n for n, _ in _PIECE],
        sequence.alias("sequence_id"),
        offset.alias("offset"),
        *(["ids"] if ids else []),
    )


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, length and ids (little-endian unsigned 32-bit) of the sequences of `pack(..., ids=True)`.

    A group is one sequence, so it holds at most `capacity` tokens.
    """
    inside = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    grouped = packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), inside.alias("pieces"))
    joined = F.aggregate("pieces", F.lit(b""), lambda all_ids, p: F.concat(all_ids, p["ids"]))
    return grouped.select("sequence_id", "length", joined.alias("ids"))
