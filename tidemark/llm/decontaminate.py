"""Benchmark passages in documents, found by one Aho-Corasick automaton over normalised windows.

Words are runs of digits, letters a-z (A-Z lower-cased) and characters beyond ASCII; everything
else separates. A window is ten consecutive words of a benchmark item, or the whole item if it
has fewer. The automaton's patterns are the windows with a space before each word and after the
last; a document is normalised the same way and scanned once, so overlapping occurrences of all
windows come out of one pass. Word positions are mapped back to the original text.

The windows of all items are computed and deduplicated in Spark and dealt by hash into blocks
of about `BLOCK_CHARS` characters, which is what one automaton, one broadcast and one worker
hold. A benchmark of more than one block is thinned first: one pass over the documents per
`BLOCK_WINDOWS` windows looks every run of words up among the 64-bit hashes of the windows, and
only windows whose hash was met go on. A window that occurs is always met, so the automaton
gives the same rows; what it has to hold follows the passages that documents share with the
benchmark, not the benchmark. Blocks that are left over are scanned one after another, each
adding its hits to the rows, so the benchmark may have any size.

Defined cases: null text has no words; an item without words has no windows; an item with a
null id is named by the empty string; items repeated under one id count once; documents are
rows, so repeated ids stay repeated; empty tables give no rows, an empty benchmark no hits.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructType

from tidemark.llm.arrow_text import bytes_of, constants, mix, row_groups, table, words
from tidemark.llm.tasks import map_batches
from tidemark.session import drop_aside, materialize, read_aside, write_aside

WINDOW_WORDS = 10
BLOCK_CHARS = 2_000_000
#: Hashes of windows that one thinning pass, one broadcast and one worker hold, 8 bytes each.
BLOCK_WINDOWS = 2_000_000
#: Low bits of a hash that are looked up in a table of flags before the hash itself.
_FLAG_BITS = 25

_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

_IN_WORD = table(bytes(b for b in range(256) if chr(b).isascii() and chr(b).isalnum() or b >= 128))
_PLACES, _LENGTHS = constants(WINDOW_WORDS, 606), constants(WINDOW_WORDS + 1, 707)


def _normal_words(text: bytes) -> list[bytes]:
    return text.translate(_NORMAL).split()


def _window_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item_id, window), windows as Latin-1 views of their bytes."""
    for batch in batches:
        data, offsets = bytes_of(batch.column("text"))
        ids, windows = [], []
        for i, item in enumerate(batch.column("item_id").to_pylist()):
            found = _normal_words(data[offsets[i] : offsets[i + 1]].tobytes())
            for k in range(max(1, len(found) - WINDOW_WORDS + 1) if found else 0):
                ids.append(item)
                windows.append(b" " + b" ".join(found[k : k + WINDOW_WORDS]) + b" ")
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(windows, pa.binary())], ["item_id", "window"])


def _run_hashes(hashes: np.ndarray, first: np.ndarray | slice, n_words: int) -> np.ndarray:
    """Hashes of the runs of `n_words` words at the positions `first`, from the hashes of the words."""
    out = _LENGTHS[n_words]
    for k in range(n_words):
        words_here = hashes[k:][first] if isinstance(first, slice) else hashes[first + k]
        out = out + words_here * _PLACES[k]
    return mix(out)


def _hash_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item_id, window) with the window's hash and its number of words."""
    for batch in batches:
        found = batch.column("window").to_pylist()
        offsets = np.concatenate([[0], np.cumsum([len(w) for w in found])]).astype(np.int64)
        hashes, _, _, bounds = words(np.frombuffer(b"".join(found), np.uint8), offsets, _IN_WORD)
        lengths, out = np.diff(bounds), np.zeros(len(found), np.uint64)
        for n in np.unique(lengths).tolist():
            out[lengths == n] = _run_hashes(hashes, bounds[:-1][lengths == n], n)
        extra = [pa.array(out.view(np.int64)), pa.array(lengths.astype(np.int32))]
        yield pa.RecordBatch.from_arrays([*batch.columns, *extra], [*batch.schema.names, "hash", "n"])


def _finder(broadcast, text_name: str):
    """Hashes of one block that runs of words of the documents have, once per task."""

    def find_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, packed = broadcast.value
        wanted = np.frombuffer(packed, np.uint64)
        low = np.uint64((1 << _FLAG_BITS) - 1)
        flags, met = np.zeros(1 << _FLAG_BITS, bool), np.zeros(len(wanted), bool)
        flags[wanted & low] = True
        for batch in batches:
            data, offsets = bytes_of(batch.column(text_name))
            for lo, hi in row_groups(offsets):
                hashes, _, _, _ = words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], _IN_WORD)
                for n in lengths:
                    # a run over the end of a text can only keep a window too many
                    runs = _run_hashes(hashes, slice(0, max(0, len(hashes) - n + 1)), n)
                    runs = runs[flags[runs & low]]
                    at = np.minimum(np.searchsorted(wanted, runs), len(wanted) - 1)
                    met[at[wanted[at] == runs]] = True
        yield pa.RecordBatch.from_arrays([pa.array(wanted[met].view(np.int64))], ["hash"])

    return find_batches


def _occurring(windows: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """The windows that documents hold, and at most a few more whose hash is that of other words."""
    spark = windows.sparkSession
    hashed = materialize(map_batches(windows, _hash_batches, "item_id string, window binary, hash long, n int"), "hashed-windows")
    distinct = hashed.select("hash", "n").distinct()
    count = max(1, -(-distinct.count() // BLOCK_WINDOWS))
    block, met = F.pmod(F.col("hash"), F.lit(count)), None
    for k in range(count):
        part = distinct.where(block == k).toArrow()
        wanted = np.sort(part.column("hash").to_numpy().view(np.uint64))
        lengths = sorted(part.column("n").unique().to_pylist())
        if len(wanted):
            send = spark.sparkContext.broadcast((lengths, wanted.tobytes()))
            found = materialize(map_batches(docs.select(text), _finder(send, text), "hash long").distinct(), "met-windows")
            met = found if met is None else met.union(found)
    return windows.limit(0) if met is None else hashed.join(met, "hash", "left_semi").select("item_id", "window")


def _blocks(benchmark: DataFrame, docs: DataFrame, text: str) -> Iterator[tuple[list[tuple[bytes, str]], bool]]:
    """Distinct (window, item) pairs of one bounded block after another, and whether it is the last."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text")
    windows = materialize(map_batches(items, _window_batches, "item_id string, window binary").distinct(), "windows")
    count = _block_count(windows)
    if count > 1:
        windows = materialize(_occurring(windows, docs, text), "occurring-windows")
        count = _block_count(windows)
    block = F.pmod(F.xxhash64("window", "item_id"), F.lit(count))
    for k in range(count):
        yield [(bytes(w), i) for w, i in windows.where(block == k).select("window", "item_id").toLocalIterator()], k == count - 1


def _block_count(windows: DataFrame) -> int:
    chars = windows.agg(F.sum(F.octet_length("window") + F.octet_length("item_id"))).first()[0] or 0
    return max(1, -(-chars // BLOCK_CHARS))


#: The automaton of the last block seen by this worker.
_automata: dict[str, tuple] = {}


def _automaton(name: str, pairs: list[tuple[bytes, str]]) -> tuple:
    if name not in _automata:
        _automata.clear()
        items: dict[str, list[str]] = {}
        for window, item in pairs:
            items.setdefault(window.decode("latin-1"), []).append(item)
        machine = ahocorasick.Automaton()
        for number, window in enumerate(items):
            machine.add_word(window, number)
        if items:
            machine.make_automaton()
        _automata[name] = (machine, [(len(w), w.count(" ") - 1, tuple(of)) for w, of in items.items()])
    return _automata[name]


def _scan(text: bytes, machine, patterns: list) -> tuple[int, list[int], set[str]]:
    """Words of one text, [first, end) word ranges that windows cover, items found."""
    found = _normal_words(text)
    if not patterns or not found:
        return len(found), [], set()
    line = b" " + b" ".join(found) + b" "
    covered, items = [], set()
    for end, number in machine.iter(line.decode("latin-1")):
        length, n_words, of = patterns[number]
        covered.append((end - length + 1, n_words))
        items.update(of)
    if not covered:
        return len(found), [], items
    spaces = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    first = np.searchsorted(spaces, [at for at, _ in covered])
    return len(found), _merged(zip(first.tolist(), (first + [n for _, n in covered]).tolist())), items


def _merged(ranges) -> list[int]:
    """Flat, sorted, disjoint [first, end) ranges."""
    flat: list[int] = []
    for first, end in sorted(ranges):
        if flat and first <= flat[-1]:
            flat[-1] = max(flat[-1], end)
        else:
            flat += [first, end]
    return flat


def _original(text: bytes, flat: list[int]) -> list[int]:
    """Word ranges as [start, end) code points of the text as it was."""
    if not flat:
        return []
    spans = [m.span() for m in _WORD.finditer(text)]
    points = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
    return [int(points[spans[k][0] if i % 2 == 0 else spans[k - 1][1]]) for i, k in enumerate(flat)]


def _scanner(name: str, broadcast, text_name: str, last: bool):
    def scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, patterns = _automaton(name, broadcast.value)
        for batch in batches:
            data, offsets = bytes_of(batch.column(text_name))
            names = batch.schema.names
            before = batch.column("hits").to_pylist() if "hits" in names else None
            known = batch.column("item_ids").to_pylist() if "item_ids" in names else None
            counts, hits, items, spans = [], [], [], []
            for i in range(batch.num_rows):
                text = data[offsets[i] : offsets[i + 1]].tobytes()
                n, flat, of = _scan(text, machine, patterns)
                if before is not None:
                    flat = _merged(zip(flat[::2] + before[i][::2], flat[1::2] + before[i][1::2]))
                    of.update(known[i])
                counts.append(n)
                hits.append(flat)
                items.append(sorted(of))
                spans.append(_original(text, flat) if last else [])
            kept = [(n, c) for n, c in zip(names, batch.columns) if n not in ("n_words", "hits", "item_ids")]
            result = kept + [
                ("n_words", pa.array(counts, pa.int64())),
                ("hits", pa.array(hits, pa.list_(pa.int32()))),
                ("item_ids", pa.array(items, pa.list_(pa.string()))),
            ]
            if last:
                result.append(("spans", pa.array(spans, pa.list_(pa.int64()))))
            yield pa.RecordBatch.from_arrays([c for _, c in result], [n for n, _ in result])

    return scan_batches


def _scanned(docs: DataFrame, benchmark: DataFrame, carry: list[str]) -> DataFrame:
    """Columns `carry` of `docs` as _c0, _c1, ... with n_words, hits, item_ids and spans."""
    spark = docs.sparkSession
    names = [f"_c{i}" for i in range(len(carry))]
    text = f"_c{carry.index('text')}" if "text" in carry else "_text"
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(carry, names)], *([] if "text" in carry else [F.col("text").alias("_text")]))
    base, path = rows.schema, None
    for pairs, last in _blocks(benchmark, rows, text):
        block = spark.sparkContext.broadcast(pairs)
        schema = StructType(base.fields[:])
        schema = schema.add("n_words", LongType()).add("hits", ArrayType(IntegerType())).add("item_ids", ArrayType(StringType()))
        if last:
            schema = schema.add("spans", ArrayType(LongType()))
        rows = map_batches(rows, _scanner(uuid.uuid4().hex, block, text, last), schema)
        if not last:
            done, path = path, write_aside(rows, "scanned")
            rows = read_aside(spark, path, schema)
            if done:
                drop_aside(spark, done)
    return rows.select(*names, "n_words", "hits", "item_ids", "spans")


def find_benchmark_passages(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per row of `docs` (doc_id, text), held against `benchmark` (item_id, text):

    doc_id; n_words; hits, flat [first, end) ranges of covered words; item_ids, the sorted ids
    of items with an occurring window; spans, the hits as [start, end) code points of the text.
    """
    return _scanned(docs, benchmark, ["doc_id"]).withColumnRenamed("_c0", "doc_id")


def covered_words(hits: str) -> Column:
    """Words covered by flat [first, end) ranges."""
    return F.aggregate(
        F.transform(hits, lambda at, i: F.when(i % 2 == 0, -at).otherwise(at).cast("long")), F.lit(0).cast("long"), lambda a, b: a + b
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` in which no benchmark window occurs, with all their columns."""
    clean = _scanned(docs, benchmark, docs.columns).where(F.size("hits") == 0)
    return clean.drop("n_words", "hits", "item_ids", "spans").toDF(*docs.columns)
