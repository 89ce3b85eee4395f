"""Byte-level BPE by tree reduction, equal to applying the ranks merge by merge.

The pattern cuts a text into pieces that are encoded on their own, so texts are joined from
pieces by plain concatenation. A piece that is no token itself is halved, the halves are
encoded recursively, and two neighbours are joined at their boundary: the last token of the
left and the first of the right are encoded anew. The tokens outside that window are final
once the window's outer tokens are stable against them, which is decided pair by pair: a
sequence of tokens is the encoding of its bytes if and only if every two neighbours are the
encoding of theirs. Until then the window grows by the unstable side. Only windows are ever
merged rank by rank, so a piece of n bytes takes about n log n steps whatever its length.

Decoding concatenates the tokens' bytes up the same tree, which is one join of byte strings.

Encodings of short pieces, of short halves and of token pairs are remembered per worker, in
tables of at most `REMEMBERED` entries (fewer, and emptied after each task, in `encode`); a full
table is emptied, so memory is bounded and results never change.

Defined cases: null and empty text have no tokens and decode to no bytes; special tokens are
ordinary text; repeated rows and null ids are ordinary rows; other columns are returned as they
are by `encode`, unless they are called like those it adds, which it replaces.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, IntegerType, LongType, StructType

from tidemark.llm.arrow_text import bytes_of, row_groups
from tidemark.llm.tasks import map_batches

REMEMBERED = 400_000
#: The same for `encode`, whose tasks hold rows and ids beside the tables.
REMEMBERED_BESIDE_ROWS = 100_000
#: Pieces of more characters are not remembered.
LONGEST_REMEMBERED = 48
#: Halves of pieces up to so many bytes, which pieces share, are remembered too.
SHORT_HALF = 8
#: Texts of more characters are cut by an iterator instead of a list of all pieces.
LONG_TEXT = 1_000_000
_CHUNK = 100_000


def read_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary file: a base64 token and its rank per line. Read on the driver, a few MB."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Vocabulary:
    """Encoding and decoding with one set of ranks and one pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.remembered = REMEMBERED
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.names = {rank: str(rank) for rank in self.tokens}
        self.pattern = regex.compile(pattern)
        self.pairs: dict[tuple[int, int], list[int]]
        self.halves: dict[bytes, list[int]]
        self.known: _Known
        self.forget()

    def forget(self) -> None:
        """Empty the tables of remembered encodings."""
        self.pairs, self.halves, self.known = {}, {}, _Known(self)

    def _merged(self, data: bytes) -> list[int]:
        """Rank-by-rank merges of a short window."""
        ranks = self.ranks
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                rank = ranks.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[p] for p in parts]

    def _pair(self, a: int, b: int) -> list[int]:
        found = self.pairs.get((a, b))
        if found is None:
            if len(self.pairs) >= self.remembered:
                self.pairs.clear()
            found = self.pairs[a, b] = self._merged(self.tokens[a] + self.tokens[b])
        return found

    def _stable(self, a: int, b: int) -> bool:
        return self._pair(a, b) == [a, b]

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the bytes of two encodings."""
        if not left or not right:
            return left or right
        i, j, step = len(left) - 1, 1, 1
        window = self._pair(left[-1], right[0])
        while True:
            left_open = i > 0 and not self._stable(left[i - 1], window[0])
            right_open = j < len(right) and not self._stable(window[-1], right[j])
            if not left_open and not right_open:
                return left[:i] + window + right[j:]
            if left_open:
                i = max(0, i - step)
            if right_open:
                j = min(len(right), j + step)
            step *= 2
            window = self._merged(b"".join([self.tokens[t] for t in left[i:] + right[:j]]))

    def piece(self, data: bytes) -> list[int]:
        rank = self.ranks.get(data)
        if rank is not None:
            return [rank]
        ids = self.halves.get(data)
        if ids is None:
            half = len(data) // 2
            ids = self.join(self.piece(data[:half]), self.piece(data[half:]))
            if len(data) <= SHORT_HALF:
                if len(self.halves) >= self.remembered:
                    self.halves.clear()
                self.halves[data] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        known = self.known
        if len(text) <= LONG_TEXT:
            return list(itertools.chain.from_iterable([known[p] for p in self.pattern.findall(text)]))
        ids: list[int] = []
        matches = self.pattern.finditer(text)
        while chunk := list(itertools.islice(matches, _CHUNK)):
            for m in chunk:
                ids += known[m[0]]
        return ids

    def decode(self, ids: list[int]) -> bytes:
        tokens = self.tokens
        return b"".join([tokens[i] for i in ids])

    def decimal(self, ids: list[int]) -> str:
        names = self.names
        return ",".join([names[i] for i in ids])


class _Known(dict):
    """Encodings of pieces, filled on demand."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, piece: str) -> list[int]:
        ids = self.vocabulary.piece(piece.encode("utf-8"))
        if len(piece) <= LONGEST_REMEMBERED:
            if len(self) >= self.vocabulary.remembered:
                self.clear()
            self[piece] = ids
        return ids


#: The last vocabulary used by this worker.
_loaded: dict[str, Vocabulary] = {}


def _vocabulary(broadcast) -> Vocabulary:
    ranks, pattern, name = broadcast.value
    if name not in _loaded:
        _loaded.clear()
        _loaded[name] = Vocabulary(ranks, pattern)
    return _loaded[name]


def _broadcast(spark: SparkSession, path: str, pattern: str):
    """Ranks, pattern and a digest of both, by which a worker knows a vocabulary again."""
    ranks = read_ranks(path)
    digest = hashlib.sha256(pattern.encode())
    for token, rank in ranks.items():
        digest.update(b"%d %d " % (rank, len(token)) + token)
    return spark.sparkContext.broadcast((ranks, pattern, digest.hexdigest()))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with about a megabyte of text together."""
    for batch in batches:
        _, offsets = bytes_of(batch.column("text"))
        for lo, hi in row_groups(offsets):
            yield batch.slice(lo, hi - lo)


def _texts(batch: pa.RecordBatch) -> Iterator[str]:
    return (value.as_py() or "" for value in batch.column("text"))


def encode(docs: DataFrame, path: str, pattern: str, round_trip: bool = False) -> DataFrame:
    """`docs` with n_tokens and ids (array<int>) added, and with `round_trip` a column of that name

    which says whether the ids decode to the text's bytes, found in the same task.
    """
    broadcast = _broadcast(docs.sparkSession, path, pattern)
    added = ["n_tokens", "ids"] + (["round_trip"] if round_trip else [])
    kept = [f for f in docs.schema.fields if f.name not in added]

    def encode_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(broadcast)
        vocabulary.remembered = REMEMBERED_BESIDE_ROWS
        try:
            for part in _parts(batches):
                ids, same = [], []
                for text in _texts(part):
                    found = vocabulary.encode(text)
                    if round_trip:
                        same.append(vocabulary.decode(found) == text.encode("utf-8"))
                    ids.append(np.array(found, np.int32))
                columns = [part.column(f.name) for f in kept]
                columns += [pa.array([len(x) for x in ids], pa.int64()), pa.array(ids, pa.list_(pa.int32()))]
                if round_trip:
                    columns.append(pa.array(same, pa.bool_()))
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in kept] + added)
        finally:
            vocabulary.forget()

    schema = StructType(list(kept)).add("n_tokens", LongType()).add("ids", ArrayType(IntegerType()))
    if round_trip:
        schema = schema.add("round_trip", BooleanType())
    return map_batches(docs.select(*[f"`{f.name}`" for f in kept]), encode_batches, schema)


def decode(encoded: DataFrame, path: str, pattern: str, carry: list[str]) -> DataFrame:
    """The columns `carry` of `encoded` and decoded, the bytes of `ids`."""
    broadcast = _broadcast(encoded.sparkSession, path, pattern)
    kept = [encoded.schema[c] for c in carry]

    def decode_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(broadcast)
        for batch in batches:
            decoded = [vocabulary.decode(ids.as_py() or []) for ids in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in carry] + [pa.array(decoded, pa.binary())], carry + ["decoded"])

    return map_batches(encoded.select(*dict.fromkeys([*carry, "ids"])), decode_batches, StructType(list(kept)).add("decoded", BinaryType()))


def round_trip_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row, encoded and decoded in one pass."""
    broadcast = _broadcast(docs.sparkSession, path, pattern)

    def digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(broadcast)
        vocabulary.remembered = REMEMBERED
        for batch in batches:
            counts, of_ids, of_bytes = [], [], []
            for text in _texts(batch):
                ids = vocabulary.encode(text)
                counts.append(len(ids))
                of_ids.append(hashlib.sha256(vocabulary.decimal(ids).encode()).hexdigest())
                of_bytes.append(hashlib.sha256(vocabulary.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select("doc_id", "text")
    schema = StructType([rows.schema["doc_id"]]).add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")
    return map_batches(rows, digest_batches, schema)
