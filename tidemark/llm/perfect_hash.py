"""Minimal perfect hashing of a set of 64-bit keys, built bucket by bucket.

Keys are dealt into buckets by the leading bits of a hash. Within a bucket each level hashes
the keys left into a bit array twice their number and keeps those that are alone in their
place; the others go on to the next level. A key's slot is the number of kept places before
its own over all levels and buckets, so n keys get the slots 0 to n - 1. A key outside the set
gets some slot or none, so a table indexed by slot keeps the keys beside its values and a
lookup compares them.

Distinct keys have distinct hashes at every level, so a bucket always ends; the buckets are
groups of a DataFrame and hold about `BUCKET_KEYS` keys each.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrow_text import constants, mix
from tidemark.llm.tasks import map_batches

BUCKET_KEYS = 16_384
#: Places of a level for each key that reaches it.
ROOM = 2
#: Leading bits of the hash that choose a bucket.
PREFIX_BITS = 24
_PREFIX_SEED = np.uint64(0x5851F42D4C957F2D)

_BUILT = "bucket long, sizes array<long>, words binary, keys binary"


def prefixes(keys: np.ndarray) -> np.ndarray:
    """The leading bits of each key's hash."""
    return (mix(keys.astype(np.uint64) ^ _PREFIX_SEED) >> np.uint64(64 - PREFIX_BITS)).astype(np.int64)


def _places(keys: np.ndarray, level: int, size: np.ndarray | int) -> np.ndarray:
    seeds = constants(level + 1, 4242)
    return (mix(keys * seeds[level] ^ seeds[level]) % np.asarray(size, np.uint64)).astype(np.int64)


def build_bucket(keys: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """(places of each level, bit words of all levels, keys in the order of their slots)."""
    left = np.unique(keys.astype(np.uint64))
    sizes, words, ordered = [], [], []
    while len(left):
        size = 64 * -(-ROOM * len(left) // 64)
        places = _places(left, len(sizes), size)
        alone = np.bincount(places, minlength=size) == 1
        kept = alone[places]
        words.append(np.packbits(alone, bitorder="little").view(np.uint64))
        ordered.append(left[kept][np.argsort(places[kept])])
        sizes.append(size)
        left = left[~kept]
    none = np.zeros(0, np.uint64)
    return sizes, np.concatenate(words or [none]), np.concatenate(ordered or [none])


def build(keys: DataFrame, buckets: int) -> DataFrame:
    """(bucket, sizes, words, keys) of distinct long `key`s, one row per bucket that has any."""

    def with_prefix(batches):
        for batch in batches:
            found = batch.column("key").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(prefixes(found), pa.int64())], ["key", "prefix"])

    def one(table: pa.Table) -> pa.Table:
        # the group's bucket follows from any of its keys
        found = table.column("key").to_numpy()
        sizes, words, ordered = build_bucket(found)
        row = {"bucket": [int(prefixes(found[:1])[0] * buckets >> PREFIX_BITS)], "sizes": [sizes], "words": [words.tobytes()], "keys": [ordered.tobytes()]}
        return pa.table(row, pa.schema([("bucket", pa.int64()), ("sizes", pa.list_(pa.int64())), ("words", pa.binary()), ("keys", pa.binary())]))

    if not 0 < buckets <= 1 << PREFIX_BITS:
        raise ValueError(f"no {buckets} buckets of {PREFIX_BITS} bits")
    dealt = map_batches(keys.select("key"), with_prefix, "key long, prefix long")
    bucket = F.shiftright(F.col("prefix") * F.lit(buckets), PREFIX_BITS).alias("bucket")
    return dealt.select("key", bucket).groupBy("bucket").applyInArrow(one, _BUILT)


class PerfectHash:
    """Slots of the keys in some built buckets, counted from 0 in the order of buckets."""

    def __init__(self, built: Iterable, buckets: int):
        rows = sorted(built, key=lambda r: r["bucket"])
        self.buckets = buckets
        self.levels = max((len(r["sizes"]) for r in rows), default=0)
        self.sizes = np.zeros((self.levels, buckets), np.int64)
        self.starts = np.zeros((self.levels, buckets), np.int64)
        words, keys, start = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)], 0
        for r in rows:
            for level, size in enumerate(r["sizes"]):
                self.sizes[level, r["bucket"]], self.starts[level, r["bucket"]] = size, start
                start += size // 64
            words.append(np.frombuffer(r["words"], np.uint64))
            keys.append(np.frombuffer(r["keys"], np.uint64))
        self.words, self.keys = np.concatenate(words), np.concatenate(keys)
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(ones) - ones

    def __len__(self) -> int:
        return len(self.keys)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 for keys outside the set."""
        keys = keys.astype(np.uint64)
        bucket = prefixes(keys) * self.buckets >> PREFIX_BITS
        found = np.full(len(keys), -1, np.int64)
        open_rows = np.arange(len(keys))
        for level in range(self.levels):
            size = self.sizes[level, bucket[open_rows]]
            open_rows, size = open_rows[size > 0], size[size > 0]
            if not len(open_rows):
                break
            place = _places(keys[open_rows], level, size)
            at = self.starts[level, bucket[open_rows]] + (place >> 6)
            bit = (place & 63).astype(np.uint64)
            word = self.words[at]
            hit = (word >> bit) & np.uint64(1) == 1
            lower = word & ((np.uint64(1) << bit) - np.uint64(1))
            found[open_rows[hit]] = (self.before[at] + np.bitwise_count(lower))[hit]
            open_rows = open_rows[~hit]
        known = found >= 0
        known[known] = self.keys[found[known]] == keys[known]
        return np.where(known, found, -1)
