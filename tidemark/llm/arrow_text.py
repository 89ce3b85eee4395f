"""Words of many texts at once, as 64-bit hashes, from the bytes of an Arrow string column.

A word is hashed by a polynomial over a table of fixed pseudo-random byte values, taken from
prefix sums, so one pass of numpy gives the hash of every word of a segment of up to a
megabyte. Texts are cut at word boundaries only: any length is hashed whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SEGMENT_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def constants(n: int, seed: int) -> np.ndarray:
    """n fixed odd 64-bit values."""
    with np.errstate(over="ignore"):
        steps = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_BASE) + np.uint64(seed)
        return mix(steps) | np.uint64(1)


_BYTE_VALUES = constants(256, 77)
#: The same value for A-Z and a-z.
_FOLDED = _BYTE_VALUES.copy()
_FOLDED[65:91] = _BYTE_VALUES[97:123]

_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least n of each."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n, SEGMENT_BYTES + 1)
        tables = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            tables.append(np.multiply.accumulate(table))
        _powers = (tables[0], tables[1])
    return _powers


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, n + 1 offsets) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def table(members: bytes) -> np.ndarray:
    """A byte class as a lookup table."""
    found = np.zeros(256, bool)
    found[list(members)] = True
    return found


#: Everything but [\x20\x09-\x0D].
NOT_SPACE = ~table(b"\x20\x09\x0a\x0b\x0c\x0d")


def _segments(is_word: np.ndarray, opens: np.ndarray) -> Iterator[tuple[int, int]]:
    start, n = 0, len(is_word)
    while start < n:
        end = min(n, start + SEGMENT_BYTES)
        if end < n:
            # a cut may stand before a byte outside words or before the first byte of a text
            window = ~is_word[start + 1 : end + 1] | opens[start + 1 : end + 1]
            cuts = np.flatnonzero(window)
            if len(cuts):
                end = start + 1 + int(cuts[-1])
            else:
                rest = np.flatnonzero(~is_word[end:] | opens[end:])
                end = end + int(rest[0]) if len(rest) else n
        yield start, end
        start = end


def words(data: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray = NOT_SPACE, classes: np.ndarray | None = None, fold: bool = True):
    """(hash, start, end) of every word, and n + 1 offsets of the texts into them.

    Words are runs of `word_bytes`. With `classes` (a small number per byte) a run also ends
    where the number changes. With `fold`, A-Z hash as a-z.
    """
    is_word = word_bytes[data]
    opens = np.zeros(len(data), bool)
    opens[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    if classes is not None:
        kind = classes[data]
        opens[1:] |= kind[1:] != kind[:-1]
    first = is_word.copy()
    first[1:] &= ~is_word[:-1] | opens[1:]
    last = is_word.copy()
    last[:-1] &= ~is_word[1:] | opens[1:]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    hashes = np.empty(len(starts), np.uint64)
    values = _FOLDED if fold else _BYTE_VALUES
    for lo, hi in _segments(is_word, opens):
        a, b = np.searchsorted(starts, (lo, hi))
        if a == b:
            continue
        up, down = _power_tables(hi - lo + 1)
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(values[data[lo:hi]] * up[: hi - lo], out=sums[1:])
        at = starts[a:b] - lo
        hashes[a:b] = (sums[ends[a:b] - lo] - sums[at]) * down[at]
    return mix(hashes), starts, ends, np.searchsorted(starts, offsets)


def shingle_sets(hashes: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of `size` consecutive words of each text, sorted, and n + 1 offsets.

    A text of fewer words has its whole sequence as one; a text without words has none.
    """
    weights = constants(size, 505)
    n = max(0, len(hashes) - size + 1)
    rows = np.zeros(n, np.uint64)
    for k in range(size):
        rows += hashes[k : k + n] * weights[k]
    rows = mix(rows)
    sets, counts = [], np.zeros(len(bounds), np.int64)
    short = constants(size, 909)
    for i, (lo, hi) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
        if hi - lo >= size:
            found = np.unique(rows[lo : hi - size + 1])
        elif hi > lo:
            with np.errstate(over="ignore"):
                found = mix(np.array([np.sum(hashes[lo:hi] * weights[: hi - lo], dtype=np.uint64) + short[hi - lo]]))
        else:
            continue
        sets.append(found)
        counts[i + 1] = len(found)
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), np.cumsum(counts)


def row_groups(offsets: np.ndarray, most: int = SEGMENT_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about `most` bytes together; a longer text stands alone."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1)
        yield lo, hi
        lo = hi
