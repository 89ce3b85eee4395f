"""Runs of periodically repeated words by Baier grouping.

The first phase of Baier's suffix sorter groups positions by their longest Lyndon factor,
from the highest group down: a group's members extend the factors of the nearest lower
positions before them, which split off into groups just above their old one. A position's
final group names its factor and the group's length is the factor's, so the phase gives the
Lyndon array directly. It is run under an order of the words and under the inverse one.

A run of at least `min_periods` periods holds several copies of its Lyndon root side by side,
positions of one group at distances of the group's length. From the first and last of such
copies the longest common extensions to both sides, each shorter than the root, give the run.
Every run ends where one of the two orders breaks it, so none is missed.

The grouping is done over the stretches that can hold a run at all: every sequence of a few
words inside a run occurs again one period away, so words that no repeated sequence of their
text covers are left out. That is exact, since hashes that collide only add words.

Words are runs of bytes other than ``[\\x20\\x09-\\x0D]`` and equal as bytes; a text is read
whole. Memory grows with one text, or a megabyte of texts.

Defined cases: a null or empty text has no words, no runs and an empty collapsed text;
repeated rows and null ids are ordinary rows; other columns are returned as they are, unless
they are called like those added, which are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

from tidemark.llm.arrow_text import bytes_of, constants, mix, row_groups
from tidemark.llm.tasks import map_batches

MIN_LENGTH = 6
MIN_PERIODS = 4

_RUN = StructType().add("start", LongType()).add("length", LongType()).add("period", LongType())
_RUN_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def lyndon_groups(letters: list[int], descending: bool = False) -> tuple[list[int], list[int]]:
    """(group of every position, factor length of every group) of the longest Lyndon factors.

    Letters are positive; zeros cut the sequence, come first and have group -1. Two positions
    share a group if and only if their factors are equal.
    """
    members_of: dict[int, list[int]] = defaultdict(list)
    for i, letter in enumerate(letters):
        members_of[letter].append(i)
    members_of.pop(0, None)
    ranked = sorted(members_of, reverse=not descending)
    # groups as a list linked in both directions, highest first
    members = [members_of[letter] for letter in ranked]
    count = len(members)
    below, above = list(range(1, count + 1)), list(range(-1, count - 1))
    if count:
        below[-1] = -1
    alive, length = [len(m) for m in members], [1] * count
    group = [-1] * len(letters)
    for g, rows in enumerate(members):
        for i in rows:
            group[i] = g
    previous = [0] * len(letters)
    done = bytearray(len(letters))

    def split_off(rows: list[int], old: int, longer: int) -> None:
        if alive[old] == len(rows):
            length[old] += longer
            return
        new, higher = len(members), above[old]
        alive[old] -= len(rows)
        members.append(rows)
        alive.append(len(rows))
        length.append(length[old] + longer)
        below.append(old)
        above.append(higher)
        above[old] = below[higher] = new
        for i in rows:
            group[i] = new

    current = 0 if count else -1
    while current >= 0:
        rows = members[current]
        if len(rows) != alive[current]:
            rows = [i for i in rows if group[i] == current]
        size = length[current]
        if len(rows) == 1:
            i = rows[0]
            done[i] = 1
            j = i - 1
            while done[j]:
                j = previous[j]
            previous[i] = j
            if letters[j]:
                split_off([j], group[j], size)
        else:
            for i in rows:
                done[i] = 1
            # the members in a row before which the same lower position is nearest
            followed: list[list[int]] = []
            last = -1
            for i in rows:
                j = i - 1
                while done[j]:
                    j = previous[j]
                previous[i] = j
                if j == last:
                    followed[-1][1] += 1
                elif letters[j]:
                    followed.append([j, 1])
                    last = j
            parts: dict[tuple[int, int], list[int]] = {}
            for j, times in followed:
                parts.setdefault((times, group[j]), []).append(j)
            for times, old in sorted(parts, reverse=True):
                split_off(parts[times, old], old, times * size)
        current = below[current]
    return group, length


def _runs_under(letters: list[int], line: np.ndarray, descending: bool, min_length: int, min_periods: int) -> Iterator[tuple[int, int, int]]:
    """(start, length, period) of the runs whose end breaks the given order."""
    group, length = lyndon_groups(letters, descending)
    if not length:
        return
    groups = np.array(group)
    periods = np.where(groups >= 0, np.array(length)[groups], 0)
    n = len(letters)
    heads = np.flatnonzero(groups >= 0)
    for copy in range(1, min_periods - 1):
        ahead = heads + copy * periods[heads]
        heads, ahead = heads[ahead < n], ahead[ahead < n]
        heads = heads[groups[ahead] == groups[heads]]
    before = heads - periods[heads]
    heads = heads[(before < 0) | (groups[np.maximum(before, 0)] != groups[heads])]
    for i in heads.tolist():
        q, g = int(periods[i]), group[i]
        end = i + q * (min_periods - 1)
        while end < n and group[end] == g:
            end += q
        # the copies end at `end`; a further one would be of the group, so fewer than q words agree
        ahead = line[end : end + q] != line[end - q : end - q + len(line[end : end + q])]
        forward = int(np.argmax(ahead)) if ahead.any() else len(ahead)
        reach = min(q, i)
        behind = (line[i - reach : i] != line[i - reach + q : i + q])[::-1]
        backward = int(np.argmax(behind)) if behind.any() else reach
        start, total = i - backward, end + forward - (i - backward)
        if total >= max(min_length, min_periods * q):
            yield start, total, q


def _repeated(words: np.ndarray, texts: np.ndarray, size: int) -> np.ndarray:
    """Whether a word lies in a sequence of `size` words that occurs again in its text."""
    n = len(words) - size + 1
    covered = np.zeros(len(words), bool)
    if n < 2:
        return covered
    weights = constants(size + 1, 1101)
    hashed = mix(words.astype(np.uint64) + weights[size])
    grams = texts[:n].astype(np.uint64) * weights[size]
    for k in range(size):
        grams += hashed[k : k + n] * weights[k]
    whole = np.flatnonzero(texts[:n] == texts[size - 1 :])
    grams = grams[whole]
    order = np.argsort(grams)
    same = grams[order[1:]] == grams[order[:-1]]
    again = np.zeros(len(grams), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, whole[again], 1)
    np.add.at(edges, whole[again] + size, -1)
    return np.cumsum(edges[:-1]) > 0


def runs_of(texts: list[list[int]], min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of each sequence of word numbers, sorted."""
    found: list[set[tuple[int, int, int]]] = [set() for _ in texts]
    words = np.fromiter(itertools.chain.from_iterable(texts), np.int64, sum(map(len, texts)))
    counts = np.array([len(t) for t in texts], np.int64)
    numbers, firsts = np.repeat(np.arange(len(texts)), counts), np.cumsum(counts) - counts
    # the longest sequences of which each in a run has its like one period before or after
    size = min(max(min_length, min_periods * q) - 2 * q + 1 for q in range(1, max(2, min_length)))
    live = np.flatnonzero(_repeated(words, numbers, size))
    if not len(live):
        return [[] for _ in texts]
    # zeros stand before every stretch of neighbouring words of one text, and at the end
    opens = np.ones(len(live), bool)
    opens[1:] = (live[1:] != live[:-1] + 1) | (numbers[live[1:]] != numbers[live[:-1]])
    at = np.arange(len(live)) + np.cumsum(opens)
    line = np.zeros(len(live) + int(opens.sum()) + 1, np.int64)
    line[at] = words[live] + 1
    origin = np.zeros(len(line), np.int64)
    origin[at] = live
    letters = line.tolist()
    for descending in (False, True):
        for start, length, period in _runs_under(letters, line, descending, min_length, min_periods):
            place = int(origin[start])
            text = int(numbers[place])
            found[text].add((place - int(firsts[text]), length, period))
    return [sorted(runs) for runs in found]


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that stand in no run, or in the first period of every run they stand in."""
    if not runs:
        return b" ".join(words)
    edges = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    dropped = np.cumsum(edges[:-1]) > 0
    return b" ".join(itertools.compress(words, ~dropped))


def find_runs(docs: DataFrame, min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> DataFrame:
    """`docs` (text) with n_words, runs (start, length and period in words, by start) and collapsed.

    A run is a longest stretch of at least `min_length` words and `min_periods` periods in which
    words one period apart are equal. `collapsed` is the text with each run cut to its first
    period, its words joined by one space.
    """
    if min_periods < 3 or min_length < min_periods:
        raise ValueError("runs need at least three periods and as many words")
    added = ["n_words", "runs", "collapsed"]
    kept = [f for f in docs.schema.fields if f.name not in added]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, offsets = bytes_of(batch.column("text"))
            for lo, hi in row_groups(offsets):
                part = batch.slice(lo, hi - lo)
                words = [(value.as_py() or "").encode("utf-8").split() for value in part.column("text")]
                numbers: dict[bytes, int] = defaultdict(itertools.count().__next__)
                runs = runs_of([list(map(numbers.__getitem__, w)) for w in words], min_length, min_periods)
                shown = [[{"start": s, "length": n, "period": q} for s, n, q in r] for r in runs]
                collapsed = [_collapsed(w, r).decode("utf-8") for w, r in zip(words, runs)]
                columns = [part.column(f.name) for f in kept]
                columns += [pa.array([len(w) for w in words], pa.int64()), pa.array(shown, _RUN_ARROW), pa.array(collapsed, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in kept] + added)

    schema = StructType(list(kept)).add("n_words", LongType()).add("runs", ArrayType(_RUN)).add("collapsed", StringType())
    return map_batches(docs.select(*[f"`{f.name}`" for f in kept]), find, schema)


def longest(runs: str) -> Column:
    """The run with the greatest length, then the smallest start, then the smallest period; null without runs."""
    ranked = F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("q")))
    return F.array_max(ranked)


def digests(found: DataFrame) -> DataFrame:
    """Per row of `find_runs`: doc_id, n_runs, the longest run and digests of the runs and the collapsed text."""
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    best = longest("runs")
    start, length, period = -best["s"], best["length"], -best["q"]
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(length * 1000 / period).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def repeated_tails(docs: DataFrame) -> DataFrame:
    """`docs` (doc_id, text) in which about every tenth text repeats itself from some word on.

    With h the crc32 of the decimal doc_id, g = h div 10 and n words: where h % 10 = 0 and n > 0,
    each word i >= a becomes word a + (i - a) % p, a = g % n, p = 1 + (n - a) div (3 + g % 8), and
    the words are joined by one space. A null doc_id has no h, so its text stays.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    split = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    named = docs.select("doc_id", "text", h.alias("h")).select("*", F.when(F.col("h") % 10 == 0, split).alias("words"))
    placed = named.select("doc_id", "text", "words", F.expr("h div 10").alias("g"), F.size("words").alias("n"))
    placed = placed.select("*", F.expr("if(n > 0, int(g % n), 0)").alias("a"))
    placed = placed.select("*", F.expr("int(1 + (n - a) div (3 + g % 8))").alias("p"))
    tail = F.expr("flatten(array_repeat(slice(words, a + 1, p), int((n - a + p - 1) div p)))")
    told = F.array_join(F.slice(F.concat(F.expr("slice(words, 1, a)"), tail), F.lit(1), F.col("n")), " ")
    return placed.select("doc_id", F.when(F.col("n") > 0, told).otherwise(F.col("text")).alias("text"))
