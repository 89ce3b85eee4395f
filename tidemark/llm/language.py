"""Language identification with a bit-sliced Bloom filter of n-grams.

N-grams are four bytes of the text after lower-casing A-Z and turning every run of other ASCII
non-letters into one separator. Counts of all n-grams of all training rows are summed in
Spark; a language keeps the n-grams that make up at least `MIN_SHARE` of its own, so no
language has more than 1 / MIN_SHARE of them and the filter's size has a bound.

The filter holds, for each position, a bitmask of languages. An n-gram's `HASHES` positions
are ANDed, which returns all languages that contain it at once. The per-language popcounts of
a text are corrected for the false positives that the language's share of set bits lets
expect, set against the share of its own n-grams that a language keeps, and the largest wins.

Defined cases: a null text or one without a letter is ``und`` with score 0; a text without
known n-grams gets the most frequent training language with its share as score, ``und`` and
0 if nothing could be learnt; ties go to the alphabetically first language; a null doc_id
counts as the empty string for the split; rows without a language are never learnt from;
repeated rows each count; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrow_text import bytes_of, constants, mix, row_groups
from tidemark.llm.tasks import map_batches
from tidemark.session import materialize

GRAM = 4
MIN_SHARE = 2e-5
HASHES = 3
#: Positions for each kept n-gram, so that few bits are set by chance.
SPARE = 16

_LETTER = np.zeros(256, np.uint32)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[65:91] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)


def _grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of all texts and n + 1 offsets; each text is set between separators."""
    n = len(offsets) - 1
    codes = np.zeros(len(data) + n + 1, np.uint32)
    shift = np.repeat(np.arange(1, n + 1), np.diff(offsets))
    codes[np.arange(len(data)) + shift] = _LETTER[data]
    opens = offsets + np.arange(n + 1)  # the separator before each text
    keep = codes != 0
    run = np.cumsum(keep)  # separators of one run share a number
    beside = np.zeros(len(data) + 1, bool)
    beside[run[opens]] = True  # runs that touch the end of a text shrink to the separator there
    keep[1:] |= keep[:-1] & ~beside[run[1:]]
    keep[opens] = True
    at = np.concatenate([[0], np.cumsum(keep)])[opens]
    codes = codes[keep]
    size = max(0, len(codes) - GRAM + 1)
    grams = np.zeros(size, np.uint32)
    for k in range(GRAM):
        grams = (grams << np.uint32(8)) | codes[k : k + size]
    # an n-gram belongs to the text it starts in and must end by the separator after it
    counts = np.maximum(0, at[1:] - at[:-1] + 1 - GRAM + 1)
    step = np.zeros(size + 1, np.int8)
    used = counts > 0
    np.add.at(step, at[:-1][used], 1)
    np.add.at(step, (at[:-1] + counts)[used], -1)
    inside = np.cumsum(step[:size]).astype(bool)
    return grams[inside], np.concatenate([[0], np.cumsum(counts)])


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = bytes_of(batch.column("text"))
        langs = np.array(batch.column("lang").to_pylist(), dtype=object)
        for lang in sorted(set(langs)):
            found = []
            rows = np.flatnonzero(langs == lang)
            for lo, hi in row_groups(offsets):
                own = rows[(rows >= lo) & (rows < hi)]
                if len(own):
                    grams, at = _grams(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                    found.append(_some(grams, at, own - lo))
            values, counts = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.uint32), np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(values), pa.string()), pa.array(values.astype(np.int64)), pa.array(counts.astype(np.int64))],
                ["lang", "gram", "n"],
            )


def _some(grams: np.ndarray, at: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return np.concatenate([grams[at[i] : at[i + 1]] for i in rows])


class Filter:
    """Bitmasks of languages by position, one 64-bit slice for every 64 languages."""

    def __init__(self, langs: list[str], members: list[np.ndarray], coverage: list[float], shares: list[float]):
        self.langs, self.coverage, self.shares = langs, np.array(coverage), shares
        total = sum(len(m) for m in members)
        self.bits = max(10, int(np.ceil(np.log2(max(1, total * SPARE)))))
        self.masks = np.zeros((-(-len(langs) // 64), 1 << self.bits), np.uint64)
        for number, member in enumerate(members):
            for positions in self._positions(member.astype(np.uint32)):
                self.masks[number // 64, positions] |= np.uint64(1 << (number % 64))
        set_bits = [np.count_nonzero(self.masks[i // 64] & np.uint64(1 << (i % 64))) for i in range(len(langs))]
        self.chance = (np.array(set_bits) / (1 << self.bits)) ** HASHES

    def _positions(self, grams: np.ndarray) -> Iterator[np.ndarray]:
        h = mix(grams.astype(np.uint64) ^ constants(1, 99)[0])
        step = (h >> np.uint64(32)) | np.uint64(1)
        for k in range(HASHES):
            yield (h + step * np.uint64(k)) & np.uint64((1 << self.bits) - 1)

    def rates(self, grams: np.ndarray, at: np.ndarray) -> np.ndarray:
        """For each text and language, the corrected share of its n-grams found, against what the language's own texts show."""
        counts = np.diff(at)
        found = [np.bitwise_and.reduce([slice_[p] for p in self._positions(grams)]) for slice_ in self.masks]
        result = np.zeros((len(counts), len(self.langs)))
        for i in range(len(self.langs)):
            bits = (found[i // 64] >> np.uint64(i % 64)) & np.uint64(1)
            sums = np.concatenate([[0], np.cumsum(bits, dtype=np.int64)])
            hits = sums[at[1:]] - sums[at[:-1]]
            result[:, i] = np.maximum(0, hits - counts * self.chance[i]) / (1 - self.chance[i])
        return result / np.maximum(1, counts)[:, None] / self.coverage[None, :]


def remainder(column: str, of: int) -> Column:
    """crc32 of an id as text, modulo `of`."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(of))


def train(docs: DataFrame) -> Filter | None:
    """A filter from the rows of `docs` (text, lang) that have a language."""
    known = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
    counts = materialize(
        map_batches(known, _count_batches, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams"
    )
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    kept = counts.join(totals, "lang").where(F.col("n") >= F.col("total") * MIN_SHARE)
    sizes = {r["lang"]: r["total"] for r in totals.collect()}
    rows = kept.select("lang", "gram", "n").toPandas()
    if rows.empty:
        return None
    by_lang = {lang: part for lang, part in rows.groupby("lang")}
    langs = sorted(by_lang)
    total = sum(sizes.values())
    return Filter(
        langs,
        [by_lang[x]["gram"].to_numpy() for x in langs],
        [by_lang[x]["n"].sum() / sizes[x] for x in langs],
        [sizes[x] / total for x in langs],
    )


def predict(docs: DataFrame, model: Filter | None) -> DataFrame:
    """doc_id, lang_pred and score of every row of `docs` (doc_id, text)."""
    broadcast = docs.sparkSession.sparkContext.broadcast(model)

    def predict_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = broadcast.value
        for batch in batches:
            letters = batch.column("has_letter").to_numpy(zero_copy_only=False)
            data, offsets = bytes_of(batch.column("text"))
            names, scores = ["und"] * batch.num_rows, np.zeros(batch.num_rows)
            for lo, hi in row_groups(offsets) if model else ():
                rates = model.rates(*_grams(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]))
                best, sums = rates.argmax(axis=1), rates.sum(axis=1)
                for i in np.flatnonzero(letters[lo:hi]):
                    if sums[i] > 0:
                        names[lo + i], scores[lo + i] = model.langs[best[i]], rates[i, best[i]] / sums[i]
                    else:
                        common = int(np.argmax(model.shares))
                        names[lo + i], scores[lo + i] = model.langs[common], model.shares[common]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores)], ["doc_id", "lang_pred", "score"])

    rows = docs.select("doc_id", "text", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("has_letter"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_batches(rows, predict_batches, f"doc_id {kind}, lang_pred string, score double")


def identify(docs: DataFrame, folds: int = 3, held_out: int = 1) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learnt from the rows outside the held-out fold."""
    model = train(docs.where(remainder("doc_id", folds) != held_out))
    return predict(docs, model).select("doc_id", (remainder("doc_id", folds) == held_out).alias("held_out"), "lang_pred", "score")
