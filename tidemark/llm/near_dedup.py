"""Near duplicates by Fast Similarity Sketching, banding and verification on full sets.

A text's set holds its distinct five-word shingles (A-Z lower-cased, words are runs of
anything but ASCII white space); a shorter text is one shingle, a text without words has an
empty set and is linked with nothing. Texts are linked when
``100 * |intersection| >= 75 * |union|`` of their full sets.

Texts with equal sets form one class and only a class takes part in the search, so a text
copied many times costs one sketch. The sketch fills `COORDINATES` bins in rounds: round i
throws every shingle into one bin with a value above those of all earlier rounds, and from
round `COORDINATES` on every shingle goes to bin i - COORDINATES, so each bin fills. Classes
that agree on all `ROWS` coordinates of a band share a bucket. At similarity 0.75 a pair
misses all bands with probability (1 - 0.75**8)**100 = 3e-5; two texts that share a
third of their shingles meet with probability 0.015, so a common passage makes few candidates.

Inside a bucket one class is the centre and every other class is compared with it. Buckets
that then still hold several components take further centres from outside the largest one,
sixteen times as many each turn, until every pair of a bucket is in one component, was compared
itself, or is told apart by bits of its sketches (1 in 300,000 pairs at 0.75 is lost there); a
group of similar texts costs about one comparison per member and is never expanded into pairs.

Rows are numbered once, and the number tells them apart: the first row of a class by doc_id
(null last), then number, stands for the class, and the first of a component stays.

Defined cases: a null text counts as empty; empty texts are kept and stand alone; a null
doc_id is ignored for the smallest id of a component (null if it has no other); rows without
doc_id are different documents; rows that share a doc_id and a set are one document, so all
are marked kept if one stays, and `drop_near_duplicates` leaves one of them; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrow_text import bytes_of, constants, mix, row_groups, shingle_sets, words
from tidemark.llm.components import components, extended
from tidemark.llm.tasks import map_batches
from tidemark.session import drop_aside, materialize, materialize_last, write_aside, written_aside

SHINGLE_WORDS = 5
BANDS, ROWS = 100, 8
COORDINATES = BANDS * ROWS
#: Per cent of the union that linked sets share.
LINK_PERCENT = 75
#: Candidate classes whose ids (8 bytes each) are sent to every executor at most; more are
#: joined by shuffling the texts.
BROADCAST_CLASSES = 500_000

#: The lowest `PLANES` bits of the first coordinates, packed in longs: enough to tell pairs
#: that are far from similar without their sets.
PLANES, PLANE_LONGS = 4, 12
#: Coordinates whose bits agree at similarity 0.75, less 4.5 standard deviations (3e-6).
_AGREE = 0.75 + 0.25 / 2**PLANES
MIN_AGREEING = int(64 * PLANE_LONGS * _AGREE - 4.5 * (64 * PLANE_LONGS * _AGREE * (1 - _AGREE)) ** 0.5)
#: Texts sketched together.
GROUP_BYTES = 4 << 20

_VALUE_BITS = 48


def sketches(sets: np.ndarray, bounds: np.ndarray, size: int = COORDINATES) -> np.ndarray:
    """One row of `size` coordinates for each non-empty set; all sets take each round together."""
    counts = np.diff(bounds)
    filled = np.full((len(counts), size), np.iinfo(np.uint64).max, np.uint64)
    flat = filled.reshape(-1)
    owner = np.repeat(np.arange(len(counts)), counts)
    items = sets
    salts = constants(2 * size, 31)
    for turn in range(2 * size):
        if len(items) == 0:
            break
        h = mix(items ^ salts[turn])
        if turn < size:
            bins = ((h >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)
        else:
            bins = np.full(len(items), turn - size)
        value = np.uint64(turn << _VALUE_BITS) | (h & np.uint64((1 << _VALUE_BITS) - 1))
        np.minimum.at(flat, owner * size + bins, value)
        if turn % (2 if len(items) > 10_000 else 16) == 1:
            open_sets = (filled == np.iinfo(np.uint64).max).any(axis=1)
            left = open_sets[owner]
            items, owner = items[left], owner[left]
    return filled


def band_keys(rows: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """A 64-bit bucket for each band of each sketch; bands never share a bucket on purpose."""
    n, size = rows.shape
    parts = rows.reshape(n, bands, size // bands)
    keys = np.broadcast_to(constants(bands, 4242), (n, bands)).copy()
    for k in range(size // bands):
        keys = mix(keys ^ parts[:, :, k]) + np.uint64(k)
    return keys


def bit_planes(rows: np.ndarray) -> np.ndarray:
    """`PLANES` times `PLANE_LONGS` longs for each sketch: one bit of each coordinate per plane."""
    first = rows[:, : 64 * PLANE_LONGS]
    packed = [np.packbits((first >> np.uint64(k) & np.uint64(1)).astype(bool), axis=1) for k in range(PLANES)]
    return np.ascontiguousarray(np.hstack(packed)).view(np.int64)


def _fingerprints(sets: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit sums over each set."""
    result = []
    for salt in (0x1234567, 0x89ABCDE):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(sets ^ np.uint64(salt)), dtype=np.uint64)])
        result.append(sums[bounds[1:]] - sums[bounds[:-1]])
    return result[0].view(np.int64), result[1].view(np.int64)


def _lists(rows: np.ndarray, used: np.ndarray, n: int) -> pa.ListArray:
    """One list per text: a row of `rows` for each used text in turn, empty lists for others."""
    sizes = np.zeros(n + 1, np.int32)
    sizes[1:][used] = rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), pa.array(rows.reshape(-1)))


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = bytes_of(batch.column("text"))
        for lo, hi in row_groups(offsets, GROUP_BYTES):
            hashes, _, _, bounds = words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
            sets, at = shingle_sets(hashes, bounds, SHINGLE_WORDS)
            fp1, fp2 = _fingerprints(sets, at)
            sizes = np.diff(at)
            used = np.flatnonzero(sizes)
            rows = sketches(sets, np.concatenate([[0], at[1:][sizes > 0]]))
            buckets, planes = _lists(band_keys(rows).view(np.int64), used, hi - lo), _lists(bit_planes(rows), used, hi - lo)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row").slice(lo, hi - lo), batch.column("doc_id").slice(lo, hi - lo), pa.array(fp1), pa.array(fp2), pa.array(sizes.astype(np.int64)), buckets, planes],
                ["_row", "doc_id", "fp1", "fp2", "n_shingles", "buckets", "planes"],
            )


def _set_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(class_id, its set as bytes)."""
    for batch in batches:
        data, offsets = bytes_of(batch.column("text"))
        for lo, hi in row_groups(offsets):
            hashes, _, _, bounds = words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
            sets, at = shingle_sets(hashes, bounds, SHINGLE_WORDS)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("class_id").slice(lo, hi - lo),
                    pa.array([sets[at[i] : at[i + 1]].tobytes() for i in range(hi - lo)], pa.binary()),
                ],
                ["class_id", "shingles"],
            )


def _linked_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for a, b in zip(batch.column("a_set"), batch.column("b_set")):
            x, y = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
            if 100 * min(len(x), len(y)) < LINK_PERCENT * max(len(x), len(y)):
                keep.append(False)
                continue
            at = np.searchsorted(y, x)
            both = int(np.count_nonzero(y[np.minimum(at, len(y) - 1)] == x))
            keep.append(100 * both >= LINK_PERCENT * (len(x) + len(y) - both))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _verified(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes, read from files, whose full sets are similar enough; written aside."""
    spark = pairs.sparkSession
    wanted_path = write_aside(pairs.select(F.col("a").alias("class_id")).union(pairs.select("b")).distinct(), "wanted")
    wanted = spark.read.parquet(wanted_path)
    if wanted.count() <= BROADCAST_CLASSES:
        wanted = F.broadcast(wanted)
    texts = rows.join(wanted, rows["_row"] == wanted["class_id"]).select("class_id", "text")
    sets_path = write_aside(map_batches(texts, _set_batches, "class_id long, shingles binary"), "sets")
    sets = spark.read.parquet(sets_path)
    compared = (
        pairs.join(sets.select(F.col("class_id").alias("b"), F.col("shingles").alias("b_set")), "b")
        .join(sets.select(F.col("class_id").alias("a"), F.col("shingles").alias("a_set")), "a")
        .select("a", "b", "a_set", "b_set")
    )
    links = materialize(map_batches(compared, _linked_batches, "a long, b long"), "verified")
    for path in (wanted_path, sets_path):
        drop_aside(spark, path)
    return links


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """`rows` with the component of each class."""
    known = labels.select(F.col("vertex").alias("class_id"), "label")
    return rows.join(known, "class_id", "left").withColumn("label", F.coalesce("label", "class_id"))


def _star_pairs(rest: DataFrame, labels: DataFrame | None, turn: int, profiles: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """The members of each bucket without this turn's centres, and the pairs to verify.

    The first centre of a bucket is its weightiest member. Later ones come from outside the
    bucket's largest component, up to 16**turn of them, the weightiest of each hashed part,
    and are paired with members whose sketches leave a link possible, in the first only of the
    buckets that both share. All pairs are of different components and of set sizes that allow
    a link.
    """
    if turn == 0:
        rest, able = rest.withColumn("label", F.col("class_id")), rest.withColumn("label", F.col("class_id"))
    else:
        rest = materialize(_labelled(rest, labels).join(profiles, "class_id"), "turn")
        sizes = rest.groupBy("bucket", "label").agg(F.count("*").alias("size"))
        largest = sizes.groupBy("bucket").agg(F.max(F.struct("size", "label")).alias("top"))
        able = rest.join(largest.select("bucket", F.col("top.label").alias("top")), "bucket").where("label != top")
    part = F.pmod(F.xxhash64("class_id", F.lit(turn)), F.lit(16 ** min(turn, 7)))
    carried = ["weight", "class_id", "n_shingles", "label"] + (["planes", "mixed"] if turn else [])
    centres = able.groupBy("bucket", part.alias("part")).agg(F.max(F.struct(*carried)).alias("c"))
    centres = materialize(centres.select("bucket", *[F.col(f"c.{name}").alias(f"c_{name}") for name in carried[1:]]), "centres")
    small, large = F.least("n_shingles", "c_n_shingles"), F.greatest("n_shingles", "c_n_shingles")
    possible = (F.col("label") != F.col("c_label")) & (100 * small >= LINK_PERCENT * large)
    if turn:
        possible &= _agreeing("planes", "c_planes") >= MIN_AGREEING
        possible &= F.array_min(F.array_intersect("mixed", "c_mixed")) == rest["bucket"]
    pairs = (
        rest.join(centres, [rest["bucket"] == centres["bucket"], possible])
        .select(F.least("class_id", "c_class_id").alias("a"), F.greatest("class_id", "c_class_id").alias("b"))
        .distinct()
    )
    used = centres.select("bucket", F.col("c_class_id").alias("class_id"))
    return rest.drop("label", "planes", "mixed").join(used, ["bucket", "class_id"], "left_anti"), pairs


def _agreeing(a: str, b: str) -> Column:
    """Coordinates with equal bits in all planes."""
    differ = F.lit(0)
    for i in range(PLANE_LONGS):
        bits = [F.get(a, F.lit(i + k * PLANE_LONGS)).bitwiseXOR(F.get(b, F.lit(i + k * PLANE_LONGS))) for k in range(PLANES)]
        differ += F.bit_count(reduce(Column.bitwiseOR, bits))
    return F.lit(64 * PLANE_LONGS) - differ


def _still_apart(rest: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of buckets that still hold several components."""
    with written_aside(_labelled(rest, labels), "rest") as rest:
        mixed = rest.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
        return materialize(rest.drop("label").join(mixed.select("bucket"), "bucket", "left_semi"), "apart")


def _numbered(docs: DataFrame) -> DataFrame:
    """`docs` with a fixed number _row for each row, written aside."""
    return materialize(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")


def _judged(rows: DataFrame) -> DataFrame:
    """_row, doc_id, n_shingles, component_id, kept and stays of rows (_row, doc_id, text), read from files.

    Exactly one row of a component stays.
    """
    spark = rows.sparkSession
    kind = rows.schema["doc_id"].dataType.simpleString()
    numbers = "fp1 long, fp2 long, n_shingles long"
    sketched = map_batches(rows, _sketch_batches, f"_row long, doc_id {kind}, {numbers}, buckets array<long>, planes array<long>")
    with written_aside(sketched, "sketches") as sketched:
        classes = (
            sketched.where("n_shingles > 0")
            .groupBy("fp1", "fp2", "n_shingles")
            .agg(
                F.min(F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", "_row")).alias("first_row"),
                F.first("buckets").alias("buckets"),
                F.first("planes").alias("planes"),
            )
            .withColumn("class_id", F.col("first_row._row"))
        )
        classes = materialize(classes, "classes")
        drawn = materialize(sketched.drop("buckets", "planes"), "drawn")

    placed = classes.select("class_id", F.explode("buckets").alias("bucket"))
    several = placed.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")
    with written_aside(placed.join(several, "bucket"), "buckets") as met:
        # how often a class meets others: the text that copies derive from meets most of them
        weights = met.groupBy("class_id").agg(F.sum("members").alias("weight")).join(classes.select("class_id", "n_shingles"), "class_id")
        rest = materialize(met.drop("members").join(weights, "class_id"), "members")

    labels, tested, profiles, turn = None, None, None, 0
    while not rest.isEmpty():
        if turn == 1:
            # sketch bits of the classes left, and their buckets that hold several components
            mixed = rest.groupBy("class_id").agg(F.collect_set("bucket").alias("mixed"))
            profiles = materialize(mixed.join(classes.select("class_id", "planes"), "class_id"), "profiles")
        rest, pairs = _star_pairs(rest, labels, turn, profiles)
        if tested is not None:
            # a pair may meet in several buckets
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = materialize(pairs, "pairs")
        tested = pairs if tested is None else tested.union(pairs)
        links = _verified(pairs, rows)
        if labels is None:
            labels = components(links, "a", "b")
        elif not links.isEmpty():
            labels = extended(labels, links, "a", "b")
        rest = _still_apart(rest, labels)
        turn += 1
    if labels is None:
        labels = spark.createDataFrame([], "vertex long, label long")

    reached = classes.join(labels.withColumnRenamed("vertex", "class_id"), "class_id", "left").select(
        "fp1", "fp2", "n_shingles", "class_id", "first_row", F.coalesce("label", "class_id").alias("label")
    )
    first = reached.groupBy("label").agg(F.min("first_row").alias("top"))
    named = reached.join(first, "label").select("fp1", "fp2", "n_shingles", "class_id", "top")
    alone = F.col("n_shingles") == 0
    stays = alone | (F.col("_row") == F.col("top._row"))
    same_document = (F.col("class_id") == F.col("top._row")) & (F.col("doc_id") == F.col("top.doc_id"))
    return drawn.join(named, ["fp1", "fp2", "n_shingles"], "left").select(
        "_row",
        "doc_id",
        "n_shingles",
        F.when(alone, F.col("doc_id")).otherwise(F.col("top.doc_id")).alias("component_id"),
        (stays | F.coalesce(same_document, F.lit(False))).alias("kept"),
        stays.alias("stays"),
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, n_shingles, component_id, kept."""
    return _judged(_numbered(docs.select("doc_id", "text"))).select("doc_id", "n_shingles", "component_id", "kept")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that stay, with all their columns: one row of each group."""
    names = [f"_c{i}" for i in range(len(docs.columns))]
    named = _numbered(docs.toDF(*names))
    ids = [F.col(names[docs.columns.index(c)]).alias(c) for c in ("doc_id", "text")]
    gone = materialize_last(lambda: _judged(named.select("_row", *ids)).where("NOT stays").select("_row"), "near_dropped")
    return named.join(gone, "_row", "left_anti").select(*names).toDF(*docs.columns)
