"""Document quality from random-indexing word vectors and a small calibrated network.

Tokens are runs of word bytes or of punctuation, hashed into `BUCKETS` buckets. Every bucket
has a fixed sparse ternary index vector; a bucket's word vector is the sum of the index vectors
of the tokens next to it over all documents. The sums are integers, made in the tasks and added
up by Spark, so they cover the whole corpus, do not depend on the partitioning, and the table
has the same size (`BUCKETS` x `WIDTH`) for any corpus.

A text is pooled from its tokens' unit vectors: their mean, their standard deviation and the
mean change from one token to the next. A two-layer network learns `quality` from a sample of
at most `TRAIN_ROWS` labelled rows that have a document, the smallest by hash of the id, in
`STEPS` steps whatever their number; a fifth of them is left out to fit the temperature that
calibrates the probabilities.

Defined cases: null text counts as empty, and an empty text is scored from empty pools; labels
without a quality or a document are not learnt from, repeated labels count once with the larger
value; without both labels in the sample every score is the share of label 1 (0.5 without
labels); null ids count as the empty string for the split; repeated rows are scored each;
empty tables give no rows; other columns are returned as they are by `drop_low_quality`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrow_text import NOT_SPACE, bytes_of, constants, mix, row_groups, words
from tidemark.llm.language import remainder
from tidemark.llm.tasks import map_batches
from tidemark.session import materialize

BUCKETS = 1 << 14
WIDTH = 24
NONZEROS = 4
HIDDEN = 32
#: Steps of training, each over `BATCH` rows or all there are.
STEPS = 2_000
BATCH = 128
TRAIN_ROWS = 20_000
#: Scores from here on predict label 1.
ACCEPT = 0.7

_KIND = np.zeros(256, np.uint8)
_KIND[[b for b in range(128) if not chr(b).isalnum()]] = 1


def _index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Positions and signs of each bucket's nonzeros."""
    h = mix(np.arange(BUCKETS * NONZEROS, dtype=np.uint64) ^ constants(1, 1717)[0]).reshape(BUCKETS, NONZEROS)
    return (h % np.uint64(WIDTH)).astype(np.int64), np.where(h >> np.uint64(63), 1.0, -1.0)


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hashes, _, _, at = words(data, offsets, NOT_SPACE, _KIND, fold=False)
    return (hashes % np.uint64(BUCKETS)).astype(np.int64), at


def _groups(batch: pa.RecordBatch, text: str = "text") -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, offsets = bytes_of(batch.column(text))
    for lo, hi in row_groups(offsets):
        yield lo, hi, *_tokens(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])


def _context_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per used bucket: the sum of its neighbours' index vectors in this task."""
    where, sign = _index_vectors()
    sums = np.zeros(BUCKETS * WIDTH)
    for batch in batches:
        for _, _, tokens, at in _groups(batch):
            if len(tokens) < 2:
                continue
            together = np.ones(len(tokens) - 1, bool)
            cuts = at[1:-1]
            together[cuts[(cuts > 0) & (cuts < len(tokens))] - 1] = False
            left, right = tokens[:-1][together], tokens[1:][together]
            for word, near in ((left, right), (right, left)):
                for k in range(NONZEROS):
                    sums += np.bincount(word * WIDTH + where[near, k], sign[near, k], BUCKETS * WIDTH)
    table = sums.reshape(BUCKETS, WIDTH).astype(np.int64)
    used = np.flatnonzero(table.any(axis=1))
    columns = [pa.array(used)] + [pa.array(table[used, k]) for k in range(WIDTH)]
    yield pa.RecordBatch.from_arrays(columns, ["bucket"] + [f"v{k}" for k in range(WIDTH)])


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Unit word vectors of all buckets, from the neighbours of every token of `docs`."""
    names = [f"v{k}" for k in range(WIDTH)]
    parts = map_batches(docs.select("text"), _context_batches, "bucket long, " + ", ".join(f"{n} long" for n in names))
    # one row per bucket, whatever the corpus
    rows = parts.groupBy("bucket").agg(*[F.sum(n).alias(n) for n in names]).toPandas()
    table = np.zeros((BUCKETS, WIDTH))
    table[rows["bucket"].to_numpy(np.int64)] = rows[names].to_numpy(np.float64)
    table /= np.maximum(1e-9, np.linalg.norm(table, axis=1, keepdims=True))
    return table.astype(np.float32)


FEATURES = 3 * WIDTH


def _pooled(tokens: np.ndarray, at: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    n = len(at) - 1
    pools = np.zeros((n, FEATURES), np.float32)
    used = np.flatnonzero(np.diff(at))
    if len(used) == 0:
        return pools
    v = vectors[tokens]
    starts, counts = at[used], np.diff(at)[used][:, None]
    mean = np.add.reduceat(v, starts, axis=0) / counts
    square = np.add.reduceat(v * v, starts, axis=0) / counts
    change = np.zeros_like(v)
    change[1:] = np.abs(v[1:] - v[:-1])
    change[starts] = 0
    pools[used] = np.hstack([mean, np.sqrt(np.maximum(0, square - mean * mean)), np.add.reduceat(change, starts, axis=0) / counts])
    return pools


class Network:
    """Two layers and a temperature over standardised pools."""

    def __init__(self, x: np.ndarray, y: np.ndarray, calibrate: np.ndarray):
        self.constant = None
        if len(y) == 0 or y.min() == y.max():
            self.constant = float(y.mean()) if len(y) else 0.5
            return
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        fit = ~calibrate if (~calibrate).sum() > 1 else np.ones(len(y), bool)
        self._train((x[fit] - self.mean) / self.scale, y[fit])
        self.temperature = 1.0
        if calibrate.any():
            z = self._logits((x[calibrate] - self.mean) / self.scale)
            grid = np.geomspace(0.25, 8, 61)
            loss = [np.mean(np.logaddexp(0, z / t) - y[calibrate] * z / t) for t in grid]
            self.temperature = float(grid[int(np.argmin(loss))])

    def _train(self, x: np.ndarray, y: np.ndarray, rate: float = 2e-3, decay: float = 1e-4) -> None:
        rng = np.random.default_rng(11)
        weights = [rng.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, np.sqrt(1 / HIDDEN), HIDDEN), np.zeros(1)]
        first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
        waiting = np.zeros(0, np.int64)
        for step in range(1, STEPS + 1):
            if len(waiting) == 0:
                waiting = rng.permutation(len(y))
            rows, waiting = waiting[:BATCH], waiting[BATCH:]
            hidden = x[rows] @ weights[0] + weights[1]
            active = np.maximum(0, hidden)
            error = (1 / (1 + np.exp(-(active @ weights[2] + weights[3]))) - y[rows]) / len(rows)
            back = np.outer(error, weights[2]) * (hidden > 0)
            slopes = [x[rows].T @ back, back.sum(axis=0), active.T @ error, np.array([error.sum()])]
            for i, slope in enumerate(slopes):
                first[i] = 0.9 * first[i] + 0.1 * slope
                second[i] = 0.999 * second[i] + 0.001 * slope**2
                move = first[i] / (1 - 0.9**step) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
                weights[i] = weights[i] - rate * (move + decay * weights[i])
        self.weights = weights

    def _logits(self, x: np.ndarray) -> np.ndarray:
        w = self.weights
        return np.maximum(0, x @ w[0] + w[1]) @ w[2] + w[3]

    def scores(self, pools: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(pools), self.constant)
        z = self._logits((pools - self.mean) / self.scale) / self.temperature
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def train(docs: DataFrame, labels: DataFrame, vectors, most: int = TRAIN_ROWS) -> Network:
    """A network from the sample of `labels` (doc_id, quality) and the texts of `docs`; ids may be of any type."""
    docs = docs.select("doc_id", "text")
    one = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    # labels without a document take no place in the sample
    sample = one.join(docs.select("doc_id"), "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = docs.join(F.broadcast(materialize(sample, "labelled")), "doc_id").select("doc_id", "quality", "text")

    def pool_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, tokens, at in _groups(batch):
                pools = [x.tobytes() for x in _pooled(tokens, at, vectors.value)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), batch.column("quality").slice(lo, hi - lo).cast(pa.int32()), pa.array(pools, pa.binary())],
                    ["doc_id", "quality", "pools"],
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    pooled = map_batches(rows, pool_batches, f"doc_id {kind}, quality int, pools binary")
    # at most `most` rows of 288 bytes
    one_text = pooled.groupBy("doc_id").agg(F.max("quality").alias("quality"), F.min("pools").alias("pools"))
    known = one_text.select(F.xxhash64("doc_id").alias("h"), "quality", "pools").toPandas()
    known = known.sort_values(["h", "pools"])
    x = np.array([np.frombuffer(p, np.float32) for p in known["pools"]], np.float64).reshape(-1, FEATURES)
    y = (known["quality"].to_numpy(np.int64) > 0).astype(np.float64)
    calibrate = mix(known["h"].to_numpy(np.int64).view(np.uint64)) % np.uint64(5) == 0
    return Network(x, y, calibrate)


def _scored(docs: DataFrame, labels: DataFrame, carry: list[str]) -> DataFrame:
    """Columns `carry` of `docs` as _c0, _c1, ... and _score."""
    context = docs.sparkSession.sparkContext
    vectors = context.broadcast(word_vectors(docs))
    network = context.broadcast(train(docs, labels, vectors))
    names = [f"_c{i}" for i in range(len(carry))]
    text = f"_c{carry.index('text')}" if "text" in carry else "_text"
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(carry, names)], *([] if "text" in carry else [F.col("text").alias("_text")]))

    def score_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [network.value.scores(_pooled(tokens, at, vectors.value)) for _, _, tokens, at in _groups(batch, text)]
            scores = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [pa.array(scores)], names + ["_score"])

    return map_batches(rows, score_batches, rows.select(*names).schema.add("_score", "double"))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, score and predicted of every row of `docs` (doc_id, text), learnt from `labels`."""
    return _scored(docs, labels, ["doc_id"]).select(
        F.col("_c0").alias("doc_id"), F.col("_score").alias("score"), (F.col("_score") >= ACCEPT).cast("int").alias("predicted")
    )


def held_in(labels: DataFrame, folds: int = 4, held_out: int = 2) -> DataFrame:
    """Labels outside the held-out fold."""
    return labels.where(remainder("doc_id", folds) != held_out)


def drop_low_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs` predicted to be of label 1, with all their columns."""
    kept = _scored(docs, held_in(labels), docs.columns).where(F.col("_score") >= ACCEPT)
    return kept.drop("_score").toDF(*docs.columns)
