import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import quality


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = quality.score(docs, quality.held_in(labels))
    assert scored.count() == docs.count()
    rows = scored.join(labels, "doc_id").where(quality.remainder("doc_id", 4) == 2).collect()
    assert sum(r["predicted"] == r["quality"] for r in rows) / len(rows) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in scored.collect())


def test_held_out_labels_and_partitioning_change_nothing(documents, labels):
    base = sorted(quality.score(documents, quality.held_in(labels)).collect())
    wrong = labels.withColumn("quality", F.when(quality.remainder("doc_id", 4) == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert sorted(quality.score(documents.repartition(5), quality.held_in(wrong)).collect()) == base


def test_word_vectors_sum_the_neighbours_of_all_texts(spark):
    docs = spark.createDataFrame([("alpha beta",), ("beta gamma",), (None,), ("alpha",)], "text string")
    vectors = quality.word_vectors(docs)
    where, sign = quality._index_vectors()

    def token(word):
        import pyarrow as pa

        return int(quality._tokens(*quality.bytes_of(pa.array([word])))[0][0])

    want = np.zeros(quality.WIDTH)
    for near in ("alpha", "gamma"):
        np.add.at(want, where[token(near)], sign[token(near)])
    assert np.allclose(vectors[token("beta")], want / np.linalg.norm(want), atol=1e-6)


def test_odd_rows_empty_tables_and_clashing_names(spark, odd, nothing, clashing):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, None, 0), (None, 0, 0), (6, 0, 1), (8, 1, 0)], "doc_id long, quality int, toxic int")
    scored = quality.score(odd, labels).collect()
    assert len(scored) == 13 and all(0 <= r["score"] <= 1 for r in scored)
    assert {r["score"] for r in quality.score(odd, labels.limit(0)).collect()} == {0.5}
    assert {r["score"] for r in quality.score(odd, labels.where("quality = 1")).collect()} == {1.0}
    assert quality.score(nothing, labels).collect() == []
    kept = quality.drop_low_quality(clashing, labels.where("quality = 1"))
    assert kept.columns == clashing.columns and kept.count() == 13


def test_network_is_calibrated():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(6000, quality.FEATURES))
    chance = 1 / (1 + np.exp(-(2 * x[:, 0] - x[:, 1])))
    y = (rng.random(6000) < chance).astype(float)
    network = quality.Network(x[:4000], y[:4000], np.arange(4000) % 5 == 0)
    scores = network.scores(x[4000:])
    for low in (0.0, 0.25, 0.5, 0.75):
        part = (scores >= low) & (scores < low + 0.25)
        assert abs(scores[part].mean() - y[4000:][part].mean()) < 0.1


TEXTS = ["alpha, beta gamma!! 12 beta", "", None, "  x\tx x ", "Éa b... c1-d2 (beta) alpha", "one"]


def plain_tokens(text):
    """Runs of characters that are not white space, cut between letters or digits and other ASCII characters."""
    import re

    return re.findall(r"[A-Za-z0-9\x80-\U0010ffff]+|[^\sA-Za-z0-9\x80-\U0010ffff]+", text or "", re.A)


def bucket_of(token):
    import pyarrow as pa

    found, _ = quality._tokens(*quality.bytes_of(pa.array([token])))
    assert len(found) == 1
    return int(found[0])


def test_features_match_plain_pooling(spark):
    """Word vectors summed neighbour by neighbour and texts pooled token by token."""
    import pyarrow as pa

    where, sign = quality._index_vectors()
    sums = np.zeros((quality.BUCKETS, quality.WIDTH))
    for text in TEXTS:
        told = [bucket_of(t) for t in plain_tokens(text)]
        for a, b in zip(told, told[1:]):
            np.add.at(sums[a], where[b], sign[b])
            np.add.at(sums[b], where[a], sign[a])
    unit = sums / np.maximum(1e-9, np.linalg.norm(sums, axis=1, keepdims=True))
    vectors = quality.word_vectors(spark.createDataFrame([(t,) for t in TEXTS], "text string"))
    assert np.allclose(vectors, unit, atol=1e-6)
    pools = quality._pooled(*quality._tokens(*quality.bytes_of(pa.array(TEXTS))), vectors)
    for text, pool in zip(TEXTS, pools):
        told = np.array([unit[bucket_of(t)] for t in plain_tokens(text)])
        if not len(told):
            assert not pool.any()
            continue
        change = np.abs(np.diff(told, axis=0)).sum(axis=0) / len(told)
        assert np.allclose(pool, np.concatenate([told.mean(axis=0), told.std(axis=0), change]), atol=1e-5)


def made(spark, n):
    """Documents of two kinds of words, every one labelled."""
    rng = np.random.default_rng(8)
    words = [[f"{kind}{i}" for i in range(60)] for kind in ("good", "bad", "both")]
    rows = []
    for i in range(n):
        own = words[i % 2]
        rows.append((i, " ".join(rng.choice(own) if rng.random() < 0.4 else rng.choice(words[2]) for _ in range(12)), 1 - i % 2))
    return spark.createDataFrame(rows, "doc_id long, text string, quality int")


def test_one_rule_for_any_number_of_labels(spark, monkeypatch):
    """Also with more than ten thousand labels, and texts as ids."""
    rows = made(spark, 14_000).cache()
    labels = rows.select("doc_id", "quality")
    for n in (600, 14_000):
        seen = []
        monkeypatch.setattr(quality, "STEPS", 1_200)
        real = quality.Network._train
        monkeypatch.setattr(quality.Network, "_train", lambda self, x, y, real=real: seen.append(len(y)) or real(self, x, y))
        docs = rows.where(F.col("doc_id") < n).drop("quality")
        got = quality.score(docs, quality.held_in(labels)).join(labels, "doc_id").where(quality.remainder("doc_id", 4) == 2).collect()
        assert sum(r["predicted"] == r["quality"] for r in got) / len(got) > 0.9
        assert 0.4 * n < seen[0] < 0.8 * n
        monkeypatch.undo()
    texts = rows.where("doc_id < 300").withColumn("doc_id", F.concat(F.lit("id"), "doc_id"))
    assert quality.score(texts.drop("quality"), texts.select("doc_id", "quality")).count() == 300
    rows.unpersist()


def test_labels_without_a_document_take_no_place(spark):
    rows = made(spark, 200)
    labels = rows.select("doc_id", "quality").union(spark.range(10_000, 14_000).selectExpr("id", "int(id % 2)"))
    vectors = spark.sparkContext.broadcast(quality.word_vectors(rows))
    learnt = []
    real = quality.Network.__init__
    try:
        quality.Network.__init__ = lambda self, x, y, calibrate: learnt.append(len(y)) or real(self, x, y, calibrate)
        quality.train(rows.drop("quality"), labels, vectors, most=100)
    finally:
        quality.Network.__init__ = real
    assert learnt == [100]
