import zlib

import pytest

from tests.llm.conftest import ODD_ROWS
from tidemark.llm import sharding


def check(rows, shards, texts):
    sizes = [0] * shards
    slots = {}
    for r in rows:
        sizes[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
        assert r["law"] == "bytes" and r["grown_shard"] is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max((r["size"] for r in rows), default=0)
    assert max(sizes) - min(sizes) <= 2 * largest
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in rows) == sorted(
        (str(i), len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in texts
    )


@pytest.mark.parametrize("range_rows", [7, 40, 100_000])
def test_documents_are_shared_out(documents, range_rows):
    texts = [(r["doc_id"], r["text"]) for r in documents.collect()]
    check(sharding.assign_shards(documents, range_rows=range_rows).collect(), 24, texts)


def test_ranges_do_not_change_the_shards(documents):
    few = sharding.assign_shards(documents, range_rows=9)
    many = sharding.assign_shards(documents)
    assert sorted(few.select("doc_id", "shard", "slot").collect()) == sorted(many.select("doc_id", "shard", "slot").collect())


def test_a_text_in_most_rows_is_cut(spark):
    frame = spark.range(4000).selectExpr("id AS doc_id", "CASE WHEN id % 4 < 3 THEN 'same text' ELSE repeat('x', int(id % 50)) END AS text")
    rows = sharding._ranged(
        frame.selectExpr("doc_id", "length(text) + 8L AS size", "0L AS text_crc32", "xxhash64(text) AS key", "doc_id AS row"), 100
    )
    assert max(r["count"] for r in rows.groupBy("range").count().collect()) <= 100
    texts = [(r["doc_id"], r["text"]) for r in frame.collect()]
    check(sharding.assign_shards(frame, range_rows=100).collect(), 24, texts)


def test_odd_rows_empty_table_and_clashing_names(odd, nothing, clashing):
    texts = [(r[0], r[1]) for r in ODD_ROWS]
    for frame in (odd, clashing):
        rows = sharding.assign_shards(frame, 5).collect()
        assert sorted((str(r["doc_id"]), r["size"]) for r in rows) == sorted((str(i), len((t or "").encode()) + 8) for i, t in texts)
    assert sharding.assign_shards(nothing).collect() == []


def test_no_python_in_the_plan(documents):
    plan = sharding.assign_shards(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_shards_match_one_sorted_line(documents):
    """Every row's shard and slot from a plain sort by hash and row, and running sums."""
    import xxhash

    rows = documents.coalesce(1)
    texts = [(r["doc_id"], r["text"] or "") for r in rows.collect()]
    signed = lambda t: (xxhash.xxh64_intdigest(t.encode(), 42) ^ (1 << 63)) - (1 << 63)
    line = sorted(range(len(texts)), key=lambda i: (signed(texts[i][1]), i))
    sizes = [len(t.encode()) + 8 for _, t in texts]
    total, before, want, held = sum(sizes), 0, {}, {}
    for i in line:
        shard = min(23, int((before + sizes[i] // 2) / total * 24))
        want[texts[i][0]] = (shard, held.get(shard, 0))
        held[shard] = held.get(shard, 0) + 1
        before += sizes[i]
    assert {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.assign_shards(rows).collect()} == want
