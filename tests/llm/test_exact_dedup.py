import pytest

from tests.llm.brute import exact
from tests.llm.conftest import ODD_ROWS
from tidemark.llm import exact_dedup


@pytest.mark.parametrize("entries", [1, 3, 65_536])
def test_any_bucket_size_matches_brute_force(documents, entries):
    rows = sorted((r["doc_id"], r["text"]) for r in documents.collect())
    want = [(i, rows[keep][0], n, keep == k, digest) for k, ((i, _), (digest, keep, n)) in enumerate(zip(rows, exact(rows)))]
    got = exact_dedup.exact_duplicates(documents, entries)
    assert sorted((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in got.collect()) == want


def test_directory_splits_only_overfull_buckets(spark):
    keys = spark.range(1000).selectExpr("xxhash64(id) AS hash")
    slots = exact_dedup._directory(keys, 100).collect()
    loads = {}
    for row in slots:
        loads.setdefault(row["bucket"], []).append(row)
    assert len(slots) == len({r["slot"] for r in slots})
    assert all(len({r["depth"] for r in rows}) == 1 for rows in loads.values())
    assert max(len(rows) for rows in loads.values()) <= 100 and len(loads) >= 10


def test_keys_that_share_all_bits_stay_chained(spark):
    slots = exact_dedup._directory(spark.range(50).selectExpr("42L AS hash"), 10).collect()
    assert [(r["slot"], r["depth"]) for r in slots] == [(0, exact_dedup.MAX_DEPTH)]


def test_odd_rows(odd):
    rows = [(r[0], r[1]) for r in ODD_ROWS]
    want = sorted((str(i), str(rows[keep][0]), n, digest) for (i, _), (digest, keep, n) in zip(rows, exact(rows)))
    got = exact_dedup.exact_duplicates(odd).collect()
    assert sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["text_sha256"]) for r in got) == want
    # the longer original stays, of a row repeated in full one
    assert sorted(str(r["doc_id"]) for r in got if r["kept"]) == sorted(map(str, [1, 2, 5, None, 6, 7, 8, 9, 10]))


def test_empty_table_and_clashing_names(nothing, clashing):
    assert exact_dedup.exact_duplicates(nothing).collect() == []
    assert exact_dedup.drop_exact_duplicates(nothing).collect() == []
    stayed = exact_dedup.drop_exact_duplicates(clashing)
    assert stayed.columns == clashing.columns
    assert sorted(str(r["doc_id"]) for r in stayed.collect()) == sorted(map(str, [1, 2, 5, None, 6, 7, 8, 9, 10]))
    assert {r["_row"] for r in stayed.collect()} == {"own _row"}


def test_one_text_in_most_rows(spark):
    frame = spark.range(3000).selectExpr("id AS doc_id", "CASE WHEN id % 3 < 2 THEN 'the same  text' ELSE concat('t', id) END AS text")
    got = exact_dedup.exact_duplicates(frame, 50)
    assert got.where("group_size = 2000 AND keep_id = 0").count() == 2000
    assert got.where("kept").count() == 1001


def test_no_python_in_the_plan(documents):
    plan = exact_dedup.exact_duplicates(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_the_directory_decides(documents, monkeypatch):
    """Rows whose slots are in no bucket are not found."""
    every, whole = exact_dedup._directory, exact_dedup.exact_duplicates(documents, 20).count()
    monkeypatch.setattr(exact_dedup, "_directory", lambda keys, most: every(keys, most).where("bucket < 524288"))
    part = exact_dedup.exact_duplicates(documents, 20).count()
    assert 0 < part < whole == documents.count()
    monkeypatch.setattr(exact_dedup, "_directory", lambda keys, most: every(keys, most).limit(0))
    assert exact_dedup.exact_duplicates(documents, 20).count() == 0


def test_chains_hold_what_differs(spark, monkeypatch):
    """Texts of one hash are chained by their bytes."""
    monkeypatch.setattr(exact_dedup.F, "xxhash64", lambda *columns: exact_dedup.F.length(columns[0]).cast("long"))
    frame = spark.createDataFrame([(1, "ab"), (2, "b a"), (3, "a b"), (4, "cd"), (5, "c"), (6, "d")], "doc_id long, text string")
    got = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in exact_dedup.exact_duplicates(frame).collect()}
    assert got == {1: (3, 2), 2: (2, 1), 3: (3, 2), 4: (4, 1), 5: (5, 1), 6: (6, 1)}


def test_ids_of_text(spark):
    frame = spark.createDataFrame([("b", "x y"), ("a", "xy "), (None, "x y"), ("c", "z")], "doc_id string, text string")
    assert {r["doc_id"]: r["keep_id"] for r in exact_dedup.exact_duplicates(frame).collect()} == {"a": "a", "b": "a", None: "a", "c": "c"}
