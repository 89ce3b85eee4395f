import random

import numpy as np
import pytest

from tests.llm.brute import components, shingles
from tidemark.llm import near_dedup
from tidemark.llm.arrow_text import bytes_of, row_groups, shingle_sets, words
import pyarrow as pa


def by_doc(frame):
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in frame.collect())


def expected(rows):
    ids, parts = [r[0] for r in rows], components([r[1] for r in rows])
    smallest = {}
    for i, (part, _) in zip(ids, parts):
        smallest[part] = min(smallest.get(part, i), i)
    return sorted((i, n, i if n == 0 else smallest[part], i == (i if n == 0 else smallest[part])) for i, (part, n) in zip(ids, parts))


def test_documents_match_brute_force(documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    assert by_doc(near_dedup.near_duplicates(documents)) == expected(rows)


def variants(rng, base, n, changes):
    for _ in range(n):
        copy = base[:]
        for at in rng.sample(range(len(copy)), rng.randint(*changes)):
            copy[at] = f"n{rng.randrange(10**9)}"
        yield " ".join(copy)


def test_large_groups_and_a_common_passage_match_brute_force(spark):
    rng = random.Random(3)
    base = [f"b{i}" for i in range(120)]
    passage = " ".join(f"p{i}" for i in range(60))
    texts = list(variants(rng, base, 150, (0, 9)))
    texts += [passage + " " + " ".join(f"u{rng.randrange(10**9)}" for _ in range(rng.randint(5, 60))) for _ in range(150)]
    texts += [passage] * 40 + ["a b c", "A b  c", "a b", "", None]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert by_doc(near_dedup.near_duplicates(frame)) == expected(rows)


def test_chain_of_links_is_one_component(spark):
    words_ = [f"w{i}" for i in range(100)]
    texts = [" ".join(words_[3 * k : 3 * k + 60]) for k in range(12)]
    rows = list(enumerate(texts))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = by_doc(near_dedup.near_duplicates(frame))
    assert found == expected(rows)
    assert {r[2] for r in found} == {0}


def test_odd_rows(odd):
    rows = near_dedup.near_duplicates(odd).collect()
    assert len(rows) == 13
    got = {}
    for r in rows:
        got.setdefault(r["doc_id"], []).append((r["n_shingles"], r["component_id"], r["kept"]))
    assert got[1] == [(8, 1, True)] * 2
    assert got[2] == [(8, 1, False)]
    assert got[9][0][1:] == (8, False)
    assert got[3] == [(0, 3, True)] and got[5] == [(0, 5, True)]
    assert sorted(got[None]) == [(0, None, True), (1, None, True)]


def test_rows_are_told_apart_by_number(spark):
    def said(k, n=30):
        return " ".join(f"t{k}w{i}" for i in range(n))

    rows = [
        (1, said(0)), (None, said(0) + " more"), (None, said(1)), (None, said(2)),  # only the near copy goes
        (2, said(3)), (7, said(3) + " more"), (7, said(4)),  # one id, two texts: only the near copy goes
        (None, said(5)), (None, said(5) + " more"), (None, said(5) + " less"),  # one of them stays
        (9, said(6)), (9, said(6) + " more"), (9, said(6)),  # one of them stays
        (None, None), (None, " "),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    stayed = near_dedup.drop_near_duplicates(frame).collect()
    texts = sorted((r["text"] or "").removesuffix(" more").removesuffix(" less") for r in stayed)
    assert texts == sorted([said(k) for k in range(7)] + ["", " "])
    assert {(r["doc_id"], r["text"]) for r in stayed} >= {rows[i] for i in (0, 2, 3, 4, 6, 13, 14)}
    judged = near_dedup.near_duplicates(frame).collect()
    assert len(judged) == len(rows)
    kept = [r["doc_id"] for r in judged if r["kept"] and r["n_shingles"]]
    # rows of one id and set are one document
    assert {i: kept.count(i) for i in (None, 1, 2, 7)} == {None: 3, 1: 1, 2: 1, 7: 1} and kept.count(9) in (1, 2)


def test_scratch_of_dropping_goes_before_the_result_is_read(odd):
    from tidemark import session
    from tidemark.llm import exact_dedup

    for drop, stay in ((near_dedup.drop_near_duplicates, {"numbered", "near"}), (exact_dedup.drop_exact_duplicates, {"named", "exact"})):
        before = set(session._written)
        left = drop(odd)
        names = {path.rsplit("/", 1)[1].split("-")[0].split("_")[0] for path in session._written - before}
        assert names == stay
        assert left.count() > 0


def test_empty_table_and_clashing_names(nothing, clashing, odd):
    assert near_dedup.near_duplicates(nothing).collect() == []
    stayed = near_dedup.drop_near_duplicates(clashing)
    assert stayed.columns == clashing.columns
    assert {r["doc_id"] for r in stayed.collect()} == {1, 3, None, 4, 5, 6, 7, 8, 10}
    assert {r["h"] for r in stayed.collect()} == {"own h"}


def test_sketches_fill_and_estimate():
    rng = np.random.default_rng(1)
    for size in (1, 2, 30, 4000):
        shared = rng.integers(0, 2**63, size, dtype=np.uint64)
        a = np.unique(np.concatenate([shared, rng.integers(0, 2**63, size, dtype=np.uint64)]))
        b = np.unique(np.concatenate([shared, rng.integers(0, 2**63, size, dtype=np.uint64)]))
        rows = near_dedup.sketches(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
        assert rows.shape == (2, near_dedup.COORDINATES) and (rows != np.iinfo(np.uint64).max).all()
        same = (rows[0] == rows[1]).mean()
        if size >= 30:
            assert abs(same - 1 / 3) < 0.07
        alone = near_dedup.sketches(a, np.array([0, len(a)]))
        assert (alone[0] == rows[0]).all()


@pytest.mark.parametrize("most", [64, 1 << 20])
def test_hashed_sets_have_the_sizes_of_real_sets(documents, most, monkeypatch):
    import tidemark.llm.arrow_text as arrow_text

    monkeypatch.setattr(arrow_text, "SEGMENT_BYTES", most)
    texts = [r["text"] for r in documents.limit(60).collect()] + [None, "", " ", "x" * 500, "One", "a b c d e", "A B C D E a b c d e"]
    data, offsets = bytes_of(pa.array(texts, pa.string()))
    for lo, hi in row_groups(offsets, 5000):
        hashes, _, _, bounds = words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        _, at = shingle_sets(hashes, bounds, 5)
        assert np.diff(at).tolist() == [len(shingles(t)) for t in texts[lo:hi]]
