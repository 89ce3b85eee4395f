import hashlib
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import ODD_ROWS
from tidemark.llm import periodic_runs


def brute(words, least=6, periods=4):
    """Every longest stretch of a smallest period, by trying all periods."""
    found = []
    for q in range(1, len(words) // periods + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            run = words[start : i + q]
            if i > start and len(run) >= max(least, periods * q):
                if not any(run[d:] == run[:-d] for d in range(1, q)):
                    found.append((start, len(run), q))
            i += 1
    return sorted(found)


def told(doc_id, text):
    """The words of a text as the query's contract wants them."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if doc_id is None or not words or zlib.crc32(str(doc_id).encode()) % 10:
        return words
    g, n = zlib.crc32(str(doc_id).encode()) // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i if i < a else a + (i - a) % p] for i in range(n)]


def wanted(doc_id, text):
    words = told(doc_id, text)
    runs = brute(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs)]
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    exponent = best[1] * 1000 // best[2] if runs else None
    return (len(runs), *best, exponent, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(" ".join(kept).encode()).hexdigest())


def shown(row):
    return tuple(row[c] for c in ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"))


def factor(letters, i, descending):
    """The longest Lyndon factor at i."""
    best, signed = 1, [-c if descending else c for c in letters]
    for end in range(i + 2, len(letters) + 1):
        if letters[end - 1] == 0:
            break
        word = signed[i:end]
        if all(word < word[k:] for k in range(1, len(word))):
            best = end - i
    return tuple(letters[i : i + best])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=16), st.booleans())
def test_groups_are_lyndon_factors(inner, descending):
    letters = [0, *inner, 0]
    group, length = periodic_runs.lyndon_groups(letters, descending)
    factors = {i: factor(letters, i, descending) for i, c in enumerate(letters) if c}
    for i, f in factors.items():
        assert length[group[i]] == len(f)
        assert all((group[i] == group[j]) == (f == h) for j, h in factors.items())


@settings(max_examples=300, deadline=None)
@given(
    st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=6), st.integers(1, 7)), max_size=8),
    st.integers(3, 5),
    st.sampled_from([5, 6, 9]),
)
def test_any_words(blocks, periods, least):
    words = [w for block, times in blocks for w in block * times]
    assert periodic_runs.runs_of([words, words[::-1]], least, periods) == [brute(words, least, periods), brute(words[::-1], least, periods)]


def test_runs_of_many_texts_do_not_meet():
    assert periodic_runs.runs_of([[7, 7, 7], [7, 7, 7, 7], [], [7] * 9]) == [[], [], [], [(0, 9, 1)]]


def test_long_texts():
    random.seed(3)
    block = [random.randrange(50) for _ in range(5_000)]
    words = block * 5 + [99] + block[:2500] * 4 + [3] * 10_000
    found = periodic_runs.runs_of([words])[0]
    assert (0, 25_000, 5_000) in found and (25_001, 10_000, 2_500) in found
    assert found[-1][1] >= 10_000 and found[-1][2] == 1


def test_documents(documents):
    got = periodic_runs.digests(periodic_runs.find_runs(periodic_runs.repeated_tails(documents)))
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    short = {k: t for k, t in texts.items() if len((t or "").split()) < 2_000}
    rows = {r["doc_id"]: shown(r) for r in got.collect()}
    assert set(rows) == set(texts)
    assert {k: rows[k] for k in short} == {k: wanted(k, t) for k, t in short.items()}
    assert any(r[0] for r in rows.values())


def test_odd_rows_empty_table_and_clashing_names(spark, odd, nothing, clashing):
    got = periodic_runs.digests(periodic_runs.find_runs(periodic_runs.repeated_tails(odd)))
    rows = [r for r in ODD_ROWS if len(r[1] or "") < 1_000]
    short = got.where("doc_id IS NULL OR doc_id NOT IN (8, 9)")
    assert sorted((str(r["doc_id"]), *map(str, shown(r))) for r in short.collect()) == sorted((str(r[0]), *map(str, wanted(r[0], r[1]))) for r in rows)
    assert got.count() == len(ODD_ROWS)
    found = periodic_runs.find_runs(clashing.withColumnRenamed("score", "runs"))
    assert found.columns.count("runs") == 1 and found.where("kept = 'own kept'").count() == len(ODD_ROWS)
    assert periodic_runs.find_runs(nothing).collect() == []
    assert periodic_runs.digests(periodic_runs.find_runs(periodic_runs.repeated_tails(nothing))).collect() == []


def test_collapsed_text(spark):
    frame = spark.createDataFrame([(1, "x ha ha ha ha ha ha y a b a b a b a b a  z")], "doc_id long, text string")
    row = periodic_runs.find_runs(frame).first()
    assert [tuple(r) for r in row["runs"]] == [(1, 6, 1), (8, 9, 2)]
    assert row["collapsed"] == "x ha y a b z" and row["n_words"] == 18


def test_too_few_periods(documents):
    with pytest.raises(ValueError):
        periodic_runs.find_runs(documents, 6, 2)
