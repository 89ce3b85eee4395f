import pytest

from tests.llm.brute import WORD, contamination
from tidemark.llm import decontaminate


def got(frame):
    return sorted(
        (str(r["doc_id"]), r["n_words"], r["n_hit"], tuple(r["item_ids"]))
        for r in frame.select("doc_id", "n_words", "item_ids", decontaminate.covered_words("hits").alias("n_hit")).collect()
    )


def want(docs, items):
    out = []
    for i, text in docs:
        n, hit, named = contamination(text, items)
        out.append((str(i), n, hit, tuple(sorted(named))))
    return sorted(out)


@pytest.mark.parametrize("block", [500, 2_000_000])
def test_documents_match_brute_force(spark, documents, benchmark, block, monkeypatch):
    """With small blocks several automata scan the documents one after another."""
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", block if block > 1000 else 40_000)
    docs = documents.limit(80)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    items = [(r["item_id"], r["text"]) for r in benchmark.collect()]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(decontaminate.find_benchmark_passages(frame, benchmark)) == want(rows, items)


ITEMS = [
    (1, "one two three four five six seven eight nine ten eleven twelve"),
    (2, "short item"),
    (2, "short item"),
    (3, "aa bb aa bb aa bb aa bb aa bb aa"),
    (None, "null named item"),
    (4, None),
    (5, " .,;"),
    (10, "Ünï çödé"),
]
TEXTS = [
    "x ONE, two-three four five six seven eight nine (ten) eleven y",
    "two three four five six seven eight nine ten eleven twelve thirteen",
    "a short item and a short itemised list, SHORT ITEM",
    "aa bb " * 12,
    "a null named item here",
    "ünï çödé and Ünï ÇÖDÉ",
    "one two three four five six seven eight nine",
    "",
    None,
    "\U0001f600 short item",
]


@pytest.mark.parametrize("block", [60, 2_000_000])
def test_cases(spark, block, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", block)
    rows = list(enumerate(TEXTS)) + [(0, TEXTS[0]), (None, TEXTS[2])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = decontaminate.find_benchmark_passages(docs, items)
    assert got(found) == want(rows, ITEMS)
    for r in found.where("doc_id IS NOT NULL").collect():
        text = TEXTS[r["doc_id"]] or ""
        spans = list(zip(r["spans"][::2], r["spans"][1::2]))
        assert sum(len(WORD.findall(text[a:b].lower())) for a, b in spans) == sum(b - a for a, b in zip(r["hits"][::2], r["hits"][1::2]))
        assert all(WORD.match(text[a].lower()) and WORD.match(text[b - 1].lower()) for a, b in spans)


@pytest.mark.parametrize("hashes", [400, 2_000_000])
def test_a_large_benchmark_is_thinned_to_what_occurs(spark, documents, benchmark, hashes, monkeypatch):
    """Of items that no document holds nothing is left, however many; what occurs comes out as by brute force."""
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 20_000)
    monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", hashes)
    rows = [(r["doc_id"], r["text"]) for r in documents.limit(40).collect()]
    foreign = [(1000 + i, " ".join(f"f{i}x{k}" for k in range(25 if i % 3 else 4))) for i in range(90)]
    near = [(2000, " ".join((rows[0][1] or "").split()[:14])), (2001, " ".join((rows[1][1] or "").split()[3:7]))]
    items = foreign + near + ITEMS
    docs = spark.createDataFrame(rows + list(enumerate(TEXTS, 5000)), "doc_id long, text string").repartition(5)
    frame = spark.createDataFrame(items, "item_id long, text string")
    assert len(list(decontaminate._blocks(frame, docs, "text"))) == 1
    found = got(decontaminate.find_benchmark_passages(docs, frame))
    assert found == want(rows + list(enumerate(TEXTS, 5000)), items)
    assert any("2000" in r[3] for r in found) and any("2001" in r[3] for r in found)


def test_odd_rows_empty_tables_and_clashing_names(spark, odd, nothing, clashing, benchmark):
    items = spark.createDataFrame([(1, "quick brown fox")], "item_id long, text string")
    assert decontaminate.find_benchmark_passages(odd, items).count() == 13
    assert decontaminate.find_benchmark_passages(odd, items.limit(0)).where("size(hits) > 0").count() == 0
    assert decontaminate.find_benchmark_passages(nothing, items).collect() == []
    clean = decontaminate.drop_contaminated(clashing, items)
    assert clean.columns == clashing.columns and clean.count() == 10
    assert {r["hits"] for r in clean.collect()} == {"own hits"}
