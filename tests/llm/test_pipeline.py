import corpus_pipeline
import public_tokenizers
import __spark_entry__ as entry
from tests.llm.brute import components, contamination, exact
from tidemark.llm import byte_bpe, quality, queries

SF_DIR = "/root/testdata/sf0.001"


def rows_of(frame):
    return sorted((r["doc_id"], r["text"]) for r in frame.collect())


def test_every_stage_against_the_rows_before_it(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)

    good = stages["good_quality"](spark, docs, SF_DIR)
    assert good.columns == columns
    scored = quality.score(docs, quality.held_in(spark.read.parquet(f"{SF_DIR}/labels.parquet")))
    accepted = {r["doc_id"] for r in scored.where("predicted = 1").collect()}
    before = rows_of(good)
    assert before == [r for r in rows_of(docs) if r[0] in accepted]

    unique = stages["exactly_deduplicated"](spark, good, SF_DIR)
    assert unique.columns == columns
    stay = exact(before)
    after = [r for i, r in enumerate(before) if stay[i][1] == i]
    assert rows_of(unique) == after

    apart = stages["near_deduplicated"](spark, unique, SF_DIR)
    assert apart.columns == columns
    seen, kept = set(), []
    for row, (part, n) in zip(after, components([t for _, t in after])):
        if n == 0 or part not in seen:
            kept.append(row)
        seen.add(part)
    assert rows_of(apart) == kept

    clean = stages["decontaminated"](spark, apart, SF_DIR)
    assert clean.columns == columns
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    rest = [r for r in kept if not contamination(r[1], items)[1]]
    assert rows_of(clean) == rest

    done = stages["encoded"](spark, clean, SF_DIR).collect()
    own = byte_bpe.Vocabulary(byte_bpe.read_ranks(public_tokenizers.path(corpus_pipeline.RANKS)), public_tokenizers.PATTERN)
    assert sorted((r["doc_id"], r["ids"], r["n_tokens"], r["round_trip"]) for r in done) == sorted(
        (i, own.encode(t), len(own.encode(t)), True) for i, t in rest
    )


def test_odd_rows_pass_through(spark, odd, nothing):
    for docs in (odd, nothing):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF_DIR)
        docs.collect()


def test_registration():
    names = entry.queries()
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(queries.QUERIES) | {"pipeline"} <= set(names)
    assert set(queries.SQL) <= set(entry.oracle_sql())
