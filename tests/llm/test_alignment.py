import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.conftest import ODD_ROWS
from tidemark.llm import alignment, perfect_hash, token_files

PATH_A, PATH_B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
A = Tokenizer.from_file(PATH_A)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=PATH_B)


def byte_characters():
    """Byte-level characters to bytes: printable ones stand for themselves, the others follow from 256 on."""
    found, extra = {}, 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            found[chr(b)] = b
        else:
            found[chr(extra)] = b
            extra += 1
    return found


CHARACTERS = byte_characters()


def tokens(text):
    """((id, bytes), ...) by both tokenizers, or nothing."""
    if not text:
        return [], []
    a = [(i, bytes(CHARACTERS[c] for c in A.id_to_token(i))) for i in A.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in B.encode(text):
        piece = B.id_to_piece(i)
        b.append((i, bytes([int(piece[3:-1], 16)]) if B.is_byte(i) else piece.replace("▁", " ").encode()))
    said = (" " + text).encode()
    if b"".join(x for _, x in a) != said or b"".join(x for _, x in b) != said:
        return [], []
    return a, b


def group_ends(side):
    found, end = [], 0
    for _, x in side:
        end += len(x)
        found.append(end)
    return found


def grouped(text):
    """[(a ids, b ids)] of a text, with the last of each linked."""
    a, b = tokens(text)
    a_ends, b_ends = group_ends(a), group_ends(b)
    found, i, j = [], 0, 0
    for end in sorted(set(a_ends) & set(b_ends)):
        k, m = a_ends.index(end, i) + 1, b_ends.index(end, j) + 1
        found.append(([x for x, _ in a[i:k]], [x for x, _ in b[j:m]]))
        i, j = k, m
    return found


def wanted(texts):
    """Per text (n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)."""
    each = [grouped(t) for t in texts]
    counts = Counter((a[-1], b[-1]) for groups in each for a, b in groups)
    highest = {}
    for (_, b), n in counts.items():
        highest[b] = max(highest.get(b, 0), n)
    out = []
    for groups in each:
        links = [(a[-1], b[-1]) for a, b in groups]
        line = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        digest = hashlib.sha256(line.encode()).hexdigest() if line else ""
        n_a, n_b = sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups)
        best = sum(counts[x] == highest[x[1]] for x in links)
        out.append((n_a, n_b, len(groups), len(links), best, sum(counts[x] for x in links), digest))
    return out


def shown(row):
    return tuple(row[c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"))


@pytest.mark.parametrize("at_once, bucket_keys", [(alignment.PAIRS_AT_ONCE, perfect_hash.BUCKET_KEYS), (300, 100)])
def test_documents(documents, at_once, bucket_keys):
    """In one shard and in many."""
    rows = documents.collect()
    encoded = alignment.encode(documents.repartition(5), PATH_A, PATH_B)
    counts = alignment.count_pairs(encoded, at_once, bucket_keys)
    assert (len(counts.shards) > 1) == (at_once == 300)
    got = {r["doc_id"]: shown(r) for r in alignment.summarize(encoded, counts).collect()}
    assert got == dict(zip((r["doc_id"] for r in rows), wanted([r["text"] for r in rows])))
    links = Counter((a[-1], b[-1]) for r in rows for a, b in grouped(r["text"]))
    table = counts.table(documents.sparkSession).collect()
    assert {(r["a_id"], r["b_id"]): r["links"] for r in table} == links and len(table) == len(links)


def test_many_vectors_are_summed(spark, monkeypatch):
    monkeypatch.setattr(alignment, "FAN", 2)
    frame = spark.range(400).selectExpr("id AS doc_id", "concat('word ', id % 7, ' of ', id % 3) AS text").repartition(13)
    encoded = alignment.encode(frame, PATH_A, PATH_B)
    vectors = alignment.count_pairs(encoded)
    want = Counter((a[-1], b[-1]) for r in frame.collect() for a, b in grouped(r["text"]))
    assert {(r["a_id"], r["b_id"]): r["links"] for r in vectors.table(spark).collect()} == want


def test_groups(documents):
    docs = documents.where("doc_id < 40")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in alignment.groups(alignment.encode(docs, PATH_A, PATH_B)).collect():
        assert [(g["a"], g["b"]) for g in r["groups"]] == grouped(texts[r["doc_id"]])


def test_odd_rows_empty_table_and_clashing_names(spark, odd, nothing, clashing):
    encoded = alignment.encode(odd, PATH_A, PATH_B)
    got = alignment.summarize(encoded, alignment.count_pairs(encoded)).collect()
    want = wanted([r[1] for r in ODD_ROWS])
    assert sorted((str(r["doc_id"]), *map(str, shown(r))) for r in got) == sorted((str(r[0]), *map(str, w)) for r, w in zip(ODD_ROWS, want))
    empty = alignment.encode(nothing, PATH_A, PATH_B)
    counts = alignment.count_pairs(empty)
    assert alignment.summarize(empty, counts).collect() == [] and counts.table(spark).collect() == []
    named = alignment.encode(clashing.withColumnRenamed("score", "a"), PATH_A, PATH_B, carry=("doc_id", "a", "_row"))
    rows = alignment.summarize(named, alignment.count_pairs(named))
    assert rows.where("a = 'own score' AND _row = 'own _row'").count() == len(ODD_ROWS)
    blank = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    encoded = alignment.encode(blank, PATH_A, PATH_B)
    assert {shown(r) for r in alignment.summarize(encoded, alignment.count_pairs(encoded)).collect()} == {(0, 0, 0, 0, 0, 0, "")}


BYTES, PIECES = token_files.ByteLevel(token_files.read_byte_level(PATH_A)), token_files.Pieces(token_files.read_pieces(PATH_B))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=5))
def test_any_texts(texts):
    sides = [tokens(t) for t in texts]
    ids = [[np.array([i for i, _ in side], "<u2").tobytes() for side in column] for column in zip(*sides)] or [[], []]
    found = alignment.align(*ids, *(np.array([len(x) for x in t.bytes_of], np.int64) for t in (BYTES, PIECES)))
    lines = alignment.group_lines(found, alignment._names(50257))
    assert lines == [";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in grouped(t)) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.sets(st.integers(0, 2**63 - 1), max_size=300), st.integers(0, 2**63 - 1))
def test_hash_of_a_bucket_is_perfect(keys, other):
    found = np.array(sorted(keys), np.uint64)
    sizes, words, ordered = perfect_hash.build_bucket(found)
    hashed = perfect_hash.PerfectHash([{"bucket": 0, "sizes": sizes, "words": words.tobytes(), "keys": ordered.tobytes()}], 1)
    assert sorted(hashed.slots(found).tolist()) == list(range(len(keys)))
    assert (hashed.keys[hashed.slots(found)] == found).all()
    assert (hashed.slots(np.array([other], np.uint64))[0] == -1) == (other not in keys)


def test_hash_over_buckets(spark):
    keys = spark.range(5000).selectExpr("id * 7919 AS key")
    rows = perfect_hash.build(keys, 16).collect()
    hashed = perfect_hash.PerfectHash(rows, 16)
    every = np.arange(5000, dtype=np.uint64) * np.uint64(7919)
    assert len(rows) == 16 and sorted(hashed.slots(every).tolist()) == list(range(5000))
    assert (hashed.slots(every + np.uint64(1)) == -1).all()
    # some of the buckets are a hash of their own keys
    half = perfect_hash.PerfectHash([r for r in rows if r["bucket"] < 8], 16)
    found = half.slots(every)
    assert sorted(found[found >= 0].tolist()) == list(range(len(half))) and 0 < len(half) < 5000
