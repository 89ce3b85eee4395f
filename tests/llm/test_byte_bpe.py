import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import ODD_ROWS
from tidemark.llm import byte_bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
RANKS = byte_bpe.read_ranks(PATH)
LIBRARY = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})
OWN = byte_bpe.Vocabulary(RANKS, PATTERN)


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    ids = OWN.encode(text)
    assert ids == LIBRARY.encode_ordinary(text)
    assert OWN.decode(ids).decode() == text


@settings(max_examples=300, deadline=None)
@given(st.text("theinorsabc", max_size=400))
def test_long_pieces(text):
    assert OWN.encode(text) == LIBRARY.encode_ordinary(text)


@settings(max_examples=300, deadline=None)
@given(st.binary(max_size=40), st.binary(max_size=40))
def test_join_is_the_encoding_of_both(a, b):
    assert OWN.join(OWN.piece(a) if a else [], OWN.piece(b) if b else []) == (OWN.piece(a + b) if a + b else [])


def test_a_very_long_piece_and_a_very_long_text(monkeypatch):
    piece = "".join(chr(97 + (i * i * 7 + i // 3) % 26) for i in range(60_000))
    assert OWN.encode(piece) == LIBRARY.encode_ordinary(piece)
    text = "some words, 123 and\n\n  more " * 2000
    want = LIBRARY.encode_ordinary(text)
    monkeypatch.setattr(byte_bpe, "LONG_TEXT", 100)
    monkeypatch.setattr(byte_bpe, "_CHUNK", 64)
    assert OWN.encode(text) == want


def test_small_memories_change_nothing(monkeypatch):
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 3)
    fresh = byte_bpe.Vocabulary(RANKS, PATTERN)
    text = "thblereof anthedin ouerble entionwh thblereof " * 3
    assert fresh.encode(text) == LIBRARY.encode_ordinary(text)


def test_documents(documents):
    rows = {r["doc_id"]: r["text"] for r in documents.collect()}
    for r in byte_bpe.round_trip_digests(documents, PATH, PATTERN).collect():
        ids = LIBRARY.encode_ordinary(rows[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(rows[r["doc_id"]].encode()).hexdigest()


def test_odd_rows_empty_table_and_clashing_names(odd, nothing, clashing):
    digests = byte_bpe.round_trip_digests(odd, PATH, PATTERN).collect()
    want = sorted((str(r[0]), hashlib.sha256((r[1] or "").encode()).hexdigest()) for r in ODD_ROWS)
    assert sorted((str(r["doc_id"]), r["decoded_sha256"]) for r in digests) == want
    encoded = byte_bpe.encode(clashing.withColumnRenamed("score", "ids"), PATH, PATTERN)
    assert encoded.columns.count("ids") == 1 and encoded.where("kept = 'own kept'").count() == 13
    decoded = byte_bpe.decode(encoded, PATH, PATTERN, ["doc_id", "text"])
    assert all(bytes(r["decoded"]).decode() == (r["text"] or "") for r in decoded.collect())
    assert byte_bpe.round_trip_digests(nothing, PATH, PATTERN).collect() == []
    assert byte_bpe.encode(nothing, PATH, PATTERN).collect() == []


@pytest.mark.parametrize("name", ["byte_bpe_50k.tiktoken"])
def test_another_vocabulary(name):
    ranks = byte_bpe.read_ranks(public_tokenizers.path(name))
    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    text = "Grüße aus München; the quick brown fox's 1234 jumps!! \n\n\t x" * 20
    assert byte_bpe.Vocabulary(ranks, PATTERN).encode(text) == library.encode_ordinary(text)
