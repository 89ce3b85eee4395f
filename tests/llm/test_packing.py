import bisect
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.conftest import ODD_ROWS
from tidemark.llm import packing, token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
OWN = token_files.ByteLevel(token_files.read_byte_level(PATH))


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def one_by_one(counts, capacity):
    """Sequences that best fit opens when pieces come singly, longest first."""
    rooms, opened = [], 0
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms.pop(at)
            else:
                room, opened = capacity, opened + 1
            if room > length:
                bisect.insort(rooms, room - length)
    return opened


@settings(max_examples=300, deadline=None)
@given(st.dictionaries(st.integers(1, 24), st.integers(0, 40), max_size=10))
def test_plan_is_best_fit(counts):
    capacity = 24
    filled, ranks = {}, {length: [] for length in counts}
    for s in packing.best_fit(counts, capacity):
        for rank in range(s.rank_from, s.rank_to):
            ranks[s.length].append(rank)
            k = rank - s.rank_from
            filled.setdefault(s.sequence_from + k // s.each, []).append((s.offset + k % s.each * s.length, s.length))
    assert {n: sorted(r) for n, r in ranks.items()} == {n: list(range(c)) for n, c in counts.items()}
    for places in filled.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    assert len(filled) == one_by_one(counts, capacity)


def test_a_piece_that_does_not_fit():
    with pytest.raises(ValueError):
        packing.best_fit({25: 1}, 24)


def test_plan_does_not_grow_with_counts():
    small, large = ({n: k + n % 7 for n in range(1, 2049)} for k in (5, 10**9))
    assert len(packing.best_fit(large)) < 2 * len(packing.best_fit(small)) + 2048


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_ids_of_any_text(text):
    assert OWN.encode(text, True).tolist() == library_ids(text)


def test_ids_of_special_tokens_and_every_character():
    for text in ("a <|endoftext|> b", "<|endoftext|><|endoftext|>", "  <|endoftext|>\n\n"):
        assert OWN.encode(text, True).tolist() == library_ids(text)
        assert 50256 not in OWN.encode(text, False).tolist()
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for lo in range(0, len(points), 4_000):
        text = "".join(f"a{chr(c)}1{chr(c)}{chr(c)} {chr(c)} !{chr(c)}." for c in points[lo : lo + 4_000])
        assert OWN.encode(text, True).tolist() == library_ids(text)


def test_white_space_that_the_pattern_engine_gives_up_on():
    text = "x" + " " * 1_100_000 + "<|endoftext|> y"
    assert OWN.encode(text, True).tolist() == library_ids(text)


def check(rows, packed, capacity):
    """Every document's pieces are its ids, every sequence is gapless and fits."""
    pieces, filled = {}, {}
    for r in packed:
        pieces.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
        filled.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    want = {}
    for doc_id, text in rows:
        ids = np.array([*library_ids(text), 0], "<u4")
        k = -(-len(ids) // capacity)
        ends = [len(ids) - (k - 1 - i) * capacity for i in range(k)]
        starts = [0, *ends[:-1]]
        want.setdefault(doc_id, []).extend((i, s, e - s, zlib.crc32(ids[s:e].tobytes())) for i, (s, e) in enumerate(zip(starts, ends)))
    assert {k: sorted(v) for k, v in pieces.items()} == {k: sorted(v) for k, v in want.items()}
    counts = {}
    for places in filled.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
            counts[length] = counts.get(length, 0) + 1
        assert end <= capacity
    assert len(filled) == one_by_one(counts, capacity)


@pytest.mark.parametrize("capacity", [2048, 64])
def test_documents(documents, capacity):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    check(rows, packing.pack(documents.repartition(5), PATH, capacity).collect(), capacity)


def test_one_length_in_most_rows(spark):
    frame = spark.range(3000).selectExpr("id AS doc_id", "CASE WHEN id % 3 < 2 THEN 'the same text' ELSE repeat('a b ', int(id % 97)) END AS text").repartition(9)
    check([(r["doc_id"], r["text"]) for r in frame.collect()], packing.pack(frame, PATH, 64).collect(), 64)


def test_odd_rows_empty_table_and_clashing_names(odd, nothing, clashing):
    check([(r[0], r[1]) for r in ODD_ROWS], packing.pack(odd, PATH).collect(), 2048)
    assert packing.pack(nothing, PATH).collect() == []
    renamed = clashing.withColumnRenamed("score", "rank").withColumnRenamed("hits", "part")
    packed = packing.pack(renamed, PATH, carry=("doc_id", "rank", "part"))
    assert packed.where("rank = 'own score' AND part = 'own hits'").count() == packed.count() > len(ODD_ROWS)


def test_sequences_hold_the_ids(documents):
    docs = documents.where("doc_id < 60")
    packed = packing.pack(docs, PATH, 256, ids=True)
    got = [np.frombuffer(r["ids"], "<u4").tolist() for r in packing.sequences(packed).collect()]
    assert sum(map(len, got)) == sum(len(library_ids(r["text"])) + 1 for r in docs.collect()) and max(map(len, got)) <= 256
    pieces = {(r["sequence_id"], r["offset"]): np.frombuffer(r["ids"], "<u4").tolist() for r in packed.collect()}
    by_sequence = {}
    for (sequence, _), ids in sorted(pieces.items()):
        by_sequence.setdefault(sequence, []).extend(ids)
    assert sorted(got) == sorted(by_sequence.values())
