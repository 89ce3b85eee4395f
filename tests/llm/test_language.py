import numpy as np
import pyarrow as pa

from tidemark.llm import language
from tidemark.llm.arrow_text import bytes_of


def grams_of(text):
    made, run = "\0", True
    for b in (text or "").encode():
        letter = 97 <= (b | 32) <= 122 and b < 128 or b >= 128
        if letter:
            made += chr(b | 32) if b < 128 else chr(b)
            run = False
        elif not run:
            made += "\0"
            run = True
    if not run:
        made += "\0"
    return [made[i : i + 4] for i in range(len(made) - 3)]


def test_grams_of_several_texts():
    texts = ["Hello, world", "", None, "a", "ab", "42 !", " é x", "tail", "  many   spaces  "]
    grams, at = language._grams(*bytes_of(pa.array(texts, pa.string())))
    for i, text in enumerate(texts):
        got = ["".join(chr(g >> s & 255) for s in (24, 16, 8, 0)) for g in grams[at[i] : at[i + 1]].tolist()]
        assert got == grams_of(text), text


def test_filter_has_no_false_negatives_and_few_false_positives():
    rng = np.random.default_rng(2)
    members = [np.unique(rng.integers(0, 2**32, 3000)) for _ in range(70)]
    model = language.Filter([f"l{i}" for i in range(70)], members, [1.0] * 70, [1 / 70] * 70)
    for number in (0, 63, 64, 69):
        found = [np.bitwise_and.reduce([s[p] for p in model._positions(members[number].astype(np.uint32))]) for s in model.masks]
        assert ((found[number // 64] >> np.uint64(number % 64)) & np.uint64(1)).all()
    other = rng.integers(0, 2**32, 20_000).astype(np.uint32)
    rates = model.rates(other, np.array([0, len(other)]))
    assert rates.max() < 0.01
    own = model.rates(members[66].astype(np.uint32), np.array([0, 3000]))
    assert own[0].argmax() == 66 and own[0, 66] > 0.99


def test_held_out_accuracy(documents):
    got = language.identify(documents).join(documents.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert len(got) == documents.count() and 40 < len(held) < 100
    assert sum(r["lang_pred"] == r["lang"] for r in held) / len(held) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got)


def test_labels_of_the_held_out_fold_are_not_read(documents):
    from pyspark.sql import functions as F

    swapped = documents.withColumn("lang", F.when(language.remainder("doc_id", 3) == 1, F.lit("xx")).otherwise(F.col("lang")))
    assert sorted(language.identify(swapped).collect()) == sorted(language.identify(documents).collect())


def test_odd_rows_empty_table_and_nothing_to_learn(odd, nothing, clashing):
    got = {r["doc_id"]: r for r in language.identify(odd).collect()}
    assert got[3]["lang_pred"] == got[4]["lang_pred"] == got[7]["lang_pred"] == "und" and got[3]["score"] == 0
    assert got[10]["lang_pred"] != "und" and language.identify(odd).count() == 13
    assert language.identify(clashing).count() == 13
    assert language.identify(nothing).collect() == []
    unknown = odd.drop("lang").selectExpr("*", "CAST(NULL AS string) AS lang")
    assert {r["lang_pred"] for r in language.identify(unknown).collect()} == {"und"}


def test_scores_match_plain_counting(documents):
    """Predictions against n-grams counted one by one and sets instead of a filter."""
    import zlib
    from collections import Counter

    rows = documents.collect()
    counts = {}
    for r in rows:
        if r["lang"] is not None and r["text"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 != 1:
            counts.setdefault(r["lang"], Counter()).update(grams_of(r["text"]))
    totals = {lang: sum(c.values()) for lang, c in counts.items()}
    kept = {lang: {g for g, n in c.items() if n >= totals[lang] * language.MIN_SHARE} for lang, c in counts.items()}
    cover = {lang: sum(counts[lang][g] for g in kept[lang]) / totals[lang] for lang in counts}
    got = {r["doc_id"]: r for r in language.identify(documents).collect()}
    for r in rows:
        grams = grams_of(r["text"])
        rates = {lang: sum(g in kept[lang] for g in grams) / max(1, len(grams)) / cover[lang] for lang in sorted(kept)}
        if not any(c.isalpha() for c in r["text"] or "") or not sum(rates.values()):
            continue
        best = max(rates, key=lambda lang: (rates[lang], [-ord(c) for c in lang]))
        score = rates[best] / sum(rates.values())
        row = got[r["doc_id"]]
        # a filter errs on a few n-grams in a thousand
        assert abs(row["score"] - score) < 0.05, (r["doc_id"], row, rates)
        assert row["lang_pred"] == best or sorted(rates.values())[-1] - sorted(rates.values())[-2] < 0.02
