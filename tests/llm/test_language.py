"""Language profiles against a plain version, held-out accuracy, odd rows."""

import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from odd_rows import LONG, ODD, clashing
from pyspark.sql import functions as F

from itemloom.llm import language

TESTDATA = "/root/testdata"


def brute_ngrams(text):
    out = Counter()
    low = text.lower() if any(c.isalpha() for c in text) else ""
    import regex

    for word in regex.findall(r"[\p{L}\p{M}]+", low):
        padded = f" {word} "
        for n in (1, 2, 3):
            out.update(g for k in range(len(padded) - n + 1) if (g := padded[k : k + n]) != " ")
    return out


@settings(max_examples=200, deadline=None)
@given(st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" aéÜß12.\n")), max_size=60))
def test_ngrams_of_any_text(text):
    grams, counts = language.ngrams(text)
    assert {language.shown(g): n for g, n in zip(grams.tolist(), counts.tolist(), strict=True)} == brute_ngrams(text)


def test_ngrams_over_chunks(monkeypatch):
    text = "über die Brücken gehen wir " * 40
    monkeypatch.setattr(language, "CHUNK", 7)
    grams, counts = language.ngrams(text)
    assert dict(zip(map(language.shown, grams.tolist()), counts.tolist(), strict=True)) == brute_ngrams(text)


def brute_profile(counts, most):
    code = lambda g: sum(ord(c) << 21 * k for k, c in enumerate(reversed(g)))
    return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], code(x[0])))[:most]]


def test_documents_like_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in docs.collect()]
    counts = {}
    for id_, text, lang in rows:
        if lang is not None and zlib.crc32(str(id_).encode()) % 3 != 1:
            counts.setdefault(lang, Counter()).update(brute_ngrams(text or ""))
    profiles = {lang: {g: k for k, g in enumerate(brute_profile(c, 300))} for lang, c in counts.items()}
    model = language.fit(docs, size=300)
    assert sorted(model.languages) == sorted(profiles)
    got = {r["doc_id"]: r for r in language.identified(docs, model, own=100).collect()}
    for id_, text, _ in rows:
        own = brute_profile(brute_ngrams(text or ""), 100)
        far = {lang: sum(abs(p[g] - k) if g in p else 300 for k, g in enumerate(own)) / (300 * len(own)) for lang, p in profiles.items()} if own else {}
        r = got[id_]
        if not far:
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            assert far[r["lang_pred"]] == pytest.approx(min(far.values())) and r["score"] == pytest.approx(1 - min(far.values()))


def test_languages_not_seen(spark):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.01/documents.parquet")
    found = language.identified(docs, language.fit(docs)).where(language.held_out("doc_id")).where("lang is not null and lang_pred <> 'und'")
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right >= 0.99


def test_odd_rows(spark, odd, none):
    model = language.fit(odd)
    got = language.identified(odd, model).collect()
    assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 for r in got)
    by_id = {r["doc_id"]: r["lang_pred"] for r in got}
    assert all(by_id[i] == "und" for i in (1, 2, 3))
    assert by_id[4] in model.languages and len(LONG) > 600_000
    assert {r["lang_pred"] for r in got} <= {"und", *model.languages}
    again = language.identified(clashing(odd).withColumn("lang_pred", F.lit("extra")).withColumn("gram", F.lit(1)), language.fit(clashing(odd)))
    assert sorted(map(repr, again.select("doc_id", "lang_pred", "score").collect())) == sorted(
        repr(r) for r in language.identified(odd, model).select("doc_id", "lang_pred", "score").collect()
    )
    assert language.identified(none, model).collect() == []
    empty = language.fit(none)
    assert {r["lang_pred"] for r in language.identified(odd, empty).collect()} == {"und"}
