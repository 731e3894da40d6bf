"""Every operator and stage on nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

import pytest
from pyspark.sql import functions as F

import public_tokenizers
from itemloom.llm import bpe, cotraining, licenses, mixing, privacy, quality, sharding, simhash, toxicity, vectors

from odd_rows import LONG, ODD, clashing

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
IDS = sorted((r[0] for r in ODD), key=lambda i: (i is None, i or 0))


def operators(labels):
    return {
        "bpe": lambda d: bpe.encode_texts(d, RANKS, public_tokenizers.PATTERN, digests=True),
        "mixing": lambda d: mixing.taken_words(d),
        "privacy": lambda d: privacy.found(d),
        "quality": lambda d: quality.judged(d, quality.fit(d, labels)),
        "cotraining": lambda d: cotraining.scored(d, cotraining.fit(d, labels)),
        "toxicity": lambda d: toxicity.scored(d, toxicity.fit(d, labels)),
        "simhash": lambda d: simhash.grouped(d),
        "sharding": lambda d: sharding.sharded(d, shards=4),
        "licenses": lambda d: licenses.scanned(d),
    }


NAMES = list(operators(None))


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows(odd, labels, name):
    rows = operators(labels)[name](odd).collect()
    assert sorted((r["doc_id"] for r in rows), key=lambda i: (i is None, i or 0)) == IDS
    by_id = {r["doc_id"]: r.asDict() for r in rows}
    plain = by_id[1] | {"doc_id": 2}
    if name in ("bpe", "privacy", "licenses"):  # a null text is the empty one
        assert {k: v for k, v in plain.items() if k not in ODD_COLUMNS} == {k: v for k, v in by_id[2].items() if k not in ODD_COLUMNS}
    if name == "bpe":
        assert by_id[1]["ids"] == [] and by_id[1]["n_tokens"] == 0 and by_id[4]["n_tokens"] > 120_000
    if name == "mixing":
        assert by_id[4]["size"] == 120_001 and by_id[3]["taken"] == 0
        assert all(0 <= r["taken"] <= 3 * r["size"] and r["taken"] % max(r["size"], 1) == 0 for r in rows)
    if name == "privacy":
        assert by_id[8]["spans"] == "email:11:18" and by_id[None]["n_ip"] == 1
    if name == "quality":
        assert by_id[4]["n_words"] == 120_001 and by_id[4]["base_failed"] and by_id[1]["base_failed"]
    if name == "simhash":
        assert {i: by_id[i]["component_id"] for i in (1, 2, 3, 5, 6, 7)} == {1: 1, 2: 1, 3: 1, 5: 5, 6: 5, 7: 5}
    if name == "sharding":
        assert by_id[1]["size"] == 1 and by_id[4]["size"] == len(LONG) + 1
        slots = {}
        for r in rows:
            slots.setdefault(r["shard"], []).append(r["slot"])
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())


ODD_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


@pytest.mark.parametrize("name", NAMES)
def test_no_rows(none, labels, name):
    assert operators(labels)[name](none).collect() == []


@pytest.mark.parametrize("name", NAMES)
def test_clashing_columns(odd, labels, name):
    made = operators(labels)[name]
    plain, more = made(odd), made(clashing(odd))
    results = [c for c in plain.columns if c not in ("text", "source", "lang", "n_chars")]
    assert [c for c in more.columns if c.lower() in {x.lower() for x in results}]
    key = lambda r: repr(tuple(r))
    assert sorted(plain.select(results).collect(), key=key) == sorted(more.select(results).collect(), key=key)


@pytest.mark.parametrize("name", ["quality", "cotraining", "toxicity"])
def test_no_labels(odd, labels, name):
    """Without labels every document gets the same score."""
    rows = operators(labels.limit(0))[name](odd).collect()
    column = {"quality": "quality_score", "cotraining": "quality_score", "toxicity": "score"}[name]
    assert len({round(r[column], 6) for r in rows}) == 1 and len(rows) == len(ODD)


@pytest.mark.parametrize("more", [False, True])
def test_stages(spark, odd, none, labels, tmp_path, more):
    import corpus_pipeline

    sf = str(tmp_path)
    labels.write.parquet(f"{sf}/labels.parquet")
    docs = clashing(odd) if more else odd
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, sf)
        if name != "BPE":
            assert got.columns == docs.columns
        rows = got.collect()
        if name == "SimHash near-dedup":
            texts = [r["text"] for r in rows]
            assert len(rows) == 5 and texts.count("same words here") == 1
        if name == "PII":
            assert {r["text"] for r in rows if r["doc_id"] in (8, None)} == {"no id at all [IP]", "😀 ünï code [EMAIL]"}
            assert [r["text"] for r in rows if r["doc_id"] == 1] == [None]
        assert stage(spark, none, sf).count() == 0


def test_vectors(spark):
    v = [1.0, 0.0, 2.0]
    rows = [
        (1, v, 1), (2, v, 1), (3, [2.0, 0.0, 4.0], 1), (4, v, 2), (5, v, None), (6, None, 1), (7, [], 1), (8, [0.0, 0.0, 0.0], 1),
        (9, [1.0, None, 2.0], 1), (10, [float("nan"), 0.0, 1.0], 1), (11, [float("inf"), 0.0, 1.0], 1), (12, [1.0, 0.0], 1), (None, v, 1),
        (13, [1.0, 0.1, 2.0], 1), (13, [1.0, 0.1, 2.0], 1), (14, [1e-30, 0.0, 2e-30], 2),
    ]
    for kind in ("float", "double"):
        df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int").withColumn("n_links", F.lit("extra"))
        got = sorted(vectors.linked(df).collect(), key=lambda r: (r["vec_id"] is None, r["vec_id"]))
        links = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got}
        assert len(got) == len(rows)
        assert [links[i] for i in (1, 2, 3, 13)] == [(4, 1)] * 4 and links[4] == (1, 4) and links[14] == (1, 4)
        assert all(links[i] == (0, i) for i in (5, 6, 7, 8, 9, 10, 11, 12)) and links[None] == (0, None)
        assert {r["vec_id"] for r in got if r["kept"]} == {1, 4, 5, 6, 7, 8, 9, 10, 11, 12, None}
    assert vectors.linked(df.limit(0)).collect() == []
