"""Results of the corpus operators against brute force, exact round trips, SQL, and labels that were held out."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from near import brute_pairs
from oracle import compare, connect
from pyspark.sql import functions as F

from itemloom.llm import bpe, components, cotraining, licenses, mixing, privacy, quality, sharding, simhash, toxicity, trees, vectors
from itemloom.llm.queries import QUERIES, SQL

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TESTDATA = "/root/testdata"


def table(spark, name, size="sf0.01"):
    return spark.read.parquet(f"{TESTDATA}/{size}/{name}.parquet")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(SQL))
def test_same_rows_as_sql(spark, sf, name):
    assert compare(QUERIES[name](spark, sf), connect(sf), SQL[name]) is None


# -- token ids --------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.read_ranks(RANKS), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference_codec():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n\t'stredm019aA")), max_size=80))
def test_ids_of_any_text(codec, reference_codec, text):
    packed = codec.encode([text])[0]
    assert np.frombuffer(packed, "<u4").tolist() == reference_codec.encode_ordinary(text)
    assert codec.decode(packed) == text.encode()


def test_ids_of_every_token(codec, reference_codec):
    texts = [t.decode() for t in codec.ranks if t.decode(errors="ignore").encode() == t]
    assert [np.frombuffer(p, "<u4").tolist() for p in codec.encode(texts)] == [reference_codec.encode_ordinary(t) for t in texts]


def test_round_trip_of_documents(spark, reference_codec):
    docs = table(spark, "documents").limit(200)
    coded = bpe.encode_texts(docs, RANKS, public_tokenizers.PATTERN, digests=True)
    for r in bpe.decode_ids(coded, RANKS, public_tokenizers.PATTERN).collect():
        raw = r["text"].encode()
        assert bytes(r["decoded"]) == raw and r["decoded_sha256"] == hashlib.sha256(raw).hexdigest()
        assert r["ids"] == reference_codec.encode_ordinary(r["text"]) and r["n_tokens"] == len(r["ids"])
        assert r["ids_sha256"] == hashlib.sha256(np.array(r["ids"], "<u4").tobytes()).hexdigest()
    bad = spark.createDataFrame([([1, -1],), (None,), ([10**6],)], "ids array<int>")
    assert [r["decoded"] for r in bpe.decode_ids(bad, RANKS, public_tokenizers.PATTERN).collect()] == [None] * 3


# -- mix --------------------------------------------------------------------------------------


def brute_targets(sizes, weights, most):
    names = sorted((n for n in sizes if n is not None), key=lambda n: [ord(c) for c in n]) + [None] * (None in sizes)
    weight = {n: weights[k % len(weights)] for k, n in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[n] for n in full)
        open_ = sum(weight[n] for n in names if n not in full)
        got = {n: most * sizes[n] if n in full else rest * weight[n] / open_ for n in names}
        over = {n for n in names if n not in full and got[n] > most * sizes[n]}
        if not over:
            return got
        full |= over


def test_mix_of_skewed_sources(spark):
    rng = random.Random(3)
    rows = [(i, "w " * rng.randint(0, 40), rng.choice(["hot"] * 8 + ["b", "c", "d", "é", None])) for i in range(3000)]
    rows += [(10_000 + i, "w " * 5, f"tiny{i}") for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    first = mixing.taken_words(docs)
    assert not any(word in plan_of(first) for word in ("Python", "Pandas", "Arrow"))
    got = sorted(map(tuple, first.collect()))
    again = mixing.taken_words(docs.repartition(7).select("source", "text", "doc_id"))
    assert got == sorted(map(tuple, again.collect()))
    sizes, source = Counter(), {i: s for i, _, s in rows}
    for i, size, *_ in got:
        sizes[source[i]] += size
    want, taken = brute_targets(sizes, (5, 2, 1), 3), Counter()
    for i, size, source_size, target, words in got:
        assert source_size == sizes[source[i]] and abs(target - want[source[i]]) < 1e-6 and words <= 3 * size
        taken[source[i]] += words
    assert all(abs(taken[s] - want[s]) <= 80 for s in want) and sum(taken.values()) <= sum(sizes.values())
    copies = Counter(r["doc_id"] for r in mixing.mixed(docs, ordered=True).collect())
    assert copies == Counter({i: w // s for i, s, _, _, w in got if w})


# -- personal data ----------------------------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = int(c) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def brute_spans(text):
    out = []
    for number, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            fits = {
                "email": True,
                "ip": kind != "ip" or all(int(p) <= 255 for p in m.group().split(".")),
                "card": 14 <= len(digits) <= 19 and passes(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if fits:
                out.append((m.start(), number, f"{kind}:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(out)]


def test_spans_of_random_texts(spark):
    rng = random.Random(4)
    alphabets = ["ab1 2.3@-+()4\n5é😀_6%", "0123456789.. -+@a", "0123456789 1. "]
    texts = ["".join(rng.choice(a) for _ in range(rng.randint(5, 150))) for a in alphabets for _ in range(700)]
    texts += ["a@b.c_x@d.e", "x@y.z@q.r", "1.2.3.4.5.6.7.8", "0001.2.3.4", "256.1.1.1 1.1.1.999", "1.2.3.4 " * 2000, "a@b." + "c." * 9000 + "d"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = privacy.found(docs)
    assert not any(word in plan_of(found) for word in ("Python", "Pandas", "Arrow"))
    for r in found.collect():
        want = brute_spans(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert set(want) <= set(r["spans"].split(",") if r["spans"] else [])
        assert r["n_ip"] == sum(s.startswith("ip:") for s in want)


def test_terms_that_reveal(spark):
    texts = ["Call John Smithers at john@x.com now please", "We saw Smithers john@x.com later there", "other words and Smithers"]
    texts += ["call please now there later other words"] * 50
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in privacy.found(docs).collect()}
    assert (got[0], got[1], got[2], got[3]) == ("term:10:18,email:22:32", "term:7:15,email:16:26", "", "")
    clean = {r["doc_id"]: r["text"] for r in privacy.sanitised(docs).collect()}
    assert clean[0] == "Call John [NAME] at [EMAIL] now please" and clean[2] == texts[2] and len(clean) == len(texts)
    # copies of one text are one piece of evidence
    copies = spark.createDataFrame([(i, "Call John Smithers at john@x.com") for i in range(5)] + [(9, "x y z")] * 9, "doc_id long, text string")
    assert {r["n_term"] for r in privacy.found(copies).collect()} == {0}


def test_terms_anywhere_in_the_document(spark):
    filler = "call please now there later other words " * 10
    texts = ["Smithers writes. " + filler + "Ask smithers or john@x.com", filler + "john@x.com " + filler + " Yours, Smithers", filler + "Smithers"]
    texts += [filler] * 50
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["spans"].split(",") for r in privacy.found(docs).collect()}
    for i in (0, 1):
        at = [m.span() for m in re.finditer("smithers", texts[i].lower())]
        assert [s for s in got[i] if s.startswith("term")] == [f"term:{a}:{b}" for a, b in at]
    assert got[2] == got[3] == [""]
    clean = [r["text"] for r in privacy.sanitised(docs).where("doc_id < 2").collect()]
    assert len(clean) == 2 and not any("smithers" in t.lower() or "@" in t for t in clean)


def test_terms_of_a_repeated_footer(spark):
    footer = " With kind regards from all of us who are in the office today, Jane Smithers, jane@x.com, our office by the river in the old town, first floor, second door"
    rows = [(i, f"text {'abcdefgh'[i]}{'xyz'[i % 3]}" * 3 + footer) for i in range(8)] + [(i, "other words in the text") for i in range(8, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in privacy.found(docs).collect()}
    for i, text in rows[:8]:
        at = text.index("Smithers")
        assert f"term:{at}:{at + 8}" in got[i]
    assert not any(got[i] for i in range(8, 60))


# -- quality ----------------------------------------------------------------------------------


def brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(zip(words, words[1:], words[2:]))
    inside = {k + d for k, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for d in range(3)}
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside)]


@settings(max_examples=200, deadline=None)
@given(st.text(st.one_of(st.sampled_from("ab \n\t\x0b\x85\xa0#|<"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_counts_of_any_text(text):
    assert quality.statistics(text)[0] == brute_counts(text)


def test_counts_of_documents(spark):
    docs = table(spark, "documents")
    model = quality.fit(docs, table(spark, "labels"))
    for r in quality.judged(docs, model, keep=["text"]).collect():
        want = brute_counts(r["text"])
        assert [r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")] == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert r["kept"] == (not r["base_failed"] and r["quality_score"] >= 0.5)


def split_labels(spark, size):
    labels = table(spark, "labels", size)
    return labels.where(~toxicity.held_out("doc_id")), labels.where(toxicity.held_out("doc_id"))


@pytest.mark.parametrize("module", [quality, cotraining])
def test_quality_of_documents_not_seen(spark, module):
    docs = table(spark, "documents")
    known, aside = split_labels(spark, "sf0.01")
    model = module.fit(docs, known)
    score = (quality.judged if module is quality else cotraining.scored)(docs, model, keep=["doc_id"])
    rows = score.join(aside, "doc_id").collect()
    bad, good = [r for r in rows if r["quality"] == 0], [r for r in rows if r["quality"] == 1]
    assert sum(r["quality_score"] < 0.5 for r in bad) >= 0.8 * len(bad) > 0
    assert sum(r["quality_score"] >= 0.5 for r in good) >= 0.95 * len(good) > 0


def test_trees_keep_their_directions():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 3))
    y = ((x[:, 0] + 0.5 * np.sin(9 * x[:, 0]) - x[:, 1] + rng.normal(size=2000)) > 0).astype(float)
    model = trees.boost(x, y, [1, -1, 0])
    grid = np.linspace(-3, 3, 200)
    for feature, way in ((0, 1), (1, -1)):
        for other in x[:50]:
            rows = np.repeat(other[None], len(grid), axis=0)
            rows[:, feature] = grid
            assert (way * np.diff(model.margin(rows)) >= -1e-12).all()
    assert ((model.probability(x) > 0.5) == y).mean() > 0.75


# -- toxicity ---------------------------------------------------------------------------------


def test_toxicity_of_documents_not_seen(spark):
    docs, labels = table(spark, "documents", "sf0.1"), table(spark, "labels", "sf0.1")
    net = toxicity.fit(docs, labels)
    rows = toxicity.scored(docs, net, keep=["doc_id"]).join(labels.where(toxicity.held_out("doc_id")), "doc_id").collect()
    caught = Counter((r["toxic"], r["score"] >= 0.3) for r in rows)
    assert caught[1, True] >= 0.75 * (caught[1, True] + caught[1, False]) and caught[0, True] <= 0.03 * caught[0, False]
    assert all(0 <= r["score"] <= 1 for r in rows) and net.thresholds


def test_held_out_rule(spark):
    rows = spark.range(200).select("id", toxicity.held_out("id").alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 4 == 2) for r in rows)


# -- near-duplicates --------------------------------------------------------------------------


def brute_fingerprint(text):
    from xxhash import xxh64_intdigest

    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text))
    if not words:
        return 0
    hashes = [xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(nodes, edges):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


@settings(max_examples=100, deadline=None)
@given(st.text(st.sampled_from("aAbB \n\té\x85"), max_size=60))
def test_fingerprint_of_any_text(text):
    assert simhash.fingerprint(text) == brute_fingerprint(text)


def test_links_in_tight_clusters(spark):
    """Hundreds of fingerprints a few bits from each centre: groups under a key are larger than what is compared pair by pair."""
    rng = np.random.default_rng(1)
    found = set()
    for centre in rng.integers(0, 2**63, 4, dtype=np.uint64).tolist():
        for _ in range(300):
            x = int(centre)
            for bit in rng.integers(0, 64, rng.integers(0, 7)).tolist():
                x ^= 1 << bit
            found.add(x)
    fps = np.array(sorted(found), np.uint64)
    edges = [(i, i + 1 + int(j)) for i in range(len(fps)) for j in np.flatnonzero(np.bitwise_count(fps[i + 1 :] ^ fps[i]) <= 4)]
    want = roots(range(len(fps)), edges)
    got = simhash.links(spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "_fp long")).collect()
    place = {int(x): i for i, x in enumerate(fps.view(np.int64))}
    pairs = [(place[r["a"]], place[r["b"]]) for r in got]
    assert all(np.bitwise_count(fps[a] ^ fps[b]) <= 4 for a, b in pairs)
    assert roots(range(len(fps)), pairs) == want and len(set(want.values())) > 4


def test_groups_of_documents(spark):
    docs = table(spark, "documents", "sf0.001").select("doc_id", "text").collect()
    fps = {r["doc_id"]: brute_fingerprint(r["text"]) for r in docs}
    edges = [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 4]
    want = roots(sorted(fps), edges)
    got = simhash.grouped(table(spark, "documents", "sf0.001")).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got} == {i: (f"{fps[i]:016x}", want[i]) for i in fps}
    left = simhash.deduplicated(table(spark, "documents", "sf0.001"))
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(set(want.values())) and left.columns == table(spark, "documents", "sf0.001").columns


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (200, 199), (199, 200)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: v for k, v in roots({x for e in edges for x in e}, edges).items()}


def test_vectors_in_small_tiles(spark):
    """Tiles of a few vectors, copies, a hot label, and cosines on both sides of the threshold."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 6))
    x = np.concatenate([c + rng.normal(size=(25, 6)) * 0.25 for c in centres]).astype(np.float32)
    x = np.concatenate([x, x[:20], np.repeat(x[5:6], 30, axis=0)])
    labels = rng.choice([1, 1, 1, 2, 3], len(x)).tolist()
    rows = [(i, v.tolist(), label) for i, (v, label) in enumerate(zip(x, labels, strict=True))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.93) & (np.array(labels)[:, None] == np.array(labels)[None]) & ~np.eye(len(x), dtype=bool)
    want = roots(range(len(x)), zip(*map(lambda a: a.tolist(), np.nonzero(near)), strict=True))
    for block in (7, 2048):
        got = vectors.linked(df, block=block).collect()
        assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == {i: (int(near[i].sum()), want[i]) for i in range(len(x))}


# -- shards and licenses ----------------------------------------------------------------------


def test_shards_of_skewed_documents(spark):
    rng = random.Random(5)
    hot = "hot text " * 30
    rows = [(i, hot if i % 3 == 0 else f"{i} " * rng.randint(1, 90), rng.choice("ab"), "en") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    got = sharding.sharded(docs, shards=7).collect()
    size, slots, homes = Counter(), defaultdict(list), defaultdict(set)
    texts = {r[0]: r[1] for r in rows}
    for r in got:
        assert r["size"] == len(texts[r["doc_id"]].encode()) + 1 and r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode())
        size[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        homes[texts[r["doc_id"]]].add(r["shard"])
    assert sorted(size) == list(range(7)) and max(size.values()) < 1.1 * min(size.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(h) == 1 for t, h in homes.items() if t != hot)
    assert len({r["shard"] for r in sharding.sharded(docs, shards=None, target_bytes=100_000).collect()}) == -(-sum(size.values()) // 100_000)


NOTICES = {
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    "Released under the MIT License.": "MIT",
    "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
}


def test_notices_of_documents(spark):
    for r in licenses.scanned(table(spark, "documents")).collect():
        want = sorted((m.start(), name) for line, name in NOTICES.items() for m in re.finditer(re.escape(line), r["text"]))
        assert [(n["start"], n["license"]) for n in r["notices"]] == want


def test_notices_word_by_word():
    scanner = licenses.Scanner()
    found = lambda text: [n["license"] for n in scanner.scan(text)[1]]
    wrapped = "it is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\n"
    assert found("This program " + wrapped[3:] + "the Free Software Foundation, either version 3 of the License, or") == ["GPL-3.0"]
    assert found("This program " + wrapped[3:] + "the Free Software Foundation, either version 4 of the License, or") == []
    assert found("x y. Licensed under CC BY 4.0") == ["CC-BY-4.0"] and found("Licensed under CC BY-NC-ND 4.0.") == []
    assert found("Licensed under the Apache License, Version 1.1.") == [] and found("we license nothing") == []
    assert found("İ" * 3 + "\nReleased under the MIT License.\nLicensed under CC BY-SA 4.0.") == ["MIT", "CC-BY-SA-4.0"]


@pytest.mark.parametrize("license,line", [(name, t) for name, texts in licenses.TEMPLATES.items() for t in texts])
def test_notices_inside_long_texts(license, line):
    scanner = licenses.Scanner()
    for before, after in (("", "\nimport os\n" + "foo bar " * 60), ("some prose goes before it. ", " And more words follow. " * 20), ("a b. " * 90, "")):
        n_blocks, found = scanner.scan(before + line + after)
        assert [(n["license"], n["start"]) for n in found] == [(license, len(before))] and n_blocks
        assert found[0]["reduction"] >= 0.5 and not found[0]["missing"] and not found[0]["extra"]


SCANNER = licenses.Scanner()


@pytest.mark.parametrize("license,line", [(name, t) for name, texts in licenses.TEMPLATES.items() for t in texts])
def test_notices_wrapped_anywhere(license, line):
    words = line.split(" ")
    for gap in ("\n", "\n * ", "\n" + " " * 90 + "// "):
        for at in range(1, len(words)):
            text = f"int x;\n/* {' '.join(words[:at])}{gap}{' '.join(words[at:])}\n */ more words"
            found = SCANNER.scan(text)[1]
            assert [(n["license"], n["start"]) for n in found] == [(license, 10)]


# -- pipeline ---------------------------------------------------------------------------------


def test_pipeline_step_by_step(spark, codec):
    import corpus_pipeline

    sf = f"{TESTDATA}/sf0.001"
    docs = table(spark, "documents", "sf0.001")
    stages = dict(corpus_pipeline.STAGES)
    rows = {r["doc_id"]: r for r in docs.collect()}
    good = stages["quality rules"](spark, docs, sf)
    kept = {r["doc_id"] for r in good.collect()}
    passed = {i for i, r in rows.items() if (c := brute_counts(r["text"]))[0] >= 50 and 100 * c[4] <= 50 * c[0]}
    bad = {r["doc_id"] for r in table(spark, "labels", "sf0.001").where("quality = 0").collect()}
    assert kept <= passed and len(passed - bad - kept) <= 0.02 * len(passed) and len(kept & bad) <= 0.2 * len(bad)
    one = stages["SimHash near-dedup"](spark, good, sf)
    want = roots(sorted(kept), brute_pairs({i: rows[i]["text"] for i in kept}))
    left = {r["doc_id"] for r in one.collect()}
    assert left == set(want.values())
    clean = stages["PII"](spark, one, sf)
    for r in clean.collect():
        assert not brute_spans(r["text"]) and r["n_chars"] == len(r["text"])
        assert r["text"] == rows[r["doc_id"]]["text"] or brute_spans(rows[r["doc_id"]]["text"])
    got = stages["source mix"](spark, clean, sf)
    taken = {r["doc_id"]: r["taken"] // r["size"] for r in mixing.taken_words(clean).collect() if r["taken"]}
    assert Counter(r["doc_id"] for r in got.collect()) == Counter(taken) and got.columns == docs.columns
    texts = {r["doc_id"]: r["text"] for r in clean.collect()}
    for r in stages["BPE"](spark, got, sf).collect():
        assert codec.decode(np.array(r["ids"], "<u4").tobytes()).decode() == texts[r["doc_id"]]
    whole = corpus_pipeline.run(spark, sf)
    assert Counter(r["doc_id"] for r in whole.collect()) == Counter(taken)


def test_nothing_else_imports_the_folder():
    import pathlib

    root = pathlib.Path(quality.__file__).parents[1]
    others = [p for p in root.rglob("*.py") if "llm" not in p.relative_to(root).parts]
    assert others and not any(re.search(r"\bllm\b", p.read_text()) for p in others)
