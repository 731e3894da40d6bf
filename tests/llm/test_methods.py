"""Methods against brute force: near copies, co-training's exchange, compression as the judge of notices, spans in long texts, the network."""

import random
import re
import time
import zlib
from collections import defaultdict

import numpy as np
import pytest
from near import brute_pairs
from pyspark.sql import functions as F

from itemloom.llm import cotraining, licenses, mixing, nearcopies, privacy, sharding, toxicity

TESTDATA = "/root/testdata"

# -- near copies --------------------------------------------------------------------------------


def smallest(nodes, edges):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_near_copies_of_documents(spark, size):
    docs = spark.read.parquet(f"{TESTDATA}/{size}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    want = smallest(texts, brute_pairs(texts))
    left = {r["doc_id"] for r in nearcopies.deduplicated(docs).collect()}
    assert left == set(want.values()) and len(left) < len(texts)


def test_near_copies_by_similarity(spark):
    """Of texts with some words changed, nearly all above 0.8 are found, and none far below."""
    rng = random.Random(2)
    words = [f"w{i}" for i in range(5000)]
    rows = {}
    for k in range(300):
        base = [rng.choice(words) for _ in range(rng.randint(60, 400))]
        other = list(base)
        for at in rng.sample(range(len(base)), max(1, int(len(base) * rng.choice([0.005, 0.01, 0.02, 0.03, 0.05])))):
            other[at] = "changed"
        rows |= {2 * k: " ".join(base), 2 * k + 1: " ".join(other).upper()}
    docs = spark.createDataFrame(list(rows.items()), "doc_id long, text string").repartition(5)
    left = {r["doc_id"] for r in nearcopies.deduplicated(docs).collect()}
    pairs = brute_pairs(rows)
    near = [a for (a, b) in pairs if b == a + 1]
    far = [2 * k for k in range(300) if (2 * k, 2 * k + 1) not in pairs]
    assert len(near) > 150 and sum(a + 1 not in left for a in near) >= 0.97 * len(near)
    assert len(far) > 20 and all(a + 1 in left for a in far) and all(2 * k in left for k in range(300))


def test_a_large_group_of_near_copies(spark):
    """Hundreds of texts with one word of their own each: more edges than texts are never made."""
    base = [f"w{i}" for i in range(200)]
    rows = [(k, " ".join(base[:100] + [f"own{k}"] + base[100:])) for k in range(400)] + [(1000, "something else " * 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r["doc_id"] for r in nearcopies.deduplicated(docs).collect()) == [0, 1000]
    texts = nearcopies.sketches(docs.withColumn("_t", F.xxhash64("text")), "text", ["_t"])
    assert nearcopies.band_pairs(texts).count() < nearcopies.BANDS * 401


def test_no_pair_of_the_similarity_is_missed(spark):
    """2,000 pairs that share 50 of 62 shingles: some of them in none of the bands."""
    rng = np.random.default_rng(3)
    rows = []
    for k in range(2000):
        words = [f"w{x}" for x in rng.integers(0, 10**6, 60)]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join([*words[:54], *(f"x{x}" for x in rng.integers(0, 10**6, 6))]))]
    left = nearcopies.deduplicated(spark.createDataFrame(rows, "doc_id long, text string").repartition(8)).collect()
    assert sorted(r["doc_id"] for r in left) == list(range(0, 4000, 2))


def test_prefixes_meet(spark):
    """Sets of the similarity share a shingle of their prefixes, whatever is frequent."""
    rng = np.random.default_rng(5)
    for n in range(1, 60):
        for _ in range(20):
            common = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
            sets = [np.unique(np.r_[common, rng.integers(0, 2**63, int(rng.integers(0, n // 4 + 1)), dtype=np.uint64)]) for _ in range(2)]
            shared = len(np.intersect1d(*sets))
            frequent = np.sort(rng.permutation(common)[: int(rng.integers(0, n + 1))])
            if shared >= 0.8 * (len(sets[0]) + len(sets[1]) - shared):
                assert len(np.intersect1d(*(nearcopies.prefix(s, frequent, 0.8) for s in sets)))


# -- co-training --------------------------------------------------------------------------------


def test_every_unlabelled_document_can_teach(spark, monkeypatch):
    """The one sure document stands behind thousands of others in any order by hash, and is handed on all the same."""
    rng = random.Random(1)
    plain = " ".join(rng.choice(["aa", "bb", "cc"]) for _ in range(20))
    ids = spark.range(10, 6010).select("id").orderBy(F.xxhash64("id"), "id").collect()
    last = ids[-1]["id"]
    good, bad = "Clean prose, word by word. " * 5, "$$$ ### !!! " * 9
    rows = [(i, good if i % 2 else bad, "src", "en", 10) for i in range(10)]
    rows += [(r["id"], good if r["id"] == last else plain, "src", "en", 10) for r in ids]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long")
    labels = spark.createDataFrame([(i, i % 2) for i in range(10)], "doc_id long, quality int")
    seen = {}

    def spy(a, b, y, surest, **how):
        line = cotraining.logistic(a, y)
        seen["taught"] = surest(line, cotraining.logistic(b, y))
        return cotraining.Views(line, line, line)

    monkeypatch.setattr(cotraining, "teach", spy)
    cotraining.fit(docs, labels, share=0.0001, sure=0.5)
    (ids_, content, meta, y), _ = seen["taught"]
    assert y[ids_.index(last)] == 1.0 and ids_.count(last) == 1 and len(content) == len(meta) == len(ids_)


def test_surest_like_brute_force():
    rng = np.random.default_rng(0)
    for scores in (rng.random(5000), rng.beta(0.2, 0.2, 5000), np.full(50, 0.95), np.zeros(0), np.array([0.5])):
        counts = np.bincount(np.minimum((scores * cotraining.BINS).astype(int), cotraining.BINS - 1), minlength=cotraining.BINS)
        high, low = cotraining.cuts(counts, 0.05, 0.9)
        most = max(1, int(0.05 * len(scores)))
        order = np.sort(scores)
        for k, kept in ((high, order[::-1]), (low, order)):
            place = np.minimum((kept * cotraining.BINS).astype(int), cotraining.BINS - 1)
            chosen = place >= k if k == high else place <= k
            sure = kept >= 0.9 if k == high else kept < 0.1
            # all of the surest share that are sure, and of others at most those of the bin at the cut
            assert chosen[:most][sure[:most]].all() and not (chosen & ~sure & (np.abs(kept - 0.5) < 0.39)).any()
            assert (chosen.sum() - most <= np.sum(place == k)) if chosen.any() else True


# -- licenses -----------------------------------------------------------------------------------


def test_reduction_decides_between_templates(monkeypatch):
    """Both templates are within the allowed differences; the one that saves more bytes is the notice."""
    mine = "This license lets everyone copy share and change the enclosed collection of maps for any purpose they like without paying anybody anything"
    other = mine.replace("maps", "charts")
    for table in ({"charts": (other,), "maps": (mine,)}, {"maps": (mine,), "charts": (other,)}):
        scanner = licenses.Scanner(table)
        assert [n["license"] for n in scanner.scan(f"Read this. {mine}. The end.")[1]] == ["maps"]
        assert [n["license"] for n in scanner.scan(f"Read this. {other}. The end.")[1]] == ["charts"]
        # with sizes that tell nothing the first template of the table wins
        monkeypatch.setattr(licenses.Scanner, "saved", lambda self, at, words: (10, 0.5))
        assert [n["license"] for n in scanner.scan(f"Read this. {mine}. The end.")[1]] == [next(iter(table))]
        monkeypatch.undo()
        # and where nothing is saved nothing is found
        monkeypatch.setattr(licenses.Scanner, "saved", lambda self, at, words: (0, 0.0))
        assert scanner.scan(f"Read this. {mine}. The end.")[1] == []
        monkeypatch.undo()


def test_ranking_like_brute_force():
    """Winners are ranked by the bytes that compression saves, over all templates and windows around the cue."""
    import zstandard

    scanner = licenses.Scanner()
    for name, texts in licenses.TEMPLATES.items():
        words = licenses.TOKEN.findall(f"some words first and then {texts[-1].lower()} and some words at the end of it")
        cue = 5 + scanner.templates[[t.words for t in scanner.templates].index(tuple(licenses.TOKEN.findall(texts[-1].lower())))].cues[0]
        ranks = scanner.ranked(words, cue)
        want = []
        for at, t in enumerate(scanner.templates):
            given = zstandard.ZstdCompressor(level=3, write_checksum=False, write_content_size=False, dict_data=zstandard.ZstdCompressionDict(t.raw + b" " + t.raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT))
            none = zstandard.ZstdCompressor(level=3, write_checksum=False, write_content_size=False)
            for place in t.cues:
                start = max(0, cue - place)
                part = " ".join(words[start : start + len(t.words)]).encode()
                sizes = len(none.compress(part)), len(given.compress(part))
                if 1 - sizes[1] / sizes[0] >= scanner.ratio:
                    want.append((sizes[1] - sizes[0], at, start))
        assert ranks == sorted(want) and scanner.best(words, cue)[0].license == name


# -- personal data ------------------------------------------------------------------------------


def test_replaced_spans_like_brute_force(spark):
    rng = random.Random(5)
    rows = []
    for k in range(60):
        text = "".join(rng.choice("aB é😀\n.") for _ in range(rng.choice([0, 5, 40, 3000, 7000])))
        spans = sorted((s, rng.randint(0, 4), min(len(text), s + rng.choice([1, 3, 9, 900, 5000]))) for s in (rng.randrange(len(text)) for _ in range(rng.choice([0, 1, 3, 300]))) ) if text else []
        rows.append((k, text, [dict(zip(("start", "kind", "end"), s, strict=True)) for s in spans]))
    df = spark.createDataFrame(rows, "k long, text string, spans array<struct<start:bigint,kind:int,end:bigint>>")
    privacy._room(df)
    got = {r["k"]: r for r in df.select("k", privacy.blanked(F.col("text"), F.col("spans")).alias("b"), privacy.masked(F.col("text"), F.col("spans")).alias("m")).collect()}
    for k, text, spans in rows:
        blank, out, at = list(text), [], 0
        for s in spans:
            blank[s["start"] : s["end"]] = " " * (s["end"] - s["start"])
            if s["start"] >= at:
                initial = text[s["start"]]
                out += [text[at : s["start"]], f"[{privacy.KINDS[s['kind']].name.upper()}]" if s["kind"] < 4 else "[NAME]" if initial.isupper() else ""]
            at = max(at, s["end"])
        assert got[k]["b"] == "".join(blank) and got[k]["m"] == "".join(out) + text[at:]


def test_a_long_list_of_addresses(spark):
    n = 200_000
    df = spark.createDataFrame([(1, "".join(f"user{i}@mail{i % 97}.org, " for i in range(n))), (2, "x")], "doc_id long, text string")
    start = time.perf_counter()
    got = {r["doc_id"]: r["text"] for r in privacy.sanitised(df).collect()}
    assert got == {1: "[EMAIL], " * n, 2: "x"} and time.perf_counter() - start < 60


def test_terms_like_brute_force(spark):
    """Terms of a small corpus by counts over all documents, their logarithms taken as defined."""
    rng = random.Random(9)
    names = ["Arda", "Belo", "Cyra", "Dovi", "Emin"]
    words = "alpha beta gamma delta epsilon zeta".split()
    texts = []
    for _ in range(80):
        who = rng.sample(names, rng.choice([0, 1, 1, 2]))
        body = [rng.choice(words) for _ in range(6)] + who + [f"{n.lower()}@x.org" for n in who if rng.random() < 0.8]
        rng.shuffle(body)
        texts.append(" ".join(body))
    docs = list(enumerate(texts))
    got = {r["doc_id"]: {s for s in r["spans"].split(",") if s.startswith("term")} for r in privacy.found(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    mail = re.compile(r"[a-z]+@x\.org")
    entities = [set(mail.findall(t)) for t in texts]
    inside = [{w for w in re.findall(r"[^\W\d_]{3,}", mail.sub(lambda m: " " * len(m.group()), t.lower()))} for t in texts]
    everywhere = [{w for w in re.split(r"[^a-z]+", t.lower()) if len(w) >= 3} for t in texts]
    n, reveal = len(texts), set()
    for e in set().union(*entities):
        of = [i for i in range(n) if e in entities[i]]
        if len({texts[i] for i in of}) < 2:
            continue
        told = np.log2(n / len(of))
        for t in set().union(*(inside[i] for i in of)):
            both, n_term = [i for i in of if t in inside[i]], sum(t in w for w in everywhere)
            shared = np.log2(len(both) * n / (len(of) * n_term))
            if len({texts[i] for i in both}) >= 2 and shared >= told - 1 and shared >= told / 2:
                reveal.add((e, t))
    for i, text in docs:
        bare = mail.sub(lambda m: " " * len(m.group()), text.lower())
        terms = {t for e, t in reveal if e in entities[i] and t in inside[i]}
        assert got[i] == {f"term:{m.start()}:{m.end()}" for m in re.finditer(r"[a-z]{3,}", bare) if m.group() in terms}
    assert any(got.values()) and len(reveal) >= 3


# -- toxicity -----------------------------------------------------------------------------------


def test_a_text_that_does_not_fit_is_left_out_alone(spark):
    rows = [(i, "nasty vile words here" if i % 2 else "kind calm words here", "en") for i in range(200)] + [(1000 + i, "long " * 5000, "en") for i in range(20)]
    labels = [(i, i % 2) for i in range(200)] + [(1000 + i, 0) for i in range(20)]
    docs, known = spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    net = toxicity.fit(docs, known, chars=10_000, least_steps=200)
    got = {r["doc_id"]: r["score"] for r in toxicity.scored(docs, net).where("doc_id < 2").collect()}
    assert got[1] > 0.8 > 0.2 > got[0]


def test_every_labelled_document_teaches(spark):
    """A word of three documents among thousands is learned, whatever a task holds at once; thresholds count all that are set aside."""
    rng = np.random.default_rng(2)
    name = lambda x: "".join(chr(97 + x // 26**k % 26) for k in range(3))
    words = lambda i: [name(x) for x in rng.integers(0, 300, 12)] + (["vile" + name(i // 8 % 100)] if i % 8 == 0 else [])
    rows = [(i, " ".join(words(i)), "en") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(8)
    known = spark.createDataFrame([(i, int(i % 8 == 0)) for i in range(4000)], "doc_id long, toxic int")
    net = toxicity.fit(docs, known, rows=200)
    taught = [t for i, t, _ in rows if i % 8 == 0 and zlib.crc32(str(i).encode()) % 4 != 2 and zlib.crc32(f"check {i}".encode()) % 5]
    used = [toxicity.pair(t.split()[-1].encode())[0] for t in taught]
    assert {h for h in used if used.count(h) >= 3} <= set(net.seen.tolist())
    got = toxicity.scored(docs, net).collect()
    assert sum((r["score"] >= 0.3) != (r["doc_id"] % 8 == 0) for r in got) <= 8 and net.thresholds


def test_scores_like_brute_force():
    rng = np.random.default_rng(4)
    seen = np.sort(rng.choice(toxicity.HASHES, 50, replace=False)).astype(np.int64)
    e, f = toxicity.EMBEDDING, toxicity.FILTERS
    vectors = np.r_[np.zeros((1, e)), rng.normal(size=(50, e))]
    filters = [rng.normal(size=(w * e, f)) for w in toxicity.WIDTHS]
    offsets = [rng.normal(size=f) for _ in toxicity.WIDTHS]
    weights = rng.normal(size=f * len(toxicity.WIDTHS))
    net = toxicity.Network(seen, vectors, filters, offsets, weights, 0.3)
    documents = [rng.integers(0, 51, (n, 2)) for n in (0, 1, 2, 7, 40)]
    for rows, got in zip(documents, net.score(documents), strict=True):
        words = np.r_[vectors[rows].sum(axis=1).reshape(-1, e), np.zeros((3, e))]
        peaks = []
        for w, g, b in zip(toxicity.WIDTHS, filters, offsets, strict=True):
            maps = [words[k : k + w].reshape(-1) @ g + b for k in range(max(len(rows), 1))]
            peaks.append(np.maximum(np.max(maps, axis=0), 0))
        assert got == pytest.approx(1 / (1 + np.exp(-(np.concatenate(peaks) @ weights + 0.3))))


# -- mixing -------------------------------------------------------------------------------------


def test_order_of_a_mix(spark):
    """Rows come in the order of their finish times, worked out anew here."""
    rng = random.Random(6)
    rows = [(i, rng.choice("aaab") if i else None, "w " * rng.randint(0, 9)) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(4)
    plan = {r["doc_id"]: r.asDict() for r in mixing.taken_words(docs).collect()}
    import hashlib

    queue = defaultdict(list)
    for i, source, _ in rows:
        queue[source].append((hashlib.md5(f"mix:{i}".encode()).hexdigest()[:16], i))
    order, finish = [], []
    names = sorted((s for s in queue if s), key=str.encode) + [None]
    for rank, source in enumerate(names):
        for epoch in range(3):
            upto = epoch * sum(plan[i]["size"] for _, i in queue[source])
            for _, i in sorted(queue[source]):
                upto += plan[i]["size"]
                if plan[i]["size"]:
                    finish.append((upto / plan[i]["target"], rank, i))
    left = {i: p["taken"] // max(p["size"], 1) for i, p in plan.items()}
    for _, _, i in sorted(finish):
        if left[i]:
            order.append(i)
            left[i] -= 1
    assert [r["doc_id"] for r in mixing.mixed(docs, ordered=True).collect()] == order


# -- sharding -----------------------------------------------------------------------------------


def brute_leaves(units, n_axes, shards):
    """The tree by sorting every cell: cut at the key that brings the left side nearest to its share, along the widest axis."""
    keys = [[u[1 + k] << sharding.TIE_BITS | u[-1] for k in range(n_axes)] for u in units]
    scale = [max(max(u[1 + k] for u in units) - min(u[1 + k] for u in units), 1) for k in range(n_axes)]
    out = {}

    def split(inside, first, count):
        if count == 1 or not inside:
            out.update(dict.fromkeys(inside, first))
            return
        wide = [(max(units[i][1 + k] for i in inside) - min(units[i][1 + k] for i in inside)) / scale[k] for k in range(n_axes)]
        axis, left = max(range(n_axes), key=lambda k: (wide[k], -k)), (count + 1) // 2
        goal, upto, cut = sum(units[i][0] for i in inside) * left / count, 0, None
        for key in sorted({keys[i][axis] for i in inside}):
            before, upto = upto, upto + sum(units[i][0] for i in inside if keys[i][axis] == key)
            if upto >= goal:
                cut = key if upto - goal <= goal - before else key - 1
                break
        split([i for i in inside if keys[i][axis] <= cut], first, left)
        split([i for i in inside if keys[i][axis] > cut], first + left, count - left)

    split(list(range(len(units))), 0, shards)
    return out


@pytest.mark.parametrize("shards", [1, 2, 7, 16])
def test_tree_like_brute_force(spark, shards):
    rng = random.Random(shards)
    units = [(rng.choice([1, 5, 900]), rng.randrange(1 << 16), rng.choice([3, 40_000, 65_000]), rng.choice([7, 9]), rng.randrange(1 << 24)) for _ in range(500)]
    units += [(50, 1234, 3, 7, rng.randrange(1 << 24)) for _ in range(250)]  # a third shares one place on every axis
    df = spark.createDataFrame([(i, *u) for i, u in enumerate(units)], "i long, bytes long, a long, b long, c long, _tie long")
    got = {r["i"]: r["shard"] for r in sharding.leaves(df, ["a", "b", "c"], shards).collect()}
    assert got == brute_leaves(units, 3, shards)


def test_common_passages_give_no_squares(spark):
    """Texts that share a passage meet under its shingles; only those that can be alike give rows, one a pair, and none is missing."""
    rng = random.Random(5)
    passage = " ".join(f"c{i}" for i in range(30))
    texts = [" ".join(f"w{rng.random()}" for _ in range(70)) for _ in range(200)]
    texts += [" ".join(["z", *t.split()[:-5]]) for t in texts[:10]]
    docs = spark.createDataFrame([(i, f"{passage} {t}") for i, t in enumerate(texts)], "doc_id long, _text string").withColumn("_t", F.xxhash64("_text"))
    shared = nearcopies.shared_shingles(docs.select("_text", "_t"), np.zeros(0, np.uint64), 0.8)
    assert shared.groupBy("key").count().agg(F.max("count")).first()[0] == len(texts)
    roots = spark.createDataFrame([], "node long, root long")
    pairs = nearcopies.prefix_pairs(shared, roots, nearcopies.sketches(docs, "_text", ["_t"]), 0.8)
    sets = {r["_t"]: set(nearcopies.shingle_set(nearcopies.shingle_hashes(r["_text"])).tolist()) for r in docs.collect()}
    alike = {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    found = [tuple(r) for r in pairs.collect()]
    assert len(alike) == 10 and alike <= set(found) and len(found) == len(set(found)) < len(texts)


def test_long_texts_that_share_a_line_give_no_pairs(spark):
    """Long texts with a line in common are told apart where they meet; near copies are found whatever the sizes of their maps."""
    rng = random.Random(6)
    line = " ".join(f"c{i}" for i in range(9))
    texts = [" ".join(f"w{rng.random()}" for _ in range(rng.randrange(3300, 5000))).split() for _ in range(40)]
    texts += [t[: round(len(t) * share)] for t, share in zip(texts[:12], [0.81, 0.85, 0.9, 0.99] * 3, strict=True)]
    texts += [["z", *t[:2000], "y", *t[2000:]] for t in texts[:6]]
    docs = spark.createDataFrame([(i, f"{line} {' '.join(t)}") for i, t in enumerate(texts)], "doc_id long, _text string").withColumn("_t", F.xxhash64("_text"))
    sets = {r["_t"]: set(nearcopies.shingle_set(nearcopies.shingle_hashes(r["_text"])).tolist()) for r in docs.collect()}
    alike = {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    assert len({len(nearcopies.parities(np.array(sorted(s), np.uint64))) for s in sets.values()}) > 1
    # the line first in the order of shingles, so that all texts meet under it
    shown = nearcopies.shared_shingles(docs.select("_text", "_t"), np.unique(np.array([x for s in sets.values() for x in s - _line(line)], np.uint64)), 0.8)
    assert shown.groupBy("key").count().agg(F.max("count")).first()[0] == len(texts)
    roots = spark.createDataFrame([], "node long, root long")
    found = [tuple(r) for r in nearcopies.prefix_pairs(shown, roots, nearcopies.sketches(docs, "_text", ["_t"]), 0.8).collect()]
    assert len(alike) >= 18 and alike <= set(found) and len(found) == len(set(found)) < len(texts)


def _line(line):
    return set(nearcopies.shingle_set(nearcopies.shingle_hashes(line)).tolist())


def test_partners_are_kept_where_sets_first_meet():
    """Whatever two sets of the similarity share first keeps both, also among rows of others."""
    rng = np.random.default_rng(8)
    none, kept = np.zeros(0, np.uint64), 0
    for _ in range(60):
        base = np.unique(rng.integers(0, 2**64, 60, np.uint64))
        sets = [np.unique(np.r_[base[rng.random(len(base)) < share], rng.integers(0, 2**64, 5, np.uint64)]) for share in (0.7, 0.9, 0.95, 1.0)]
        rows = sorted((int(k), len(s), len(s) - at, i) for i, s in enumerate(sets) for at, k in enumerate(nearcopies.prefix(s, none, 0.8)))
        key, n, rest = (np.array([r[c] for r in rows], np.uint64 if c == 0 else np.int64) for c in range(3))
        good = nearcopies._partnered(key, n, rest, 0.8)
        left = [{r[0] for r, ok in zip(rows, good, strict=True) if ok and r[3] == i} for i in range(len(sets))]
        for i, j in ((i, j) for i in range(len(sets)) for j in range(i)):
            shared = len(np.intersect1d(sets[i], sets[j]))
            if shared >= 0.8 * (len(sets[i]) + len(sets[j]) - shared):
                kept += 1
                assert min(sets[i][np.isin(sets[i], sets[j])]) in left[i] & left[j]
    assert kept > 60


def test_parities_differ_no_more_than_sets():
    rng = np.random.default_rng(3)
    for n in (0, 1, 7, 300, 3000):
        both = rng.integers(0, 2**64, n, np.uint64)
        a, b = (np.unique(np.r_[both, rng.integers(0, 2**64, n // 10, np.uint64)]) for _ in range(2))
        maps = [np.frombuffer(nearcopies.parities(x), np.uint64) for x in (a, b)]
        assert np.bitwise_count(maps[0] ^ maps[1]).sum() <= len(np.setxor1d(a, b))
