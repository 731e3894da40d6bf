"""Near copies by SimHash and, beyond its radius, by exact similarity of word shingles.

Fingerprints that differ in few bits find copies and texts with hardly a change (``simhash``). Four of 64 bits reach only texts with a
similarity above some 0.95, and a radius that reaches 0.8 leaves segments too short to tell texts apart. So candidates come from a second
source too: the least hashes of a text's shingle set in several bands, equal where sets are alike. All candidates are checked on their
whole shingle sets; what passes is an edge of the components.

Both sources can miss a pair, so a third one, which cannot, looks at texts that are still in different components. Under one order of all
shingles, two sets of the similarity share one of the first shingles of each (its prefix): texts that do are checked as well.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batchwise, written
from .components import components
from .simhash import fingerprint_of, links, one_of_each, shingle_hashes, text_digest

#: bands, and least hashes that have to agree within one: sets of similarity 0.8 share a band in 99 of 100 cases
BANDS, ROWS = 14, 5
#: pairs of one text that are checked together
PAIRS = 500
#: share of least hashes that agree, below which two texts of a band are no candidates
ALIKE = 0.6
#: texts in which frequent shingles are looked for, and in how many of them one is frequent; they only order shingles, any order is exact
LOOKED, FREQUENT = 16_384, 3
#: bits of a text's parity map, at least: each shingle of its set turns one of them, and a bit stands for no more than two shingles
BITS = 1024
#: texts that share a shingle, of which each looks at all others before any goes on
FEW = 16
#: first keys of a text that its rows carry: two texts that share one of them have met there before
FIRST = 8
#: what rounding may add to a product of a similarity and a size
_EPS = 1e-9
#: candidates of a task that are given on at once
OUT = 100_000
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _parameters() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(11)
    return rng.integers(1, 2**63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1), rng.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Hashes spread anew."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


def shingle_set(hashes: np.ndarray) -> np.ndarray:
    """The set of five-word shingles of a text, from the hashes of its four-word ones: two in a row are five words."""
    if len(hashes) > 1:
        hashes = mixed(hashes[:-1] * _MIX + hashes[1:])
    return np.unique(hashes)


def least_hashes(found: np.ndarray) -> np.ndarray:
    """For each of the hash functions the least value over a set, in 32 bits."""
    a, b = _parameters()
    out = np.full(len(a), 0xFFFFFFFF, np.uint64)
    for at in range(0, len(found), 4096):
        part = (found[at : at + 4096, None] * a + b) >> np.uint64(32)
        out = np.minimum(out, part.min(axis=0))
    return out.astype(np.uint32)


def parities(found: np.ndarray) -> bytes:
    """A bit map in which each shingle of a set turns one bit: two maps differ in no more bits than the sets differ in shingles.

    Larger sets have maps of more bits (a power of two), which can be ``folded`` to those of a smaller one.
    """
    bits = max(BITS, 1 << (max(len(found) - 1, 1) // 2).bit_length())
    turned = np.bincount((found % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(turned.astype(np.uint8)).tobytes()


def folded(maps: np.ndarray) -> np.ndarray:
    """Rows of maps as those of half as many bits."""
    half = maps.shape[1] // 2
    return maps[:, :half] ^ maps[:, half:]


def most_apart(sizes, similarity: float):
    """Shingles that are in one only of two sets of the similarity, at most; ``sizes`` is the sum of both."""
    return np.floor((1 - similarity) / (1 + similarity) * sizes + _EPS)


def can_share(n, rest, other_n, other_rest, similarity: float):
    """Whether two sets can have the similarity that share no shingle before the ones from which on ``rest`` and ``other_rest`` are left."""
    return np.minimum(rest, other_rest) >= np.ceil(similarity / (1 + similarity) * (n + other_n) - _EPS)


def frequent_shingles(texts: DataFrame, looked: int = LOOKED) -> np.ndarray:
    """Shingles that are in many texts, sorted, as about ``looked`` of the texts (``_text``, ``_t``) show. They come last in the order of
    shingles, which keeps what many texts share out of their prefixes."""
    step = max(1, texts.count() // looked)
    some = texts.where(F.pmod("_t", F.lit(step)) == 0).dropDuplicates(["_t"])

    def sets(values):
        return [[shingle_set(shingle_hashes(t or "")).view(np.int64).tolist() for t in values]]

    own = batchwise(some, ["_text"], "`_set` array<bigint>", lambda: sets, ["_t"]).select(F.explode("_set").alias("key"))
    found = own.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= FREQUENT).select("key").toArrow()
    return np.sort(found.column("key").to_numpy().astype(np.int64).view(np.uint64))


def prefix_size(n, similarity: float):
    """Shingles of a prefix: so many that two sets of the similarity cannot share shingles without sharing one of these."""
    return n - np.ceil(similarity * n - _EPS).astype(np.int64) + 1


def prefix(found: np.ndarray, frequent: np.ndarray, similarity: float) -> np.ndarray:
    """The first shingles of a sorted set in the order of all shingles: those that are not frequent, then the others, each by value."""
    if not len(found):
        return found
    last = np.zeros(len(found), bool)
    if len(frequent):
        last = frequent[np.minimum(np.searchsorted(frequent, found), len(frequent) - 1)] == found
    return np.concatenate([found[~last], found[last]])[: int(prefix_size(np.int64(len(found)), similarity))]


def sketches(docs: DataFrame, text: str, keep: Sequence[str]) -> DataFrame:
    """``_fp``, ``_least`` (packed least hashes), ``_bands`` (a key per band; none for a text without words) and ``_parity`` of every whole text."""

    def run(texts):
        fps, least, bands, parity = [], [], [], []
        weights = np.array([pow(0x100000001B3, k, 2**64) for k in range(ROWS)], np.uint64)
        for value in texts:
            hashes = shingle_hashes(value or "")
            fps.append(int(np.uint64(fingerprint_of(hashes)).view(np.int64)))
            found = shingle_set(hashes)
            parity.append(parities(found))
            if not len(hashes):
                least.append(b"")
                bands.append([])
                continue
            own = least_hashes(found)
            keys = mixed((own.reshape(BANDS, ROWS).astype(np.uint64) * weights).sum(axis=1) + np.arange(BANDS, dtype=np.uint64))
            least.append(own.tobytes())
            bands.append(keys.view(np.int64).tolist())
        return [fps, least, bands, parity]

    return batchwise(docs, [text], "`_fp` bigint, `_least` binary, `_bands` array<bigint>, `_parity` binary", lambda: run, keep)


def grown(least: np.ndarray, share: float = ALIKE) -> tuple[np.ndarray, np.ndarray]:
    """Places of pairs that hold together what is alike within one band, fewer than texts: each reached text looks once at the rest."""
    left, right = [], []
    rest = np.arange(len(least))
    while len(rest) > 1:
        todo, rest = [rest[0]], rest[1:]
        while todo and len(rest):
            x = todo.pop()
            near = (least[rest] == least[x]).mean(axis=1) >= share
            got = rest[near]
            left.append(np.full(len(got), x))
            right.append(got)
            todo.extend(got.tolist())
            rest = rest[~near]
    none = np.zeros(0, int)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def band_pairs(texts: DataFrame) -> DataFrame:
    """Candidates ``a, b`` (digests of texts) from texts that share a band: rows of a band stream by, sorted by its key."""
    index = texts.select(F.explode("_bands").alias("key"), "_t")
    # most keys stand alone; of the others the least hashes travel
    shared = index.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    met = index.join(shared, "key", "left_semi").join(texts.select("_t", "_least"), "_t")
    dealt = met.repartition("key").sortWithinPartitions("key", "_t")

    def run(batches):
        key, ids, least = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, BANDS * ROWS), np.uint32)

        def pairs(upto: int):
            cuts = np.flatnonzero(np.r_[True, key[1:upto] != key[: upto - 1]]) if upto else np.zeros(0, int)
            found = []
            for at, end in zip(cuts, np.r_[cuts[1:], upto], strict=True):
                i, j = grown(least[at:end])
                found.append((ids[at + i], ids[at + j]))
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, np.int64), *c])) for c in zip(*found, strict=True)], names=["a", "b"]) if found else None

        for batch in batches:
            if not batch.num_rows:
                continue
            key, ids = np.r_[key, batch.column(0).to_numpy()], np.r_[ids, batch.column(1).to_numpy()]
            rows = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint32).reshape(-1, BANDS * ROWS)
            least = np.concatenate([least, rows])
            last = np.flatnonzero(key != key[-1])
            upto = int(last[-1]) + 1 if len(last) else 0
            if (found := pairs(upto)) is not None:
                yield found
            key, ids, least = key[upto:], ids[upto:], least[upto:]
        if (found := pairs(len(key))) is not None:
            yield found

    return dealt.select("key", "_t", "_least").mapInArrow(run, "a bigint, b bigint")


def _grouped(batches):
    """Sorted rows as whole-number arrays, a row of each per column, and the last column as objects if it holds bytes; equal values of
    the first column come together."""
    waiting = []

    def joined():
        return np.concatenate([w[0] for w in waiting], axis=1), np.concatenate([w[1] for w in waiting])

    for batch in batches:
        if not batch.num_rows:
            continue
        columns, maps = list(batch.columns), np.zeros(batch.num_rows, object)
        if pa.types.is_binary(columns[-1].type):
            maps[:] = columns.pop().to_pylist()
        part = np.stack([c.to_numpy().astype(np.int64) for c in columns])
        last = np.flatnonzero(part[0] != part[0, -1])
        if not len(last) and (not waiting or waiting[0][0][0, 0] == part[0, 0]):
            waiting.append((part, maps))
            continue
        upto = int(last[-1]) + 1 if len(last) else 0
        waiting.append((part[:, :upto], maps[:upto]))
        yield joined()
        waiting = [(part[:, upto:], maps[upto:])]
    if waiting:
        yield joined()


def _partnered(key: np.ndarray, n: np.ndarray, rest: np.ndarray, similarity: float) -> np.ndarray:
    """Which rows, sorted by key and then by size, have one under their key that they can be alike with; of more than ``FEW`` rows all do."""
    new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    sizes = np.diff(np.r_[new, len(key)])
    many = np.repeat(sizes > FEW, sizes)
    good, i = many.copy(), np.flatnonzero(~many)
    for step in range(1, FEW):
        i = i[i + step < len(key)]
        i = i[(key[i] == key[i + step]) & (n[i + step] <= n[i] / similarity + _EPS)]
        met = i[can_share(n[i], rest[i], n[i + step], rest[i + step], similarity)]
        good[met] = good[met + step] = True
    return good


def shared_shingles(texts: DataFrame, frequent: np.ndarray, similarity: float) -> DataFrame:
    """``key, _t, _n, _rest``: the shingles that are in the prefixes of several different texts (``_text``, ``_t``), the size of each one's
    set, and how many of its shingles are not before this one. Where few texts share one, those that can be alike with none of them at
    it are left out: the first shingle that two sets of the similarity share keeps both."""

    def firsts(values):
        sets = [shingle_set(shingle_hashes(t or "")) for t in values]
        return [[prefix(s, frequent, similarity).view(np.int64).tolist() for s in sets], [len(s) for s in sets]]

    own = batchwise(texts, ["_text"], "`_prefix` array<bigint>, `_n` int", lambda: firsts, ["_t"])
    each = own.select("_t", "_n", F.posexplode("_prefix").alias("_at", "key")).select("key", "_t", "_n", (F.col("_n") - F.col("_at")).alias("_rest"))
    dealt = each.repartition("key").sortWithinPartitions("key", "_n", "_t")

    def run(batches):
        for rows, _ in _grouped(batches):
            # copies are one text
            rows = rows[:, np.r_[True, (rows[:2, 1:] != rows[:2, :-1]).any(axis=0)]]
            same = rows[0, 1:] == rows[0, :-1]
            rows = rows[:, np.r_[False, same] | np.r_[same, False]]
            if rows.shape[1]:
                rows = rows[:, _partnered(rows[0], rows[2], rows[3], similarity)]
            if rows.shape[1]:
                yield pa.RecordBatch.from_arrays([pa.array(r) for r in rows], names=["key", "_t", "_n", "_rest"])

    return dealt.mapInArrow(run, "key bigint, _t bigint, _n bigint, _rest bigint")


def prefix_pairs(shared: DataFrame, roots: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Candidates ``a, b`` from ``shared_shingles``: all pairs of texts in different components that can have the similarity.

    Texts whose parity maps (``_t``, ``_parity`` of ``texts``) differ in more bits than sets of the similarity can in shingles are left
    out where they meet, so what many texts share does not give rows for all their pairs; nor do those give any that have too few
    shingles left. A pair is not given again under a key when an earlier one is known to be its first. No pair of the similarity is missing.
    """
    placed = shared.join(roots, F.col("_t") == F.col("node"), "left").select("key", "_t", F.coalesce("root", "_t").alias("_root"), "_n", "_rest")

    def several(batches):
        """Rows of the keys that texts of several components have."""
        for rows, _ in _grouped(batches):
            cuts = np.flatnonzero(np.r_[True, rows[0, 1:] != rows[0, :-1]])
            apart = np.minimum.reduceat(rows[2], cuts) != np.maximum.reduceat(rows[2], cuts)
            rows = rows[:, np.repeat(apart, np.diff(np.r_[cuts, rows.shape[1]]))]
            if rows.shape[1]:
                yield pa.RecordBatch.from_arrays([pa.array(r) for r in rows], names=["key", "_t", "_root", "_n", "_rest"])

    apart = placed.repartition("key").sortWithinPartitions("key").mapInArrow(several, "key bigint, _t bigint, _root bigint, _n bigint, _rest bigint")
    apart = written(apart, "apart")
    # in the order of all shingles, which is that of every prefix
    first = apart.groupBy("_t").agg(F.sort_array(F.collect_list(F.struct("_rest", "key")), False)["key"].alias("_first"))
    none = F.lit(np.iinfo(np.int64).max)
    firsts = [F.coalesce(F.get("_first", F.lit(i)), none).alias(f"_first{i}") for i in range(FIRST)]
    mapped = apart.join(texts.select("_t", "_parity"), "_t").join(first, "_t").select("key", "_t", "_root", "_n", "_rest", *firsts, "_parity")
    dealt = mapped.repartition("key").sortWithinPartitions("key", "_n")

    def of_group(key, t, root, n, rest, firsts, maps):
        # by size: texts of the similarity stand close, and maps of one size stand together
        upto = np.searchsorted(n, n / similarity + _EPS, "right")
        size = np.array([len(m) for m in maps])
        starts = np.flatnonzero(np.r_[True, size[1:] != size[:-1]])
        blocks = [(at, end, np.frombuffer(b"".join(maps[at:end]), np.uint64).reshape(end - at, -1)) for at, end in zip(starts, [*starts[1:], len(t)], strict=True)]
        earlier = ~np.logical_or.accumulate(firsts == key, axis=1)
        for (at, end, own), after in zip(blocks, [*blocks[1:], None], strict=True):
            # sets of the similarity have maps of one size, or one twice the other
            if after is not None and after[2].shape[1] == 2 * own.shape[1]:
                own = np.concatenate([own, folded(after[2])])
            for k in range(at, end):
                others = slice(k + 1, min(upto[k], at + len(own)))
                ok = np.flatnonzero((root[others] != root[k]) & can_share(n[k], rest[k], n[others], rest[others], similarity)) + k + 1
                if not len(ok):
                    continue
                differ = np.bitwise_count(own[ok - at] ^ own[k - at]).sum(axis=1, dtype=np.int64)
                ok = ok[differ <= most_apart(n[ok] + n[k], similarity)]
                if len(ok):
                    ok = ok[~(np.isin(firsts[ok], firsts[k]) & earlier[ok]).any(axis=1)]
                    yield np.minimum(t[ok], t[k]), np.maximum(t[ok], t[k])

    def run(batches):
        found, size = [], 0

        def given():
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found, strict=True)], names=["a", "b"])

        for rows, maps in _grouped(batches):
            cuts = np.flatnonzero(np.r_[True, rows[0, 1:] != rows[0, :-1], True])
            for at, end in zip(cuts, cuts[1:], strict=False):
                _, t, root, n, rest = rows[:5, at:end]
                for part in of_group(rows[0, at], t, root, n, rest, np.ascontiguousarray(rows[5:, at:end].T), maps[at:end]):
                    found.append(part)
                    size += len(part[0])
                    if size >= OUT:
                        yield given()
                        found, size = [], 0
        if found:
            yield given()

    return dealt.mapInArrow(run, "a bigint, b bigint").distinct()


def alike(docs: DataFrame, pairs: DataFrame, text: str, similarity: float) -> DataFrame:
    """The pairs of digests whose texts' shingle sets are at least that similar (Jaccard), measured on whole sets."""
    named = pairs.select(F.explode(F.array("a", "b")).alias("_t")).distinct()
    own = docs.select(F.col(f"`{text}`").alias("_text"), text_digest(F.col(f"`{text}`")).alias("_t"))
    once = own.join(named, "_t", "left_semi").dropDuplicates(["_t"])

    def sets(texts):
        return [[shingle_set(shingle_hashes(t or "")).view(np.int64).tolist() for t in texts]]

    found = written(batchwise(once, ["_text"], "`_set` array<bigint>", lambda: sets, ["_t"]), "sets")
    # one text may be compared with very many: its pairs are dealt out, each part with a copy of its set
    parts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PAIRS).cast("int").alias("_parts")).where("_parts > 1")
    part = F.pmod(F.xxhash64("b"), F.coalesce("_parts", F.lit(1))).cast("int")
    dealt = pairs.join(parts, "a", "left").select("a", "b", part.alias("_part"))
    copies = F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))
    first = found.join(parts, F.col("_t") == F.col("a"), "left").select(F.col("_t").alias("a"), F.col("_set").alias("_sa"), copies.alias("_part"))
    second = found.select(F.col("_t").alias("b"), F.col("_set").alias("_sb"))
    both = dealt.join(first, ["a", "_part"]).join(second, "b")

    def run(batches):
        for batch in batches:
            keep = []
            for k in range(batch.num_rows):
                a, b = (batch.column(c)[k].values.to_numpy() for c in ("_sa", "_sb"))
                shared = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(shared >= similarity * (len(a) + len(b) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a bigint, b bigint")


def deduplicated(docs: DataFrame, id_: str = "doc_id", text: str = "text", similarity: float = 0.8, bits: int = 4) -> DataFrame:
    """One row of ``docs`` for each group of near copies: the one with the smallest id, of several such rows one.

    Near copies share at least ``similarity`` of their sets of five-word shingles (lower case of A to Z; shorter texts are one shingle);
    a group is what such pairs connect. Texts without words (null, empty, blank) are one group, a null id is the last to be kept, copies
    and repeated rows are one, long texts count whole. Rows keep their columns, whatever they are called; an empty table gives no rows.
    """
    own = docs.select(F.col(f"`{id_}`").alias("_id"), F.col(f"`{text}`").alias("_text"), text_digest(F.col(f"`{text}`")).alias("_t"))
    marked = written(sketches(own, "_text", ["_id", "_t"]), "sketches")
    texts = written(marked.groupBy("_t").agg(F.first("_fp").alias("_fp"), F.first("_least").alias("_least"), F.first("_bands").alias("_bands"), F.first("_parity").alias("_parity")), "texts")
    # one text stands for all of a fingerprint
    by_fp = written(texts.groupBy("_fp").agg(F.min("_t").alias("_first")), "texts")
    equal = texts.join(by_fp, "_fp").where("_t <> _first").select(F.col("_first").alias("a"), F.col("_t").alias("b"))
    near = links(by_fp.select("_fp"), bits)
    for side in ("a", "b"):
        near = near.join(by_fp.select(F.col("_fp").alias(side), F.col("_first").alias(f"_{side}")), side).drop(side).withColumnRenamed(f"_{side}", side)
    every = equal.unionByName(near).unionByName(band_pairs(texts))
    pairs = written(every.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")
    edges = written(alike(docs, pairs, text, similarity), "edges")
    # then what is still apart: a large group is no longer all its pairs
    shared = written(shared_shingles(own.select("_text", "_t"), frequent_shingles(own), similarity), "shared")
    rest = written(prefix_pairs(shared, components(edges), texts, similarity).join(pairs, ["a", "b"], "left_anti"), "pairs")
    roots = components(edges.unionByName(alike(docs, rest, text, similarity)))
    found = marked.select("_id", "_t").join(roots, marked["_t"] == roots["node"], "left")
    # texts without words are not in the bands; they have one fingerprint, and empty sets are alike
    return one_of_each(docs, found.select("_id", "_t", F.coalesce("root", "_t").alias("_root")), id_, text)
