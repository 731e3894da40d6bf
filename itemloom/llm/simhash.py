"""SimHash near-duplicates: fingerprints of word shingles, linked where few bits differ.

Two fingerprints that differ in at most ``2 s - 2`` bits differ in at most one bit of some of ``s`` segments (four bits: three
segments). Each segment is indexed once per bit, with that bit left out: the variants of two such segments meet in an equality of
keys. Fingerprints under one key are compared, and links that hold become edges of the components.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batchwise, carried, restored, written
from .components import components

#: shingles whose bits are counted at once
CHUNK = 65_536
#: groups up to this size compare all their members; larger ones grow trees
SMALL = 16


def shingle_hashes(text: str, shingle: int = 4, seed: int = 42) -> np.ndarray:
    """XXH64 of all shingles in order, repeats included; none without words."""
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split()  # bytes lower only A to Z and split at space and 9 to 13
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    ends = ends.tolist()
    last = max(len(words) - shingle + 1, 1)
    out = np.empty(last, np.uint64)
    for at in range(0, last, CHUNK):
        to = min(at + CHUNK, last)
        pairs = zip(starts[at:to], ends[at + shingle - 1 : to + shingle - 1] or ends[-1:], strict=True)
        out[at:to] = [xxh64_intdigest(joined[a:b], seed) for a, b in pairs]
    return out


def fingerprint_of(hashes: np.ndarray) -> int:
    """Bit by bit, whether more than half of the hashes have it; no hashes give 0."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), CHUNK):
        part = hashes[at : at + CHUNK].astype("<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: str, shingle: int = 4, seed: int = 42) -> int:
    """Bit by bit, whether more than half of the shingles' XXH64 values have it; no words give 0."""
    return fingerprint_of(shingle_hashes(text, shingle, seed))


def fingerprints(docs: DataFrame, text: str = "text", keep: Sequence[str] | None = None, shingle: int = 4, seed: int = 42) -> DataFrame:
    """``_fp bigint`` (the 64 bits as a signed number) of every whole text; a null text has no words and gives 0."""

    def run(texts):
        return [[int(np.uint64(fingerprint(t or "", shingle, seed)).view(np.int64)) for t in texts]]

    return batchwise(docs, [text], "`_fp` bigint", lambda: run, keep)


def segments(bits: int) -> list[tuple[int, int]]:
    """Start and width of so many segments that ``bits`` differing bits leave one with at most one of them."""
    count = bits // 2 + 1
    edges = [round(64 * i / count) for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def variants(fp: Column, bits: int) -> Column:
    """Every segment once per bit, with that bit left out: ``array<struct<bit, value>>``."""
    keys = []
    for start, width in segments(bits):
        for bit in range(start, start + width):
            mask = ((1 << width) - 1) << start & ~(1 << bit)
            keys.append(F.struct(F.lit(bit).alias("bit"), fp.bitwiseAND(F.lit(_signed(mask))).alias("value")))
    return F.array(*keys)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def first_shared(apart: np.ndarray, bits: int) -> np.ndarray:
    """For each pair's differing bits, the first bit whose variants the two share: there the pair is reported, and only there."""
    found = np.full(len(apart), 64)
    for start, width in reversed(segments(bits)):
        part = apart & np.uint64(((1 << width) - 1) << start)
        ones = np.bitwise_count(part)
        one = np.bitwise_count(np.where(ones == 1, part - np.uint64(1) * (ones == 1), 0)).astype(int)
        found = np.where(ones == 0, start, np.where(ones == 1, one, found))
    return found


def tree(fps: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that join what is linked within one group, fewer than members: each reached member looks once at those not yet reached."""
    left, right = [], []
    rest = fps
    while len(rest):
        todo, rest = [rest[0]], rest[1:]
        while todo and len(rest):
            x = todo.pop()
            near = np.bitwise_count(rest ^ x) <= bits
            if near.any():
                right.append(got := rest[near])
                left.append(np.full(len(got), x))
                todo.extend(got)
                rest = rest[~near]
    empty = np.zeros(0, np.uint64)
    return np.concatenate([empty, *left]), np.concatenate([empty, *right])


def _edges(bit: np.ndarray, value: np.ndarray, fp: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among rows sorted by key, all rows of a key at hand."""
    new = np.flatnonzero(np.r_[True, (bit[1:] != bit[:-1]) | (value[1:] != value[:-1])])
    sizes = np.diff(np.r_[new, len(fp)])
    group = np.repeat(np.arange(len(new)), sizes)
    small = np.repeat(sizes <= SMALL, sizes)
    left, right = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    for step in range(1, min(SMALL, int(sizes.max(initial=1)))):
        i = np.flatnonzero((group[step:] == group[:-step]) & small[:-step])
        apart = fp[i] ^ fp[i + step]
        near = np.bitwise_count(apart) <= bits
        i, apart = i[near], apart[near]
        i = i[first_shared(apart, bits) == bit[i]]
        left.append(fp[i])
        right.append(fp[i + step])
    for at in np.flatnonzero(sizes > SMALL):
        a, b = tree(fp[new[at] : new[at] + sizes[at]], bits)
        left.append(a)
        right.append(b)
    return np.concatenate(left), np.concatenate(right)


def links(distinct: DataFrame, bits: int = 4) -> DataFrame:
    """Edges ``a, b`` between fingerprints (column ``_fp``, each once) that join exactly those linked within ``bits`` bits.

    Small groups under a key give their links, large ones the edges of a tree, so a group of n never gives n squared rows.
    """
    index = distinct.select("_fp", F.explode(variants(F.col("_fp"), bits)).alias("k")).select("k.bit", "k.value", "_fp")
    dealt = index.repartition("bit", "value").sortWithinPartitions("bit", "value", "_fp")

    def run(batches):
        # rows of the last key of a batch wait for the next one
        held = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))
        for batch in batches:
            own = [batch.column(i).to_numpy() for i in range(3)]
            bit, value, fp = (np.concatenate(p) for p in zip(held, (own[0].astype(np.int64), own[1], own[2].view(np.uint64)), strict=True))
            if not len(fp):
                continue
            last = np.flatnonzero((bit != bit[-1]) | (value != value[-1]))
            cut = int(last[-1]) + 1 if len(last) else 0
            yield _batch(*_edges(bit[:cut], value[:cut], fp[:cut], bits))
            held = (bit[cut:], value[cut:], fp[cut:])
        yield _batch(*_edges(*held, bits))

    return dealt.mapInArrow(run, "a bigint, b bigint")


def _batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (a, b)], names=["a", "b"])


def _grouped(docs: DataFrame, id_: str, text: str, bits: int, shingle: int, seed: int) -> DataFrame:
    """Per document: its id, ``_t`` (a digest of its text), ``_fp``, ``_root`` (its component) and ``component_id``."""
    own = docs.select(F.col(f"`{id_}`"), F.col(f"`{text}`"), F.xxhash64(F.col(f"`{text}`")).alias("_t"))
    marked = written(fingerprints(own, text, [id_, "_t"], shingle, seed), "simhash")
    distinct = written(marked.groupBy("_fp").agg(F.min(f"`{id_}`").alias("_least")), "simhash")
    roots = components(links(distinct.select("_fp"), bits))
    by_fp = distinct.join(roots, distinct["_fp"] == roots["node"], "left").select("_fp", "_least", F.coalesce("root", "_fp").alias("_root"))
    least = by_fp.groupBy("_root").agg(F.min("_least").alias("component_id"))
    named = by_fp.join(least, "_root").select(F.col("_fp").alias("_f"), "_root", "component_id")
    return marked.join(named, marked["_fp"] == named["_f"]).drop("_f")


def grouped(docs: DataFrame, id_: str = "doc_id", text: str = "text", bits: int = 4, shingle: int = 4, seed: int = 42) -> DataFrame:
    """Per document: its id, ``fingerprint`` (16 hex digits) and ``component_id``, the smallest id reachable by links, its own included.

    Equal fingerprints are linked, so copies meet before anything is compared, and texts without words (null, empty, blank) link with
    each other by the fingerprint 0. Repeated rows stay; an id that is null is never the smallest, and a component of null ids only
    has none. An empty table gives no rows.
    """
    found = _grouped(docs, id_, text, bits, shingle, seed)
    return found.select(f"`{id_}`", F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, found: DataFrame, id_: str, text: str) -> DataFrame:
    """One row of ``docs`` for each root: the one with the smallest id, then the least digest of its text; of such rows one.

    ``found`` has ``_id``, ``_t`` (the digest) and ``_root`` of every row.
    """
    first = F.min(F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_t").alias("t"))).alias("m")
    kept = written(found.groupBy("_root").agg(first).select(F.col("m.id").alias("_kept"), F.col("m.t").alias("_kept_t")), "kept")
    same = F.col("_id").eqNullSafe(F.col("_kept")) & (F.col("_t") == F.col("_kept_t"))
    rows = carried(docs, _id=F.col(f"`{id_}`"), _t=text_digest(F.col(f"`{text}`"))).join(kept, same, "left_semi")
    twice = found.groupBy("_id", "_t").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if not twice.join(kept, same, "left_semi").isEmpty():
        rows = rows.dropDuplicates(["_id", "_t"])
    return restored(rows, docs.columns)


def text_digest(text: Column) -> Column:
    return F.xxhash64(text)


def deduplicated(docs: DataFrame, id_: str = "doc_id", text: str = "text", bits: int = 4, shingle: int = 4, seed: int = 42) -> DataFrame:
    """One row of ``docs`` for each component: the one with the smallest id, of several such rows one.

    Texts without words (null, empty, blank) are one component, a null id is the last to be kept, copies and repeated rows are one, long
    texts count whole. Rows keep their columns, whatever they are called; an empty table gives no rows.
    """
    found = _grouped(docs, id_, text, bits, shingle, seed).select(F.col(f"`{id_}`").alias("_id"), "_t", "_root")
    return one_of_each(docs, found, id_, text)
