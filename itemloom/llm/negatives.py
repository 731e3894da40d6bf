"""Hard negatives by inner product, over a GNAT-style multiway hyperplane tree.

Vectors become integers, and with one more coordinate that brings all of them to one length, ``|x - q|^2 = M^2 + |q|^2 - 2 q.x``: a
window of scores is an annulus around the anchor. A node of the tree has several split points; a row belongs to the nearest one, and
every split point stores the least and the largest distance to the rows of each of its siblings. A subtree is left out when one of these
ranges shows that it holds nothing inside the anchor's annuli. Leaves are exact: every row left is scored in integers.

The split points are fitted on a bounded sample, the ranges are aggregated over all rows. The same sample gives each anchor a first
bound, as its best rows are rows of the table; it only narrows the annuli. Anchors travel to the leaves they need, once to each block of
rows, and stream by in batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import written

#: rows that split points are fitted on and first bounds are taken from, and the vectors' lengths that get a tree
FIT_ROWS, TREES = 20_000, 64
#: rows of a leaf that is split no further, sample rows it needs at least, split points of a node
LEAF, LEAST, FANOUT = 4_096, 32, 8
#: rows of a block, and scores that are held at once
BLOCK, SCORES = 8_192, 1 << 21
LOW, HIGH = -(1 << 63), (1 << 63) - 1


# -- exact scores -------------------------------------------------------------------------------


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows of two matrices of longs, exact; beyond a long they are its ends."""
    top = [float(np.abs(x.astype(float)).max(initial=0)) for x in (a, b)]
    if top[0] * top[1] * max(a.shape[1], 1) < 2**53:  # sums of doubles are exact
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    whole = a.astype(object) @ b.astype(object).T
    return np.clip(whole, LOW, HIGH).astype(np.int64)


def best(query: np.ndarray, score: np.ndarray, id_: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Places of the rows that stand among the first ``most[query]`` of their query: higher scores first, then smaller ids."""
    order = np.lexsort((id_, ~score, query))  # ~score falls as score rises, and has no overflow
    of = query[order]
    first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]]) if len(of) else np.zeros(0, int)
    rank = np.arange(len(of)) - np.repeat(first, np.diff(np.r_[first, len(of)]))
    return order[rank < most[of]]


@dataclass
class Queries:
    """Anchors with their windows, several to an anchor: ``of`` tells whose a window is, ``tag`` what the caller calls it."""

    id: np.ndarray
    label: np.ndarray
    vector: np.ndarray
    of: np.ndarray
    tag: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def hits(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, same: bool, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ``most`` best rows of each window: window, place of the row, score. Rows of the anchor's own id are left out."""
        found: list[tuple[np.ndarray, ...]] = []
        step = max(1, SCORES // max(len(ids), 1))
        least = np.full(len(self.id), HIGH)
        np.minimum.at(least, self.of, np.where(self.low <= self.high, self.low, HIGH))
        for at in range(0, len(self.id), step):
            upto = min(at + step, len(self.id))
            scores = products(self.vector[at:upto], rows)
            fits = labels[None, :] == self.label[at:upto, None]
            fits = (fits if same else ~fits) & (ids[None, :] != self.id[at:upto, None]) & (scores >= least[at:upto, None])
            q, r = np.nonzero(fits)
            s = scores[q, r]
            start = np.searchsorted(q, np.arange(upto - at + 1))
            mine = np.flatnonzero((self.of >= at) & (self.of < upto))
            for w in mine.tolist():
                k = self.of[w] - at
                part = slice(start[k], start[k + 1])
                inside = np.flatnonzero((s[part] >= self.low[w]) & (s[part] <= self.high[w]))
                if len(inside):
                    own_s, own_r = s[part][inside], r[part][inside]
                    if len(inside) > most:
                        cut = np.partition(own_s, len(own_s) - most)[len(own_s) - most]
                        own_s, own_r = own_s[own_s >= cut], own_r[own_s >= cut]
                    kept = best(np.zeros(len(own_s), int), own_s, ids[own_r], np.array([most]))
                    found.append((np.full(len(kept), w), own_r[kept], own_s[kept]))
        if not found:
            return np.zeros(0, int), np.zeros(0, int), np.zeros(0, np.int64)
        w, r, s = (np.concatenate(part) for part in zip(*found, strict=True))
        return w, r, s


# -- the tree -----------------------------------------------------------------------------------


@dataclass
class Node:
    points: np.ndarray
    rests: np.ndarray
    #: per split point: a node or the number of a leaf
    below: list
    low: np.ndarray = field(default=None)
    high: np.ndarray = field(default=None)


def _distances(x: np.ndarray, rests: np.ndarray, squares: np.ndarray, node: Node, length: float) -> np.ndarray:
    """Distances to the split points; ``squares`` are squared lengths with the coordinate ``rests`` included."""
    near = squares[:, None] + length - 2 * (x @ node.points.T + rests[:, None] * node.rests[None, :])
    return np.sqrt(np.maximum(near, 0))


class Tree:
    """A multiway tree of split points; ``length`` is the square of the length that the last coordinate brings all rows to."""

    def __init__(self, sample: np.ndarray, rows: int, length: float, fanout: int = FANOUT, leaf: int = LEAF, least: int = LEAST, seed: int = 7):
        self.length, self.leaves, self.nodes = length, 0, []
        self._rng = np.random.default_rng(seed)
        #: two distances that differ by less are not told apart
        self.slack = 1e-6 * (np.sqrt(length) + 1)
        share = rows / max(len(sample), 1)
        self.root = self._grown(sample.astype(float), share, fanout, leaf, least, 0)

    def rests(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(self.length - np.einsum("ij,ij->i", x, x), 0))

    def _grown(self, x: np.ndarray, share: float, fanout: int, leaf: int, least: int, depth: int):
        if len(x) * share > leaf and len(x) >= 2 * least and depth < 32:
            # split points far apart: each next one is the farthest from those before, among a few
            few = x[self._rng.permutation(len(x))[: 4 * fanout]]
            chosen, gap = [0], np.full(len(few), np.inf)
            while len(chosen) < fanout:
                gap = np.minimum(gap, ((few - few[chosen[-1]]) ** 2).sum(axis=1))
                if not gap.max() > 0:
                    break
                chosen.append(int(gap.argmax()))
            points = few[chosen]
            node = Node(points, self.rests(points), [])
            near = _distances(x, self.rests(x), np.full(len(x), self.length), node, self.length).argmin(axis=1)
            if len(chosen) > 1 and np.bincount(near).max() < len(x):
                m = len(chosen)
                node.low, node.high = np.full((m, m), np.inf), np.full((m, m), -np.inf)
                self.nodes.append(node)
                node.below = [self._grown(x[near == j], share, fanout, leaf, least, depth + 1) for j in range(m)]
                return node
        self.leaves += 1
        return self.leaves - 1

    def placed(self, rows: np.ndarray, ranges: dict[int, tuple[np.ndarray, np.ndarray]] | None = None) -> np.ndarray:
        """The leaf of every row; ``ranges`` takes up, per node, the least and largest distances met."""
        x = rows.astype(float)
        leaves = np.zeros(len(x), np.int64)
        number = {id(n): k for k, n in enumerate(self.nodes)}
        todo = [(self.root, np.arange(len(x)))]
        rests = self.rests(x)
        squares = np.einsum("ij,ij->i", x, x) + rests**2
        while todo:
            node, at = todo.pop()
            if not isinstance(node, Node):
                leaves[at] = node
                continue
            far = _distances(x[at], rests[at], squares[at], node, self.length)
            near = far.argmin(axis=1)
            if ranges is not None:
                m = len(node.below)
                low, high = ranges.setdefault(number[id(node)], (np.full((m, m), np.inf), np.full((m, m), -np.inf)))
                np.minimum.at(low.T, near, far)
                np.maximum.at(high.T, near, far)
            todo += [(node.below[j], at[near == j]) for j in np.unique(near).tolist()]
        return leaves

    def needed(self, queries: Queries) -> tuple[np.ndarray, np.ndarray]:
        """Which leaves may hold rows of some window of each anchor: places of anchors, and leaves."""
        x = queries.vector.astype(float)
        square = np.einsum("ij,ij->i", x, x)
        outer = np.sqrt(np.maximum(square[queries.of] + self.length - 2 * queries.low.astype(float), 0))
        inner = np.sqrt(np.maximum(square[queries.of] + self.length - 2 * queries.high.astype(float), 0))
        # the row and the column of a rounding error: scores beyond 2**53 are not told apart
        found = [(np.zeros(0, int), np.zeros(0, int))]
        todo = [(self.root, np.flatnonzero(queries.low <= queries.high))]
        zeros = np.zeros(len(x))
        while todo:
            node, windows = todo.pop()
            if not len(windows):
                continue
            if not isinstance(node, Node):
                anchors = np.unique(queries.of[windows])
                found.append((anchors, np.full(len(anchors), node)))
                continue
            anchors, back = np.unique(queries.of[windows], return_inverse=True)
            far = _distances(x[anchors], zeros[anchors], square[anchors], node, self.length)
            least = np.maximum((far[:, :, None] - node.high).max(axis=1), (node.low - far[:, :, None]).max(axis=1))
            most = (far[:, :, None] + node.high).min(axis=1)
            for j, below in enumerate(node.below):
                out = (least[back, j] > outer[windows] + self.slack) | (most[back, j] < inner[windows] - self.slack)
                todo.append((below, windows[~out]))
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


# -- rows and anchors ---------------------------------------------------------------------------


def integers(vectors: DataFrame, id_: str, vector: str, label: str | Column, scale: int) -> DataFrame:
    """``id, label, v, size``: rows that take part, each component as ``floor(scale * x)`` (a long's ends beyond it)."""
    x = F.col(f"`{vector}`")
    sound = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    whole = F.transform(x, lambda e: _floored(e.cast("double") * scale))
    label = F.col(f"`{label}`") if isinstance(label, str) else label
    own = vectors.select(F.col(f"`{id_}`").cast("long").alias("id"), label.cast("long").alias("label"), F.when(sound, whole).alias("v"))
    own = own.where("id is not null and label is not null and v is not null").withColumn("size", F.size("v"))
    return own


def _floored(e: Column) -> Column:
    return F.when(e >= 2.0**63, F.lit(HIGH)).when(e < -(2.0**63), F.lit(LOW)).otherwise(F.floor(e))


def unrepeated(rows: DataFrame) -> DataFrame:
    """Rows with one row per id: of several the one with the least label, then the least vector. Most tables have none of these."""
    twice = rows.groupBy("id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("id")
    if twice.isEmpty():
        return rows
    least = rows.join(twice, "id", "left_semi").groupBy("id").agg(F.min(F.struct("label", "v", "size")).alias("_r"))
    return rows.join(twice, "id", "left_anti").unionByName(least.select("id", "_r.label", "_r.v", "_r.size"))


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, size) if size else np.zeros((len(column), 0), np.int64)


def _by_size(batch: pa.RecordBatch, sizes: np.ndarray) -> Iterator[tuple[int, pa.RecordBatch]]:
    for size in np.unique(sizes).tolist():
        yield size, batch if (sizes == size).all() else batch.filter(pa.array(sizes == size))


@dataclass
class Sample:
    id: np.ndarray
    label: np.ndarray
    v: np.ndarray


class Index:
    """Trees of the common vector lengths (others are one leaf), and every row in its leaf."""

    def __init__(self, rows: DataFrame, fit_rows: int = FIT_ROWS, block: int = BLOCK, **how):
        self.block = block
        norm = F.aggregate("v", F.lit(0.0), lambda t, e: t + e.cast("double") * e.cast("double"))
        facts = rows.groupBy("size").agg(F.count(F.lit(1)).alias("n"), F.max(norm).alias("length")).orderBy(F.desc("n"), "size").limit(TREES).collect()
        total = sum(f["n"] for f in facts)
        # a share of the rows by a digest of the id, so that the sample is drawn without a sort of all of them
        part = min(1.0, 1.2 * fit_rows / max(total, 1))
        drawn = rows.where(F.pmod(F.xxhash64("id"), F.lit(1 << 32)) < int(part * (1 << 32)))
        got = drawn.orderBy(F.xxhash64("id"), "id").limit(fit_rows).toArrow().combine_chunks()
        self.trees: dict[int, Tree] = {}
        self.samples: dict[int, Sample] = {}
        parts = [b for b in got.to_batches() if b.num_rows]
        for f in facts:
            own = [m for b in parts for s, m in _by_size(b, b.column("size").to_numpy()) if s == f["size"]]
            ids, labels = ([m.column(c).to_numpy() for m in own] for c in ("id", "label"))
            v = [_matrix(m.column("v"), f["size"]) for m in own]
            none = np.zeros(0, np.int64)
            sample = Sample(np.concatenate([none, *ids]), np.concatenate([none, *labels]), np.concatenate([np.zeros((0, f["size"]), np.int64), *v]))
            self.samples[f["size"]] = sample
            self.trees[f["size"]] = Tree(sample.v, f["n"], float(f["length"]) * (1 + 1e-12), **how)
        self.rows = self._placed(rows)
        self._ranges()
        blocks = self.rows.groupBy("size", "leaf").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
        self.blocks = written(blocks, "leaves")

    def _placed(self, rows: DataFrame) -> DataFrame:
        trees = self.trees

        def run(batches):
            for batch in batches:
                for size, part in _by_size(batch, batch.column(3).to_numpy()):
                    tree = trees.get(size)
                    leaves = tree.placed(_matrix(part.column(2), size)) if tree else np.zeros(part.num_rows, np.int64)
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(leaves)], names=["id", "label", "v", "size", "leaf"])

        return written(rows.select("id", "label", "v", "size").mapInArrow(run, "id long, label long, v array<long>, size int, leaf long"), "placed")

    def _ranges(self) -> None:
        """Distance ranges of siblings, over all rows: partial ones per task, combined by the shuffle."""
        trees = {s: t for s, t in self.trees.items() if t.nodes}
        if not trees:
            return

        def run(batches):
            met: dict[int, dict] = {s: {} for s in trees}
            for batch in batches:
                for size, part in _by_size(batch, batch.column(1).to_numpy()):
                    if size in trees:
                        trees[size].placed(_matrix(part.column(0), size), met[size])
            for size, ranges in met.items():
                for node, (low, high) in ranges.items():
                    i, j = np.nonzero(np.isfinite(low))
                    k = np.full(len(i), 1)
                    yield pa.RecordBatch.from_pydict({"size": k * size, "node": k * node, "i": i, "j": j, "low": low[i, j], "high": high[i, j]})

        found = self.rows.select("v", "size").mapInArrow(run, "size long, node long, i long, j long, low double, high double")
        for r in found.groupBy("size", "node", "i", "j").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect():
            node = trees[r["size"]].nodes[r["node"]]
            node.low[r["i"], r["j"]], node.high[r["i"], r["j"]] = r["low"], r["high"]

    def search(self, queries: DataFrame, same: bool, most: int) -> DataFrame:
        """``anchor, tag, id, score``: the ``most`` best rows of every window, with ``rank`` from 1.

        ``queries`` has ``id, label, v, size`` and ``windows``, an array of ``tag, low, high``. Only rows of the anchor's label count, or
        (not ``same``) of other labels, and only vectors of its length; rows of the anchor's id never do.
        """
        narrowed = written(self._narrowed(queries, same, most), "anchors")
        dealt = narrowed.join(self.blocks, ["size", "leaf"]).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        rows = self.rows.join(self.blocks.where("blocks > 1"), ["size", "leaf"], "left")
        block = F.pmod(F.xxhash64("id"), F.coalesce("blocks", F.lit(1))).cast("int")
        rows = rows.select("size", "leaf", block.alias("block"), F.lit(0).alias("kind"), "id", "label", "v")
        both = rows.unionByName(dealt.select("size", "leaf", "block", F.lit(1).alias("kind"), "id", "label", "v", "windows"), allowMissingColumns=True)
        sorted_ = both.repartition("size", "leaf", "block").sortWithinPartitions("size", "leaf", "block", "kind")
        found = sorted_.mapInArrow(_scan(same, most), "anchor long, tag long, id long, score long")
        place = F.row_number().over(Window.partitionBy("anchor", "tag").orderBy(F.desc("score"), "id"))
        return found.withColumn("rank", place).where(F.col("rank") <= most)

    def _narrowed(self, queries: DataFrame, same: bool, most: int) -> DataFrame:
        """One row per anchor and leaf it needs, with windows cut at the ``most``-th best row of the sample."""
        trees, samples = self.trees, self.samples
        schema = queries.select("id", "label", "v", "size", "windows").schema.add("leaf", "long")

        def run(batches):
            for batch in batches:
                for size, part in _by_size(batch, batch.column(3).to_numpy()):
                    tree, sample = trees.get(size), samples.get(size)
                    own = asked(part, size)
                    if tree is None:
                        at, leaves, low = np.arange(len(own.id)), np.zeros(len(own.id), np.int64), own.low
                    else:
                        w, _, s = own.hits(sample.id, sample.label, sample.v, same, most)
                        full = np.bincount(w, minlength=len(own.of)) >= most
                        bound = np.full(len(own.of), HIGH)
                        np.minimum.at(bound, w, s)
                        own.low = low = np.where(full, np.maximum(own.low, bound), own.low)
                        at, leaves = tree.needed(own)
                    windows = pa.array([{"tag": t, "low": a, "high": b} for t, a, b in zip(own.tag, low, own.high, strict=True)], _WINDOW)
                    offsets = np.searchsorted(own.of, np.arange(len(own.id) + 1)).astype(np.int32)
                    lists = pa.ListArray.from_arrays(pa.array(offsets), windows)
                    for k in range(0, len(at), 4096):
                        take = pa.array(at[k : k + 4096])
                        columns = [c.take(take) for c in part.columns[:4]]
                        columns += [lists.take(take), pa.array(leaves[k : k + 4096].astype(np.int64))]
                        yield pa.RecordBatch.from_arrays(columns, names=["id", "label", "v", "size", "windows", "leaf"])

        return queries.select("id", "label", "v", "size", "windows").mapInArrow(run, schema)


_WINDOW = pa.struct([("tag", pa.int64()), ("low", pa.int64()), ("high", pa.int64())])
WINDOWS = "array<struct<tag: long, low: long, high: long>>"


def asked(part: pa.RecordBatch, size: int) -> Queries:
    """Anchors of a batch of ``id, label, v, size, windows``."""
    lists = part.column("windows")
    own = lists.flatten()
    counts = np.array([len(x) for x in lists], int)
    columns = [own.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(3)]
    return Queries(part.column("id").to_numpy(), part.column("label").to_numpy(), _matrix(part.column("v"), size), np.repeat(np.arange(len(counts)), counts), *columns)


def _scan(same: bool, most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Reads blocks of rows, each followed by the anchors that need it; a block is held, anchors stream by."""

    def run(batches):
        key, held, block = None, [], None
        for batch in batches:
            keys = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in range(4)], axis=1)
            cuts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
            for at, upto in zip(cuts, np.r_[cuts[1:], len(keys)], strict=True):
                part, own = batch.slice(at, upto - at), tuple(keys[at, :3].tolist())
                size = own[0]
                if own != key:
                    key, held, block = own, [], None
                if keys[at, 3] == 0:
                    held.append((part.column("id").to_numpy(), part.column("label").to_numpy(), _matrix(part.column("v"), size)))
                    continue
                if block is None:
                    if not held:
                        continue
                    block, held = [np.concatenate(c) for c in zip(*held, strict=True)], []
                queries = asked(part, size)
                w, r, s = queries.hits(*block, same, most)
                yield pa.RecordBatch.from_pydict(
                    {"anchor": queries.id[queries.of[w]], "tag": queries.tag[w], "id": block[0][r], "score": s},
                )

    return run


def mined(
    vectors: DataFrame,
    id_: str = "vec_id",
    vector: str = "embedding",
    label: str | Column = "label",
    anchor: Column | None = None,
    positives: int = 5,
    negatives: int = 10,
    window: tuple[int, int] = (30, 90),
    scale: int = 256,
    **how,
) -> DataFrame:
    """Per anchor and positive the best negatives: ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Scores are integer inner products of ``floor(scale * x)``. Anchors are the rows where ``anchor`` holds (all by default); the
    positives are the ``positives`` best other rows of the anchor's label, the negatives the ``negatives`` best rows of other labels
    whose score is from ``window[0]`` to ``window[1]`` hundredths of the positive's. Ties go to the smaller id. A positive with a
    negative score, and one without a row in its window, has no rows here; neither has an anchor without positives.

    Rows with a null id, label or vector, and with a null or a component that is not finite, take no part. Of several rows of one id
    the one with the least label, then the least vector counts. Vectors of different lengths do not meet. Components and scores beyond
    a long are its ends. An empty table gives no rows; further columns do not matter.
    """
    rows = integers(vectors, id_, vector, label, scale)
    if anchor is not None:
        wanted = vectors.where(anchor & F.col(f"`{id_}`").isNotNull()).select(F.col(f"`{id_}`").cast("long").alias("id")).distinct()
    rows = unrepeated(rows)
    index = Index(rows, **how)
    own = index.rows.select("id", "label", "v", "size")
    own = own if anchor is None else own.join(wanted, "id", "left_semi")
    one = F.struct(F.lit(0).cast("long").alias("tag"), F.lit(LOW).alias("low"), F.lit(HIGH).alias("high"))
    anchors = written(own, "anchors")
    found = written(index.search(anchors.withColumn("windows", F.array(one)), True, positives), "positives")
    found = found.select(F.col("anchor"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    exact = F.col("positive_score").cast("decimal(25,0)")
    low, high = (F.ceil(exact * window[0] / 100), F.floor(exact * window[1] / 100))
    span = F.struct(F.col("positive_id").alias("tag"), low.cast("long").alias("low"), high.cast("long").alias("high"))
    spans = found.groupBy("anchor").agg(F.sort_array(F.collect_list(span)).alias("windows"))
    asking = anchors.join(spans, F.col("id") == F.col("anchor")).drop("anchor")
    hits = index.search(asking, False, negatives)
    named = hits.select("anchor", F.col("tag").alias("positive_id"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    out = named.join(found, ["anchor", "positive_id"])
    return out.select(F.col("anchor").alias("anchor_id"), "positive_id", "rank", "negative_id", "positive_score", "negative_score")
