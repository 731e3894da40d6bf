"""Hard negatives against brute force, and the tree's promise: no row inside an annulus is left out."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from itemloom.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, anchors, positives=5, most=10, low=30, high=90, scale=256):
    kept = {}
    for id_, v, label in rows:
        if id_ is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        ints = [max(min(math.floor(x * scale), 2**63 - 1), -(2**63)) for x in v]
        kept[id_] = min(kept.get(id_, (label, ints)), (label, ints))
    out = []
    for a in kept:
        if not anchors(a):
            continue
        label, v = kept[a]
        score = {
            b: max(min(sum(x * y for x, y in zip(v, w, strict=True)), 2**63 - 1), -(2**63))
            for b, (_, w) in kept.items()
            if b != a and len(w) == len(v)
        }
        order = sorted(score, key=lambda b: (-score[b], b))
        for p in [b for b in order if kept[b][0] == label][:positives]:
            s = score[p]
            fits = [b for b in order if kept[b][0] != label and low * s <= 100 * score[b] <= high * s][:most]
            out += [(a, p, k, b, s, score[b]) for k, b in enumerate(fits, 1)]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.collect())


def clusters(seed, n, width, spread):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(9, width))
    rows = []
    for k in range(n):
        v = centres[rng.integers(9)] * rng.choice([0.3, 1.0, 1.5]) + rng.normal(size=width) * spread
        rows.append((k, [float(x) for x in v], int(rng.integers(4))))
    return rows


@pytest.mark.parametrize(("seed", "width", "spread"), [(1, 3, 0.1), (2, 8, 0.2), (3, 16, 1.0)])
def test_small_leaves(spark, seed, width, spread):
    """Many small leaves, blocks and samples that miss most rows; a third of the rows are copies of one vector."""
    rows = clusters(seed, 900, width, spread)
    rows += [(1000 + k, rows[5][1], k % 3) for k in range(300)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = found(negatives.mined(df, anchor=F.col("vec_id") % 25 == 0, fit_rows=200, leaf=20, least=4, block=64))
    assert got == brute(rows, lambda a: a % 25 == 0) and got


@pytest.mark.parametrize("same", [True, False])
def test_few_leaves_are_needed(same):
    """The tree leaves subtrees out, and never one that holds a row of a window."""
    rng = np.random.default_rng(5)
    x = np.floor(256 * (rng.normal(size=(20, 6))[rng.integers(20, size=4000)] + rng.normal(size=(4000, 6)) * 0.05)).astype(np.int64)
    tree = negatives.Tree(x[:1000], len(x), float((x.astype(float) ** 2).sum(axis=1).max()), leaf=50, least=8)
    ranges = {}
    leaves = tree.placed(x, ranges)
    for k, (low, high) in ranges.items():
        tree.nodes[k].low, tree.nodes[k].high = low, high
    at = rng.permutation(len(x))[:60]
    scores = x[at] @ x.T
    high = np.sort(scores, axis=1)[:, -50 if same else -200]
    low = np.sort(scores, axis=1)[:, -80 if same else -400]
    asked = negatives.Queries(at, at, x[at], np.arange(60), np.zeros(60, int), low, high)
    anchors, needed = tree.needed(asked)
    pairs = set(zip(anchors.tolist(), needed.tolist(), strict=True))
    for q in range(60):
        inside = (scores[q] >= low[q]) & (scores[q] <= high[q])
        assert {(q, leaf) for leaf in leaves[inside].tolist()} <= pairs
    assert tree.leaves > 40 and len(pairs) < 0.5 * 60 * tree.leaves


def test_odd_rows(spark):
    rng = random.Random(3)
    rows = [(k, [rng.uniform(-1, 1) for _ in range(4)], k % 3) for k in range(40)]
    rows += [
        (100, None, 1), (101, [], 1), (102, [], 2), (103, [1.0, None, 0.0, 0.0], 1), (104, [float("nan"), 0.0, 0.0, 0.0], 1),
        (105, [float("inf"), 0.0, 0.0, 0.0], 1), (106, [1.0, 1.0], 1), (107, [2.0, 1.0], 2), (108, [2.0, 2.0], 1), (None, [1.0] * 4, 1),
        (109, [0.5] * 4, None), (3, [0.9, 0.9, 0.9, 0.9], 1), (3, [0.9, 0.9, 0.9, 0.9], 1), (110, [1e300, 0.0, 1.0, 0.0], 1),
        (111, [1e250, 0.0, 1.0, 0.0], 1), (112, [1e17, 1e17, 0.0, 0.0], 2), (113, [0.0] * 4, 0), (114, [0.0] * 4, 0), (115, [0.0] * 4, 1),
        (-5, [0.1, 0.2, 0.3, 0.4], 2),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute(rows, lambda a: True)
    assert found(negatives.mined(df)) == want and want
    more = df.withColumns({n: F.lit("extra") for n in ("id", "v", "size", "leaf", "anchor", "rank", "positive_id", "windows", "blocks")})
    assert found(negatives.mined(more)) == want
    assert negatives.mined(df.limit(0)).collect() == []
    assert negatives.mined(df.where("vec_id = 7")).collect() == []
