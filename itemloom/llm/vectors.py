"""Near-duplicate vectors of one label: tiles in the order of principal components, given up as soon as no pair can reach the threshold.

Vectors are scaled to length one and turned to the principal axes of all of them, so their leading numbers hold most of what tells them
apart. Two vectors whose cosine reaches ``t`` differ by at most ``sqrt(2 - 2 t)`` on every axis: on a grid of that step along the leading
axes they lie in the same cell or in touching ones. A cell is cut into blocks of bounded size, and each pair of blocks is one tile.
Within a tile products add up a few axes at a time; the rest of a product is at most the product of what is left of the two lengths,
and once that cannot reach the threshold for any pair, the tile ends. What passes is measured again on the vectors as given.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batchwise, written
from .components import components

#: vectors of one side of a tile
BLOCK = 2048
#: axes of the grid
GRID_AXES = 2
#: axes of a tile that are added up at a time
STEP = 8
#: room for rounding, far above what sums of doubles lose
SLACK = 1e-9


def unit(values) -> np.ndarray | None:
    """The vector as doubles scaled to length one; None for one that is null, empty, zero, or holds nulls or numbers that are not finite."""
    if values is None or not len(values) or any(v is None for v in values):
        return None
    x = np.array(values, float)
    if not np.isfinite(x).all() or not (top := np.abs(x).max()):
        return None
    x = x / top
    return x / math.sqrt(x @ x)


def principal_axes(vectors: DataFrame) -> dict[int, np.ndarray]:
    """For each length of vectors (``_size``, ``_unit``) the axes of largest spread first, from sums over all of them.

    Tasks add up outer products; their sums are combined entry by entry, so the driver gets a square of the length and nothing more.
    """

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            sizes = batch.column(0).to_numpy()
            for size in np.unique(sizes).tolist():
                rows = batch.column(1).filter(pa.array(sizes == size))
                x = rows.flatten().to_numpy().reshape(-1, size)
                total[size] = total.get(size, 0) + x.T @ x
        for size, square in total.items():
            i, j = np.triu_indices(size)
            yield pa.RecordBatch.from_pydict({"size": np.full(len(i), size), "i": i, "j": j, "v": square[i, j]})

    found = vectors.select("_size", "_unit").mapInArrow(sums, "size long, i long, j long, v double")
    out = {}
    for size, part in found.groupBy("size", "i", "j").agg(F.sum("v").alias("v")).toPandas().groupby("size"):
        square = np.zeros((int(size), int(size)))
        square[part.i, part.j] = square[part.j, part.i] = part.v
        out[int(size)] = np.linalg.eigh(square)[1][:, ::-1]
    return out


def close_pairs(a: np.ndarray, b: np.ndarray, threshold: float, step: int = STEP) -> tuple[np.ndarray, np.ndarray]:
    """Places of pairs of rows that may reach the threshold. Rows are unit vectors, their axes in order of spread."""
    left_a = np.sqrt(np.cumsum((a**2)[:, ::-1], axis=1)[:, ::-1])
    left_b = np.sqrt(np.cumsum((b**2)[:, ::-1], axis=1)[:, ::-1])
    i = j = partial = None
    for at in range(0, a.shape[1], step):
        upto = min(at + step, a.shape[1])
        rest_a = left_a[:, upto] if upto < a.shape[1] else np.zeros(len(a))
        rest_b = left_b[:, upto] if upto < a.shape[1] else np.zeros(len(b))
        if i is None:
            whole = a[:, :upto] @ b[:, :upto].T if at == 0 else whole + a[:, at:upto] @ b[:, at:upto].T
            alive = whole + np.outer(rest_a, rest_b) >= threshold - SLACK
            live = int(alive.sum())
            if not live:
                return np.zeros(0, int), np.zeros(0, int)
            if live * 16 < alive.size or upto == a.shape[1]:  # few: go on pair by pair
                i, j = np.nonzero(alive)
                partial = whole[i, j]
        else:
            partial = partial + np.einsum("ij,ij->i", a[i, at:upto], b[j, at:upto])
            alive = partial + rest_a[i] * rest_b[j] >= threshold - SLACK
            i, j, partial = i[alive], j[alive], partial[alive]
            if not len(i):
                break
    return i, j


def _tame(x: np.ndarray) -> np.ndarray:
    """Rows whose squares would leave the range of doubles are scaled; a cosine does not change by that."""
    top = np.abs(x).max(axis=1, keepdims=True)
    return np.where((top > 1e150) | (top < 1e-150), x / top, x)


def _tile(group: pd.DataFrame, axes: dict[int, np.ndarray], threshold: float) -> pd.DataFrame:
    """Links of one tile: for each vector the rows linked with it, and the edges of a tree of what is linked."""
    first, second = group[group["_side"] == 0], group[group["_side"] == 1]
    same = not len(second)
    second = first if same else second
    empty = pd.DataFrame({"node": pd.Series(dtype="int64"), "links": pd.Series(dtype="int64"), "to": pd.Series(dtype="Int64")})
    if not len(first) or (same and len(first) < 2):
        return empty
    x, y = (np.stack(s["_value"].to_list()).astype(float) for s in (first, second))
    x, y = _tame(x), _tame(y)
    norm_x, norm_y = np.sqrt((x**2).sum(axis=1)), np.sqrt((y**2).sum(axis=1))
    turn = axes[x.shape[1]]
    a, b = (x / norm_x[:, None]) @ turn, (y / norm_y[:, None]) @ turn
    i, j = close_pairs(a, b, threshold)
    if same:
        i, j = i[i < j], j[i < j]
    keep = np.zeros(len(i), bool)
    for at in range(0, len(i), 65_536):
        part = slice(at, at + 65_536)
        p, q = i[part], j[part]
        keep[part] = np.einsum("ij,ij->i", x[p], y[q]) / (norm_x[p] * norm_y[q]) >= threshold
    i, j = i[keep], j[keep]
    if not len(i):
        return empty
    node_a, node_b = first["_node"].to_numpy(), second["_node"].to_numpy()
    many_a, many_b = first["_many"].to_numpy(), second["_many"].to_numpy()
    counts_a = np.bincount(i, many_b[j], len(a)).astype("int64")
    counts_b = np.bincount(j, many_a[i], len(b)).astype("int64")
    if same:
        counts_a, counts_b = counts_a + counts_b, counts_b[:0]
        node_of = node_a
        left, right = node_a[i], node_a[j]
    else:
        left, right = node_a[i], node_b[j]
        node_of = np.concatenate([node_a, node_b])
    counts = np.concatenate([counts_a, counts_b])
    seen = counts > 0
    forest = spanning(left, right)
    return pd.concat(
        [
            pd.DataFrame({"node": node_of[seen], "links": counts[seen], "to": pd.array([None] * int(seen.sum()), "Int64")}),
            pd.DataFrame({"node": left[forest], "links": 0, "to": pd.array(right[forest], "Int64")}),
        ]
    )


def spanning(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Places of edges that are enough to hold together what all of them do: fewer than nodes."""
    nodes, flat = np.unique(np.concatenate([left, right]), return_inverse=True)
    parent = list(range(len(nodes)))

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    kept = []
    for at, (p, q) in enumerate(zip(flat[: len(left)].tolist(), flat[len(left) :].tolist(), strict=True)):
        p, q = root(p), root(q)
        if p != q:
            parent[p] = q
            kept.append(at)
            if len(kept) == len(nodes) - 1:
                break
    return np.array(kept, int)


def _tiles(nodes: DataFrame, block: int) -> DataFrame:
    """Which blocks of which cells meet: one row per tile and side. Cells of a label meet themselves and those next to them."""
    axes = [f"_c{k}" for k in range(GRID_AXES)]
    own = ["label", "_size", *axes]
    cells = nodes.groupBy(*own).agg(F.count(F.lit(1)).alias("n"))
    cells = written(cells.select(*own, F.ceil(F.col("n") / block).cast("int").alias("_blocks")), "cells")
    # of two cells that touch, the lesser one looks for the other: half of the offsets
    ahead = [o for o in itertools.product((-1, 0, 1), repeat=GRID_AXES) if o >= (0,) * GRID_AXES]
    offsets = F.explode(F.array(*(F.struct(*(F.lit(d).cast("long").alias(f"d{k}") for k, d in enumerate(o))) for o in ahead)))
    seek = cells.withColumn("_o", offsets).select(
        "label", "_size", *axes, "_blocks", *(F.col(c) + F.col(f"_o.d{k}") for k, c in enumerate(axes))
    )
    seek = seek.toDF("label", "_size", *axes, "_blocks", *(f"to{c}" for c in axes))
    other = cells.toDF("label", "_size", *(f"to{c}" for c in axes), "_to_blocks")
    met = seek.join(other, ["label", "_size", *(f"to{c}" for c in axes)])
    rows = met.withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    same_cell = F.lit(True)
    for c in axes:
        same_cell = same_cell & (F.col(c) == F.col(f"to{c}"))
    rows = rows.withColumn("_j", F.explode(F.sequence(F.when(same_cell, F.col("_i")).otherwise(0), F.col("_to_blocks") - 1)))
    tile = F.concat_ws("/", "label", "_size", *axes, *(f"to{c}" for c in axes), "_i", "_j").alias("_tile")
    here = F.struct(*(F.col(c).alias(c) for c in axes), F.col("_i").alias("_block"), F.lit(0).alias("_side"))
    there = F.struct(*(F.col(f"to{c}").alias(c) for c in axes), F.col("_j").alias("_block"), F.lit(1).alias("_side"))
    alone = same_cell & (F.col("_i") == F.col("_j"))
    sides = F.explode(F.when(alone, F.array(here)).otherwise(F.array(here, there))).alias("_s")
    return rows.select("label", "_size", tile, sides).select("label", "_size", "_tile", "_s.*")


def linked(
    vectors: DataFrame, id_: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = 0.93, block: int = BLOCK
) -> DataFrame:
    """Per vector: its id, ``n_links`` (other vectors of its label with a cosine of at least ``threshold``), ``component_id``, ``kept``.

    ``component_id`` is the smallest id reachable by links, its own included; ``kept`` tells whether that is its own. Vectors that are
    null, empty, zero, or hold nulls or numbers that are not finite link with nothing, and so do those without a label or an id, and
    vectors of different lengths. Equal vectors of a label are links too; they are counted by their number and compared once. Repeated
    rows are vectors of their own. An empty table gives no rows. Ids are whole numbers, one for each vector.
    """
    own = vectors.select(F.col(f"`{id_}`").alias("_id"), F.col(f"`{label}`").alias("label"), F.col(f"`{vector}`").alias("_value"))
    fit = own.where(F.col("_id").isNotNull() & F.col("label").isNotNull())
    fit = batchwise(fit, ["_value"], "`_unit` array<double>", lambda: lambda vs: [[unit(v) for v in vs]]).where("_unit is not null")
    keys = [F.xxhash64(F.lit(1), "label", "_value").alias("_k1"), F.xxhash64(F.lit(2), "_value", "label").alias("_k2")]
    nodes = fit.groupBy(*keys).agg(
        F.min("_id").cast("long").alias("_node"),
        F.count(F.lit(1)).alias("_many"),
        F.first("label").alias("label"),
        F.first("_value").alias("_value"),
        F.first("_unit").alias("_unit"),
    )
    nodes = written(nodes.withColumn("_size", F.size("_value").cast("long")), "nodes")
    axes = principal_axes(nodes)
    width = math.sqrt(max(2 - 2 * threshold, 0)) + SLACK
    grid = ", ".join(f"`_c{k}` bigint" for k in range(GRID_AXES))

    def cells(units):
        places = []
        for u in units:
            lead = np.array(u) @ axes[len(u)][:, :GRID_AXES]
            places.append([*np.floor(lead / width).astype(int).tolist(), *[0] * GRID_AXES][:GRID_AXES])
        return [[p[k] for p in places] for k in range(GRID_AXES)]

    placed = written(batchwise(nodes, ["_unit"], grid, lambda: cells).drop("_unit"), "placed")
    tiles = _tiles(placed, block)
    where = ["label", "_size", *(f"_c{k}" for k in range(GRID_AXES))]
    blocks = placed.groupBy(*where).agg(F.ceil(F.count(F.lit(1)) / block).alias("_blocks"))
    dealt = placed.join(blocks, where).withColumn("_block", F.pmod(F.xxhash64("_node"), "_blocks").cast("int"))
    sided = dealt.join(tiles, [*where, "_block"]).select("_tile", "_side", "_node", "_many", "_value")
    found = sided.groupBy("_tile").applyInPandas(lambda g: _tile(g, axes, threshold), "node long, links long, to long")
    found = written(found, "links")
    counts = found.groupBy("node").agg(F.sum("links").alias("_links"))
    roots = components(found.where("to is not null").select(F.col("node").alias("a"), F.col("to").alias("b")))
    named = nodes.select("_k1", "_k2", "_node", "_many").join(counts, F.col("_node") == F.col("node"), "left").drop("node")
    named = named.join(roots, F.col("_node") == F.col("node"), "left").select(
        F.col("_k1").alias("_m1"),
        F.col("_k2").alias("_m2"),
        (F.coalesce("_links", F.lit(0)) + F.col("_many") - 1).alias("_n"),
        F.coalesce("root", "_node").alias("_root"),
    )
    alone = F.col("_id").isNull() | F.col("label").isNull()
    keyed = own.select("_id", *(F.when(~alone, k).alias(n) for k, n in zip(keys, ("_k1", "_k2"), strict=True)))
    joined = keyed.join(named, (F.col("_k1") == F.col("_m1")) & (F.col("_k2") == F.col("_m2")), "left")
    component = F.coalesce(F.col("_root"), F.col("_id").cast("long"))
    return joined.select(
        F.col("_id").alias(id_),
        F.coalesce("_n", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("_id").cast("long").eqNullSafe(component).alias("kept"),
    )
