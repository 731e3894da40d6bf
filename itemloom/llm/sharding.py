"""Shards of near-equal bytes by a k-d tree over document metadata.

Cells are split again and again, each along the dimension in which it is widest, at the weighted median of its bytes, until every leaf
is one shard. A median is found by its digits: bytes are added up per leading digit of all keys, the digit in which half of them is
reached is looked into again, and so on, so no cell is ever sorted or gathered. What is placed are groups of equal texts; a group that
is more than a small part of a shard is dealt out in parts, so that copies of one text neither spread without need nor fill a shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import bin_sums, bins_for, running, text_of, written

#: bits of a place on an axis, and of the digest that orders what shares a place
PLACE_BITS, TIE_BITS = 16, 24
#: widths of the digits of a key, the leading one first
DIGITS = (14, 13, 13)
#: a group of equal texts is dealt out in parts no larger than this share of a shard
GROUP_SHARE = 1 / 32


def _place(value: Column) -> Column:
    """A text's place on its axis: equal texts share it."""
    return F.pmod(F.xxhash64(F.coalesce(value.cast("string"), F.lit(""))), F.lit(1 << PLACE_BITS)).cast("long")


def axes_of(source: str, lang: str) -> dict[str, Column]:
    """Axes of the tree: the length (its logarithm, in fine steps), the source and the language."""
    length = F.least(F.floor(F.log2(F.col("size").cast("double")) * 2048), F.lit((1 << PLACE_BITS) - 1)).cast("long")
    return {"_length": length, "_source": _place(F.col(f"`{source}`")), "_lang": _place(F.col(f"`{lang}`"))}


def _small(df: DataFrame, rows: list[tuple], schema: str) -> DataFrame:
    """Rows for joins; never more than there are shards."""
    return F.broadcast(df.sparkSession.createDataFrame(rows, schema))


def _medians(units: DataFrame, cells: list[tuple[int, int, float]]) -> list[tuple[int, int, int]]:
    """For each cell ``(number, axis, bytes that go left)``: its number, axis, and the largest key that goes left."""
    keyed = units.join(_small(units, cells, "cell long, axis int, goal double"), "cell")
    key = F.element_at(F.array(*(F.col(c) for c in units.columns if c.startswith("_key"))), F.col("axis") + 1)
    found = [(cell, axis, 0, 0, goal) for cell, axis, goal in cells]  # ..., leading digits so far, bytes before them, goal
    rest = sum(DIGITS)
    for digit in DIGITS:
        rest -= digit
        at = _small(units, [f[:1] + f[2:4] for f in found], "cell long, lead long, before long")
        inside = keyed.withColumn("_key", key).join(at, "cell").where(F.shiftright("_key", rest + digit) == F.col("lead"))
        sums = inside.groupBy("cell", "goal", "lead", "before", F.shiftright("_key", rest).alias("digit")).agg(F.sum("bytes").alias("b"))
        upto = F.sum("b").over(Window.partitionBy("cell").orderBy("digit").rowsBetween(Window.unboundedPreceding, 0))
        reached = sums.withColumn("upto", F.col("before") + upto).where("upto >= goal")
        first = reached.groupBy("cell").agg(F.min(F.struct("digit", "upto", "b")).alias("m")).select("cell", "m.*").collect()
        crossing = {r["cell"]: r for r in first}
        found = [(c, a, crossing[c]["digit"], crossing[c]["upto"] - crossing[c]["b"], g) for c, a, _, _, g in found]
    # the key that crosses goes to the side that it brings nearer to the goal
    return [(c, a, d if crossing[c]["upto"] - g <= g - before else d - 1) for c, a, d, before, g in found]


def leaves(units: DataFrame, axes: list[str], shards: int) -> DataFrame:
    """``units`` (``bytes``, the axes and ``_tie``) with ``shard``, the leaf of the tree that each falls into."""
    for k, axis in enumerate(axes):
        units = units.withColumn(f"_key{k}", F.shiftleft(F.col(axis), TIE_BITS).bitwiseOR(F.col("_tie")))
    units = units.withColumn("cell", F.lit(0).cast("long"))
    whole = units.agg(*(F.min(a).alias(f"lo{k}") for k, a in enumerate(axes)), *(F.max(a).alias(f"hi{k}") for k, a in enumerate(axes)))
    whole = whole.first()
    if whole["lo0"] is None:
        return units.withColumn("shard", F.lit(0))
    scale = [max(whole[f"hi{k}"] - whole[f"lo{k}"], 1) for k in range(len(axes))]
    count = {0: shards}  # shards below a cell, which is named by its first one
    while any(n > 1 for n in count.values()):
        spread = [F.max(a) - F.min(a) for a in axes]
        stats = units.groupBy("cell").agg(F.sum("bytes").alias("bytes"), *(s.alias(f"w{k}") for k, s in enumerate(spread))).collect()
        cells = []
        for r in stats:
            if (n := count[r["cell"]]) > 1:
                axis = max(range(len(axes)), key=lambda k: (r[f"w{k}"] / scale[k], -k))
                cells.append((r["cell"], axis, r["bytes"] * ((n + 1) // 2) / n))
        cuts = _small(units, _medians(units, cells), "cell long, axis int, cut long")
        moves = _small(units, [(c, c + (n + 1) // 2) for c, n in count.items() if n > 1], "cell long, right long")
        key = F.element_at(F.array(*(F.col(f"_key{k}") for k in range(len(axes)))), F.col("axis") + 1)
        joined = units.join(cuts, "cell", "left").join(moves, "cell", "left")
        moved = joined.withColumn("_to", F.when(key > F.col("cut"), F.col("right")).otherwise(F.col("cell")))
        units = written(moved.drop("cell", "axis", "cut", "right").withColumnRenamed("_to", "cell"), "tree")
        count = {k: v for c, n in count.items() for k, v in ([(c, 1)] if n == 1 else [(c, (n + 1) // 2), (c + (n + 1) // 2, n // 2)])}
    return units.withColumn("shard", F.col("cell").cast("int"))


def sharded(
    docs: DataFrame,
    shards: int | None = 16,
    target_bytes: int | None = None,
    id_: str = "doc_id",
    text: str = "text",
    source: str = "source",
    lang: str = "lang",
) -> DataFrame:
    """Per document: its id, ``size`` (UTF-8 bytes and one more), ``text_crc32``, ``shard`` and ``slot``, its place in the shard from 0.

    Give the number of ``shards``, or ``target_bytes`` of one. Their bytes come out near equal; equal texts share a shard unless they are
    more than a small part of one. A null text is the empty one of size 1, null sources and languages have a place of their own, repeated
    rows get slots of their own, and an empty table gives no rows. Other columns of ``docs`` are not read.
    """
    words = text_of(F.col(f"`{text}`"))
    own = docs.select(
        F.col(f"`{id_}`").alias("_id"),
        (F.octet_length(words) + 1).cast("long").alias("size"),
        F.crc32(words).cast("long").alias("text_crc32"),
        F.xxhash64(F.lit(1), words).alias("_k1"),
        F.xxhash64(words, F.lit(2)).alias("_k2"),
        F.col(f"`{source}`"),
        F.col(f"`{lang}`"),
    )
    axes = axes_of(source, lang)
    rows = written(own.select("_id", "size", "text_crc32", "_k1", "_k2", *(c.alias(n) for n, c in axes.items())), "shards")
    total = rows.agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")).first()
    if shards is None:
        shards = max(1, -(-(total["bytes"] or 0) // target_bytes))
    most = max(1, int((total["bytes"] or 0) / shards * GROUP_SHARE))
    # groups above that size: fewer than shards / GROUP_SHARE
    large = rows.groupBy("_k1", "_k2").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n")).where((F.col("b") > most) & (F.col("n") > 1))
    large = F.broadcast(large.select(F.col("_k1").alias("_l1"), F.col("_k2").alias("_l2"), F.ceil(F.col("b") / most).alias("_parts")))
    parted = rows.join(large, (F.col("_k1") == F.col("_l1")) & (F.col("_k2") == F.col("_l2")), "left")
    part = F.when(F.col("_parts").isNotNull(), F.pmod(F.xxhash64("_id"), "_parts")).otherwise(0).cast("long")
    parted = parted.withColumn("_part", part).drop("_l1", "_l2", "_parts")
    group = ["_k1", "_k2", "_part"]
    units = parted.groupBy(*group).agg(F.sum("size").alias("bytes"), *(F.min(a).alias(a) for a in axes))
    units = units.withColumn("_tie", F.pmod(F.xxhash64(*group), F.lit(1 << TIE_BITS)).cast("long"))
    placed = parted.join(leaves(written(units, "units"), list(axes), shards).select(*group, "shard"), group)
    bins = bins_for(total["n"])
    binned = placed.withColumn("_bin", F.pmod(F.xxhash64("_id", "_k1"), F.lit(bins)))
    sums = bin_sums(binned, ["shard"], "_bin", F.lit(1))
    numbered = running(binned, sums, ["shard"], "_bin", [F.col("_id"), F.col("_k1"), F.col("_k2")], F.lit(1), "_upto")
    return numbered.select(F.col("_id").alias(id_), "size", "text_crc32", "shard", (F.col("_upto") - 1).cast("long").alias("slot"))
