"""Connected components of an edge table, by stars that pull every node towards the smallest one it can see."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node, root`` for every node of ``edges`` (``a``, ``b``: integers): root is the smallest node it is connected with.

    A round links all larger neighbours of a node to the smallest of its neighbourhood, then the smaller ones too. The smallest
    neighbour is an aggregate that is combined before the shuffle. Rounds go on until no edge changes; each is written to the shared
    folder, so the plan stays short. Loops and repeated edges do not matter; without edges there are no rows.
    """
    ordered = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, before = written(ordered, "components"), None
    for _ in range(most_rounds):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        now = written(small.unionByName(down.select("a", F.col("m").alias("b"))).distinct(), "components")
        digest = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if digest == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        before = digest
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
