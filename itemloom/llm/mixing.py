"""Mixing sources to target weights by weighted fair queueing, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import bin_sums, bins_for, carried, restored, running, text_of, written

#: a word: what stands between blanks
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: str | Column) -> Column:
    return F.regexp_count(text_of(text), F.lit(WORD)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int], most: int) -> DataFrame:
    """One row per source: ``_rank``, ``_source_size``, and the words it should give, ``_target double``.

    ``sizes`` has ``_source`` and ``_source_size``. Sources in the order of their code points (null last) weigh ``weights``,
    repeating; together they give as many words as all sources have. No target is above ``most`` times the source's size: the excess
    is shared by weight among the others until none is above. That level is found in one pass over the sources sorted by cap per
    weight: it is the first one that does not reach the cap of the next source.
    """
    by_name = [F.col("_source").isNull(), F.col("_source").cast("binary")]
    rank = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*by_name)) - 1
    turn = F.pmod("_rank", F.lit(len(weights))) + 1
    ranked = sizes.withColumn("_rank", rank).withColumn("_weight", F.element_at(F.array(*map(F.lit, weights)), turn).cast("long"))
    capped = ranked.withColumn("_cap", F.col("_source_size") * most).withColumn("_full", F.col("_cap") / F.col("_weight"))
    every = Window.partitionBy(F.lit(0))
    below = every.orderBy("_full", "_rank").rowsBetween(Window.unboundedPreceding, -1)
    open_words = F.sum("_source_size").over(every) - F.coalesce(F.sum("_cap").over(below), F.lit(0))
    open_weight = F.sum("_weight").over(every) - F.coalesce(F.sum("_weight").over(below), F.lit(0))
    levelled = capped.withColumn("_level", open_words.cast("double") / open_weight.cast("double"))
    level = F.min(F.when(F.col("_level") <= F.col("_full"), F.struct("_full", "_level"))).over(every)["_level"]
    target = F.least(F.col("_cap").cast("double"), F.col("_weight") * level)
    return levelled.select("_source", "_rank", "_source_size", target.alias("_target"))


@dataclass
class Mix:
    """A queue of documents and where the budget ends in it."""

    queue: DataFrame
    lanes: Lanes
    most: int
    bins: int
    end_range: int
    end_finish: float
    end_rank: int

    def finish(self, epoch: int | Column) -> Column:
        """Virtual finish time of a copy: the words queued in its source up to and with it, over the source's target."""
        epoch = epoch if isinstance(epoch, Column) else F.lit(epoch)
        return F.try_divide((epoch * F.col("_source_size") + F.col("_sum")).cast("double"), F.col("_target"))

    def range_of(self, finish: Column) -> Column:
        """The range of a finish time: even steps up to 2, even ratios beyond, so that no far range gathers many copies."""
        far = (F.log2(F.greatest(finish, F.lit(2.0))) + 1) * self.bins
        return F.floor(F.when(finish < 2, finish * self.bins).otherwise(far))

    def taken(self, epoch: int | Column) -> Column:
        finish = self.finish(epoch)
        at, tied = self.range_of(finish), (finish == self.end_finish) & (F.col("_rank") <= self.end_rank)
        inside = (at < self.end_range) | ((at == self.end_range) & ((finish < self.end_finish) | tied))
        # a source without words has no target and no finish times
        return F.coalesce((F.col("_words") > 0) & inside, F.lit(False))

    def copies(self) -> Column:
        """How many times the mix takes a document."""
        taken = [F.when(self.taken(e), 1).otherwise(0) for e in range(self.most)]
        return sum(taken[1:], taken[0])


def sized(id_: Column, source: Column, text: Column, seed: str) -> dict[str, Column]:
    """What a document queues by: ``_id``, ``_name`` of its source, ``_words``, and ``_key``, a digest of its id."""
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))))
    return {"_id": id_, "_name": source.cast("string"), "_words": n_words(text), "_key": F.substring(key, 1, 16)}


@dataclass
class Lanes:
    """Sizes of all sources and of the bins of their queues, from which running sums go over any rows of the same documents."""

    bins: int
    #: per source: ``_source``, ``_rank``, ``_source_size``, ``_target``
    aims: DataFrame
    #: per rank and bin: words in it and before it
    sums: DataFrame
    budget: int

    def bin_of(self) -> Column:
        return F.floor(F.conv(F.substring("_key", 1, 8), 16, 10).cast("long") * self.bins / 2**32)

    def queued(self, rows: DataFrame) -> DataFrame:
        """Rows with ``sized`` columns, and ``_rank``, ``_source_size``, ``_target``, and ``_sum``, the words of the source up to the row.

        Documents of a source queue in the order of a keyed digest of their id. The running sum goes over bins of that digest.
        """
        ranked = rows.withColumn("_bin", self.bin_of()).join(self.aims, F.col("_name").eqNullSafe(F.col("_source"))).drop("_name", "_source")
        order = [F.col("_key"), F.col("_id"), F.col("_words")]
        return running(ranked, self.sums, ["_rank"], "_bin", order, F.col("_words"), "_sum").drop("_bin", "_key")


def lanes(sizes: DataFrame, weights: Sequence[int], most: int) -> Lanes:
    """Lanes of documents with their ``sized`` columns."""
    found = Lanes(bins_for(sizes.count()), sizes, sizes, 0)
    sums = written(sizes.groupBy(F.col("_name").alias("_source"), found.bin_of().alias("_bin")).agg(F.sum("_words").alias("_size")), "mix")
    found.aims = targets(sums.groupBy("_source").agg(F.sum("_size").alias("_source_size")), weights, most)
    ranked = sums.join(found.aims.select(F.col("_source").alias("_of"), "_rank"), F.col("_source").eqNullSafe(F.col("_of")))
    found.sums = bin_sums(ranked, ["_rank"], "_bin", F.col("_size"))
    found.budget = sums.agg(F.coalesce(F.sum("_size"), F.lit(0))).first()[0]
    return found


def mix(
    docs: DataFrame,
    weights: Sequence[int] = (5, 2, 1),
    most: int = 3,
    id_: str = "doc_id",
    source: str = "source",
    text: str = "text",
    seed: str = "mix",
) -> Mix:
    """Queues all documents and finds the end of the budget, which is the words of all of them.

    Every source queues its documents ``most`` times over, one epoch after the other. All copies are ranged by finish time, the words
    of each range are added up, and only the range in which the budget runs out is sorted; what comes up to the budget's end is taken.
    Null and empty texts have no words and are never taken. A null source is a source of its own; repeated rows queue one by one and
    take turns by id and size, so reruns agree. An empty table gives an empty mix.
    """
    # texts are read once: what a document queues by is written
    own = sized(F.col(f"`{id_}`"), F.col(f"`{source}`"), F.col(f"`{text}`"), seed)
    sizes = written(docs.select(*(c.alias(n) for n, c in own.items())), "mix")
    lane = lanes(sizes, weights, most)
    queue, bins, budget = lane.queued(sizes), lane.bins, lane.budget
    light = written(queue.where("_words > 0").select("_words", "_rank", "_source_size", "_target", "_sum"), "mix")
    found = Mix(queue, lane, most, bins, -1, -1.0, -1)
    each = light.withColumn("_epoch", F.explode(F.sequence(F.lit(0), F.lit(most - 1))))
    ranged = each.withColumn("_finish", found.finish(F.col("_epoch"))).withColumn("_range", found.range_of(F.col("_finish")))
    sums = bin_sums(ranged.withColumn("_mix", F.lit(0)), ["_mix"], "_range", F.col("_words"))
    last = sums.where(F.col("_before") + F.col("_sum") > budget).agg(F.min(F.struct("_range", "_before")).alias("m")).first()["m"]
    if last is None:  # no words at all
        return found
    found.end_range = last["_range"]
    upto = F.sum("_words").over(Window.partitionBy("_range").orderBy("_finish", "_rank").rowsBetween(Window.unboundedPreceding, 0))
    inside = ranged.where(F.col("_range") == last["_range"]).withColumn("_upto", upto + last["_before"])
    end = inside.where(F.col("_upto") <= budget).agg(F.max(F.struct("_finish", "_rank")).alias("m")).first()["m"]
    if end is not None:
        found.end_finish, found.end_rank = end["_finish"], end["_rank"]
    return found


def taken_words(docs: DataFrame, id_: str = "doc_id", **how) -> DataFrame:
    """Per document: its id, ``size``, ``source_size``, ``target`` of its source, and ``taken``, the words the mix takes of it."""
    found = mix(docs, id_=id_, **how)
    return found.queue.select(
        F.col("_id").alias(id_),
        F.col("_words").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_words") * found.copies()).alias("taken"),
    )


def mixed(docs: DataFrame, id_: str = "doc_id", source: str = "source", text: str = "text", ordered: bool = False, **how) -> DataFrame:
    """The rows of ``docs`` as the mix takes them, each once per copy; ``ordered`` sorts them by finish time over all partitions.

    Rows keep their columns, whatever they are called. Rows without words (null, empty and blank texts) are never taken, a null source
    is a source of its own, long texts count whole; rows of one id and size take turns, repeated rows too. An empty table gives no rows.
    """
    plan = mix(docs, id_=id_, source=source, text=text, **how)
    own = sized(F.col(f"`{id_}`"), F.col(f"`{source}`"), F.col(f"`{text}`"), how.get("seed", "mix"))
    queue = plan.lanes.queued(carried(docs, **own))
    each = queue.withColumn("_epoch", F.explode(F.sequence(F.lit(0), F.lit(plan.most - 1)))).where(plan.taken(F.col("_epoch")))
    if ordered:
        each = each.withColumn("_finish", plan.finish(F.col("_epoch"))).orderBy("_finish", "_rank")
    return restored(each, docs.columns)
