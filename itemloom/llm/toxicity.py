"""Toxicity: a convolutional network over hashed word embeddings, trained and run in numpy.

All labelled documents teach. They are dealt out over tasks; a round lets every task go on with the common network on its own documents, and
the next one starts from the mean of what they come to. Thresholds count all documents that are set aside for them."""

from __future__ import annotations

import pickle
import re
import zlib
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batchwise, text_of, written

#: words: letters, and the bytes of letters beyond ASCII
WORD = re.compile(rb"[a-z\x80-\xff]+")
HASHES = 1 << 22
#: a word is the sum of its own vector and that of its first characters, so forms of one stem help each other
STEM = 4
WIDTHS = (1, 2, 3)
EMBEDDING, FILTERS = 8, 8
#: labelled documents that a task learns from at once, and their characters in all; a longer text is alone
FIT_ROWS, FIT_CHARS = 2_000, 8_000_000
#: such parts that one task goes through, as long as there are fewer than ``TASKS`` of them
PARTS = 4
#: tasks that learn side by side at most, and networks that travel to the driver in a round at most
TASKS, SUMS = 64, 8
#: scores this close together are not parted by a threshold
BIN = 1e-4
#: words whose hash a task remembers
CACHE = 400_000


def pair(word: bytes) -> tuple[int, int]:
    """Hashes of a word and of its stem."""
    stem = word.decode(errors="replace")[:STEM].encode()
    return zlib.crc32(word) & HASHES - 1, zlib.crc32(b"^" + stem) & HASHES - 1


def hashed(text: str) -> list[int]:
    """The pairs of all words, one after the other."""
    return [h for w in WORD.findall(text.lower().encode()) for h in pair(w)]


@dataclass
class Network:
    """``vectors`` has a row per word hash seen in training (``seen``, sorted), after a row of zeros for all others."""

    seen: np.ndarray
    vectors: np.ndarray
    filters: list[np.ndarray]  # per width: (width * EMBEDDING, FILTERS)
    offsets: list[np.ndarray]
    weights: np.ndarray
    bias: float
    thresholds: dict[str, float] = field(default_factory=dict)
    threshold: float = 0.5

    def rows_of(self, hashes: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.seen, hashes)
        known = (at < len(self.seen)) & (self.seen[np.minimum(at, len(self.seen) - 1)] == hashes) if len(self.seen) else np.zeros(at.shape, bool)
        return np.where(known, at + 1, 0)

    def maps(self, rows: np.ndarray) -> list[np.ndarray]:
        """Filter responses at every place; ``rows`` ends in as many zeros as the widest filter looks ahead."""
        words, reach = self.vectors[rows].sum(axis=1), max(WIDTHS) - 1
        n = len(rows) - reach
        return [
            np.concatenate([words[o : o + n] for o in range(w)], axis=1) @ f + b
            for w, f, b in zip(WIDTHS, self.filters, self.offsets, strict=True)
        ]

    def score(self, documents: Sequence[np.ndarray]) -> np.ndarray:
        """Probabilities of whole documents, given as pairs of rows of ``vectors``: the strongest response of each filter counts."""
        if not documents:
            return np.zeros(0)
        padded, starts = joined(documents)
        used = np.concatenate([np.arange(s, s + max(len(d), 1)) for s, d in zip(starts, documents, strict=True)])
        first = np.cumsum([0, *(max(len(d), 1) for d in documents[:-1])])
        best = [np.maximum.reduceat(m[used], first, axis=0) for m in self.maps(padded)]
        logit = np.maximum(np.concatenate(best, axis=1), 0) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(logit, -40, 40)))


def joined(documents: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All documents in one row of words, each followed by zeros so that no filter sees two of them."""
    gap = np.zeros((max(WIDTHS), 2), np.int64)
    parts = [p for d in documents for p in (d, gap)]
    starts = np.cumsum([0, *(len(d) + len(gap) for d in documents[:-1])])
    return np.concatenate([*parts, gap]).astype(np.int64), starts


@dataclass
class Learner:
    """A network and the sums of squared gradients that its steps are scaled by, in the order of ``values``."""

    net: Network
    sums: list[np.ndarray]
    sum_bias: float = 1e-3

    @classmethod
    def new(cls, seen: np.ndarray, share: float, rng: np.random.Generator) -> Learner:
        """One that knows the share of the label 1 and has random filters."""
        vectors = np.zeros((len(seen) + 1, EMBEDDING), np.float32)
        filters = [rng.normal(0, 0.5, (w * EMBEDDING, FILTERS)).astype(np.float32) for w in WIDTHS]
        offsets = [np.full(FILTERS, 0.1, np.float32) for _ in WIDTHS]
        weights = rng.normal(0, 0.3, len(WIDTHS) * FILTERS).astype(np.float32)
        share = float(np.clip(share, 1e-3, 1 - 1e-3))
        net = Network(seen, vectors, filters, offsets, weights, float(np.log(share / (1 - share))))
        return cls(net, [np.full(x.shape, 1e-3, np.float32) for x in (vectors, *filters, *offsets, weights)])

    def values(self) -> list[np.ndarray]:
        """All that learning changes."""
        net = self.net
        return [net.vectors, *net.filters, *net.offsets, net.weights, *self.sums, np.array([net.bias, self.sum_bias])]

    def take(self, values: Sequence[np.ndarray]) -> None:
        for old, new in zip(self.values()[:-1], values[:-1], strict=True):
            old[...] = new
        self.net.bias, self.sum_bias = (float(x) for x in values[-1])

    def learn(self, documents: Sequence[np.ndarray], labels: np.ndarray, epochs: int, batch: int, rate: float, rng: np.random.Generator) -> None:
        """Rounds over documents given as pairs of hashes. Gradients flow through the place where each filter responds most."""
        net, sums, slots = self.net, self.sums, np.arange(FILTERS)
        rows = [net.rows_of(d).astype(np.int32) for d in documents]
        for _ in range(epochs):
            order = rng.permutation(len(rows))
            for at in range(0, len(rows), batch):
                own = order[at : at + batch]
                part = [rows[k] for k in own]
                padded, starts = joined(part)
                sizes = [max(len(d), 1) for d in part]
                maps = net.maps(padded)
                places = [np.stack([m[s : s + n].argmax(axis=0) + s for s, n in zip(starts, sizes, strict=True)]) for m in maps]
                peak = np.concatenate([m[p, slots] for m, p in zip(maps, places, strict=True)], axis=1)
                active = np.maximum(peak, 0)
                logit = active @ net.weights + net.bias
                error = ((1 / (1 + np.exp(-np.clip(logit, -40, 40))) - labels[own]) / len(own)).astype(np.float32)
                back = np.outer(error, net.weights) * (peak > 0)
                step(net.weights, active.T @ error, sums[-1], rate)
                g = float(error.sum())
                self.sum_bias += g * g
                net.bias -= rate * g / np.sqrt(self.sum_bias)
                touched, moves = [], []
                for k, w in enumerate(WIDTHS):
                    grad = back[:, k * FILTERS : (k + 1) * FILTERS]
                    ids = padded[places[k][:, :, None] + np.arange(w)]  # document, filter, offset, word and stem
                    word = net.vectors[ids].sum(axis=3).reshape(*grad.shape, w * EMBEDDING)
                    touched.append(ids.reshape(-1))
                    moves.append((grad[:, :, None] * net.filters[k].T[None]).reshape(-1, EMBEDDING).repeat(2, axis=0))
                    step(net.filters[k], np.einsum("bfe,bf->ef", word, grad), sums[1 + k], rate)
                    step(net.offsets[k], grad.sum(axis=0), sums[1 + len(WIDTHS) + k], rate)
                ids, flat = np.unique(np.concatenate(touched), return_inverse=True)
                total = np.zeros((len(ids), EMBEDDING), np.float32)
                np.add.at(total, flat, np.concatenate(moves))
                ids, total = ids[ids > 0], total[ids > 0]
                sums[0][ids] += total**2
                net.vectors[ids] -= rate * total / np.sqrt(sums[0][ids])


def words_of(column) -> list[np.ndarray]:
    """Documents of an Arrow column as pairs of hashes."""
    return [w.values.to_numpy().astype(np.int32).reshape(-1, 2) for w in column]


def parts_of(batches, rows: int, chars: int):
    """Documents and labels of a task, so many together as the bounds allow, sorted by their ids. Columns: id, label, characters, words."""
    held, size = [], 0

    def part():
        held.sort(key=lambda r: r[0])
        return [r[2] for r in held], np.array([r[1] for r in held], float)

    for b in batches:
        for id_, label, n, words in zip(*(b.column(c).to_pylist() for c in range(3)), words_of(b.column(3)), strict=True):
            if held and (len(held) >= rows or size + n > chars):
                yield part()
                held, size = [], 0
            held.append((id_, label, words))
            size += n
    if held:
        yield part()


def packed(weight: int, values: Sequence[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([weight], pa.int64()), pa.array([pickle.dumps(values)], pa.binary())], names=["n", "model"])


def added(batches) -> tuple[int, list[np.ndarray]]:
    """Weights and weighted values of networks, summed one by one."""
    count, total = 0, None
    for b in batches:
        for n, model in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            values = pickle.loads(model.as_buffer())
            count += n
            total = values if total is None else [x + y for x, y in zip(total, values, strict=True)]
    return count, total


def learned_round(
    known: DataFrame, learner: Learner, parts: int, epochs: int, batch: int, rate: float, rows: int, chars: int, rng: np.random.Generator
) -> None:
    """``learner`` becomes the mean of what the tasks make of it, by their documents; a task goes through its own part by part."""
    start = pickle.dumps((learner, rng))

    def learn(batches):
        own, random = pickle.loads(start)
        count = 0
        for documents, labels in parts_of(batches, rows, chars):
            own.learn(documents, labels, epochs, batch, rate, random)
            count += len(labels)
        if count:
            yield packed(count, [x * count for x in own.values()] if parts > 1 else own.values())

    def add(batches):
        count, total = added(batches)
        if total is not None:
            yield packed(count, total)

    models = known.coalesce(parts).mapInArrow(learn, "n bigint, model binary")
    if parts > SUMS:
        models = models.repartition(SUMS).mapInArrow(add, "n bigint, model binary")
    count, total = added(models.toArrow().to_batches())
    learner.take([x / count for x in total] if parts > 1 else total)


def step(value: np.ndarray, gradient: np.ndarray, total: np.ndarray, rate: float) -> None:
    total += gradient**2
    value -= rate * gradient / np.sqrt(total)


def best_threshold(low: np.ndarray, high: np.ndarray, hits: np.ndarray, counts: np.ndarray) -> float | None:
    """The cut with the best F1 between bins of scores, halfway between the two scores it parts; None without labels of both kinds.

    Of each bin: its lowest and highest score, its documents of label 1 and all its documents.
    """
    if not 0 < hits.sum() < counts.sum():
        return None
    order = np.argsort(-low, kind="stable")
    f1 = 2 * np.cumsum(hits[order]) / (np.cumsum(counts[order]) + hits.sum())
    k = int(f1.argmax())
    below = high[order[k + 1]] if k + 1 < len(order) else 0.0
    return float((low[order[k]] + below) / 2)


def held_out(id_: str) -> Column:
    return F.pmod(F.crc32(text_of(F.col(f"`{id_}`").cast("string"))), F.lit(4)) == 2


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    lang: str = "lang",
    rows: int = FIT_ROWS,
    chars: int = FIT_CHARS,
    epochs: int = 4,
    least_steps: int = 500,
    least_documents: int = 3,
    batch: int = 64,
    rate: float = 0.05,
    seed: int = 7,
) -> Network:
    """A network for ``label``, from all documents that have one; a task learns from ``rows`` documents and ``chars`` characters at once,
    from a longer text alone.

    Ids whose CRC-32 leaves 2 over 4 are never looked at. Of several labels or documents of one id the smallest counts. Four fifths of the
    documents train, the others give each language its threshold of best F1. Words in fewer than ``least_documents`` of those that train
    are like words never seen. Small tables get more than ``epochs`` rounds over them: at least ``least_steps`` batches in all.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(id_).isNotNull() & ~held_out(id_))
    known = known.groupBy(F.col(id_).alias("_id")).agg(F.min(F.col(label).cast("int")).alias("_label"))
    own = docs.select(F.col(id_).alias("_doc"), F.col(lang).cast("string").alias("_lang"), text_of(F.col(text)).alias("_text"))
    # texts stay where they are, their words travel
    marked = own.join(F.broadcast(known), F.col("_doc") == F.col("_id")).withColumn("_n", F.length("_text")).withColumn("_hash", F.xxhash64("_text", "_lang"))
    worded = batchwise(marked, ["_text"], "`_words` array<int>", lambda: lambda ts: [[hashed(t) for t in ts]], ["_id", "_label", "_lang", "_n", "_hash"])
    check = F.pmod(F.crc32(F.concat(F.lit("check "), F.col("_id").cast("string"))), F.lit(5)) == 0
    one = worded.groupBy("_id").agg(F.min(F.struct("_label", "_n", "_hash", "_lang", "_words")).alias("_one"))
    every = written(one.select("_id", "_one.*", check.alias("_check")), "labelled")
    teach = every.where("NOT _check").select("_id", "_label", "_n", "_words")
    sums = teach.agg(F.count(F.lit(1)).alias("n"), F.sum("_label").alias("ones"), F.sum("_n").alias("chars")).first()
    seen = teach.select(F.explode(F.array_distinct("_words")).alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    seen = np.sort(seen.where(F.col("n") >= least_documents).select("h").toArrow().column("h").to_numpy().astype(np.int64))
    rng = np.random.default_rng(seed)
    learner = Learner.new(seen, sums["ones"] / sums["n"] if sums["n"] else 0.5, rng)
    net = learner.net
    if not sums["n"] or sums["ones"] in (0, sums["n"]):
        return net
    parts = min(-(-max(sums["n"] * chars, sums["chars"] * rows) // (rows * chars * PARTS)), TASKS)
    times = max(epochs, -(-least_steps * batch // sums["n"]))
    rounds = 1 if sums["n"] <= rows and sums["chars"] <= chars else epochs
    for k in range(rounds):
        learned_round(teach, learner, parts, -(-times // rounds), batch, rate, rows, chars, rng if not k else np.random.default_rng([seed, k]))

    def scores(words):
        return [net.score([np.stack([net.rows_of(x) for x in np.array(w, np.int64).reshape(-1, 2).T], axis=1) for w in words]).astype(float)]

    rated = batchwise(every.where("_check"), ["_words"], "`_score` double", lambda: scores, ["_lang", "_label"])
    ends = [F.min("_score").alias("low"), F.max("_score").alias("high"), F.sum("_label").alias("hits"), F.count(F.lit(1)).alias("n")]
    bins = rated.groupBy(F.coalesce("_lang", F.lit("")).alias("_lang"), F.floor(F.col("_score") / BIN).alias("_bin")).agg(*ends).toArrow()
    of = np.array(bins.column("_lang").to_pylist(), object)
    low, high, hits, counts = (bins.column(c).to_numpy() for c in ("low", "high", "hits", "n"))
    net.threshold = best_threshold(low, high, hits, counts) or net.threshold
    for name in sorted(set(of)):
        at = of == name
        if (cut := best_threshold(low[at], high[at], hits[at], counts[at])) is not None:
            net.thresholds[str(name)] = cut
    return net


def scored(docs: DataFrame, net: Network, text: str = "text", lang: str = "lang", keep: Sequence[str] | None = None) -> DataFrame:
    """``score`` (0 to 1) of every whole text, and ``flagged``: whether it reaches the threshold of the document's language.

    The score looks at the text alone. A null or empty text has no words and gets the score of an empty map; a language without a
    threshold of its own (null too) takes the common one. Repeated rows get the same score, an empty table gives no rows, and columns
    named like the new ones are replaced.
    """

    def make():
        known: dict[bytes, tuple[int, int]] = {}

        def rows(text: str) -> np.ndarray:
            words = WORD.findall(text.lower().encode())
            new = [w for w in set(words) if w not in known]
            if len(known) + len(new) > CACHE:
                known.clear()
                new = list(set(words))
            found = net.rows_of(np.array([pair(w) for w in new], np.int64).reshape(-1, 2))
            known.update(zip(new, map(tuple, found.tolist()), strict=True))
            return np.array([known[w] for w in words], np.int64).reshape(-1, 2)

        def run(texts, langs):
            scores = net.score([rows(t or "") for t in texts]).astype(float)
            cuts = np.array([net.thresholds.get(x or "", net.threshold) for x in langs], float)
            return [scores, scores >= cuts]

        return run

    return batchwise(docs, [text, lang], "score double, flagged boolean", make, keep)
