"""Quality by co-training: a classifier of the text and one of the page's metadata teach each other, then score every document together."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batchwise, written

SHAPES, META = 1024, 256
#: content statistics, each in so many steps
STEPS = 12
#: labelled documents that models are fitted on at most, and pseudo-labelled ones that a view takes of either kind in a round
FIT_ROWS, TAUGHT = 4_000, 500
#: steps of the histogram of scores from which the surest share is read
BINS = 4_096
#: what a byte counts as in a text's shape: a kind of letter, a digit, a blank, or itself
_CLASS = np.arange(256, dtype=np.int64)
_CLASS[65:91], _CLASS[97:123], _CLASS[128:], _CLASS[48:58], _CLASS[9:14] = 65, 97, 97, 48, 32
_CLASS[10] = 10


def content(text: str) -> np.ndarray:
    """The text's view: shares of three-character shapes (runs of one kind of character count once), and steps of word statistics."""
    raw = text.encode()
    out = np.zeros(SHAPES + 3 * STEPS, np.float32)
    kinds = _CLASS[np.frombuffer(raw, np.uint8)]
    kinds = kinds[np.r_[True, kinds[1:] != kinds[:-1]]] if len(kinds) else kinds
    if len(kinds) > 2:
        grams = (kinds[:-2] * 31 + kinds[1:-1]) * 31 + kinds[2:]
        out[:SHAPES] = np.sqrt(np.bincount(grams * 2654435761 % 4294967296 % SHAPES, minlength=SHAPES) / len(grams))
    words = raw.lower().split()
    n = len(words)
    counts = Counter(words)
    levels = (np.log2(1 + n), STEPS * len(counts) / max(n, 1), STEPS * max(counts.values(), default=0) / max(n, 1))
    for k, level in enumerate(levels):
        out[SHAPES + k * STEPS + min(int(level), STEPS - 1)] = 1
    return out


def metadata(source: str | None, lang: str | None, size: int | None) -> np.ndarray:
    """The page's view: hashed source and language, and the step of its stated size; a null is a value like others."""
    out = np.zeros(META, np.float32)
    step = "none" if size is None else str(int(2 * np.log2(1 + max(int(size), 0))))
    for value in (f"source {source}", f"lang {lang}", f"size {step}"):
        out[zlib.crc32(value.encode()) % META] = 1
    return out


@dataclass
class Line:
    """A logistic model: weights, and the line that makes its margins calibrated log-odds."""

    weights: np.ndarray
    bias: float
    slope: float = 1.0
    start: float = 0.0

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.slope * (x @ self.weights + self.bias) + self.start


@dataclass
class Views:
    text: Line
    meta: Line
    both: Line

    def scores(self, text: np.ndarray, meta: np.ndarray) -> list[np.ndarray]:
        a, b = self.text.margin(text), self.meta.margin(meta)
        return [sigmoid(a), sigmoid(b), sigmoid(self.both.margin(np.stack([a, b], axis=1)))]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 100, rate: float = 0.2, ridge: float = 1e-4, start: Line | None = None) -> Line:
    """Least log-loss with a small ridge, by Adam over all rows. Labels of one kind give that kind's share for every row."""
    share = float(np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3))
    w = np.r_[start.weights, start.bias] if start else np.r_[np.zeros(x.shape[1]), np.log(share / (1 - share))]
    if not len(y) or y.min() == y.max():
        return Line(w[:-1] * 0, float(np.log(share / (1 - share))))
    w, y = w.astype(x.dtype), y.astype(x.dtype)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, rounds + 1):
        error = (sigmoid(x @ w[:-1] + w[-1]) - y) / len(y)
        g = np.r_[x.T @ error + ridge * w[:-1], error.sum()]
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g**2
        w = w - (rate / (1 - 0.9**t)) * m / (np.sqrt(v / (1 - 0.99**t)) + 1e-8).astype(x.dtype)
    return Line(w[:-1], float(w[-1]))


def calibrated(line: Line, x: np.ndarray, y: np.ndarray) -> Line:
    """The model with margins that are log-odds on rows it was not fitted on; a slope that is not positive becomes none."""
    if len(y) and y.min() != y.max():
        fit = logistic(line.margin(x)[:, None], y, ridge=1e-3)
        line.slope, line.start = (float(fit.weights[0]), fit.bias) if fit.weights[0] > 0 else (0.0, float(np.log(y.mean() / (1 - y.mean()))))
    return line


#: what one view hands to the other: ids, rows of the text's and of the page's view, and labels
Taught = tuple[list, np.ndarray, np.ndarray, np.ndarray]


def teach(text: np.ndarray, meta: np.ndarray, y: np.ndarray, surest: Callable[[Line, Line], tuple[Taught, Taught]] | None, rounds: int = 4) -> Views:
    """Two classifiers that exchange pseudo-labels.

    In each round ``surest`` gives the unlabelled documents that each of the two calibrated views is most sure of, with its label; they
    go to the other view, which keeps the first label it was given for a document, and both are fitted again. A fifth of the labelled
    rows is kept aside for the calibration of both views and for the weights with which they are put together.
    """
    aside = np.arange(len(y)) % 5 == 0
    own = (text, meta)
    given: list[dict] = [{}, {}]
    lines: list[Line | None] = [None, None]
    for turn in range(rounds + 1):
        for k, x in enumerate(own):
            more = [given[k][i] for i in sorted(given[k])]
            rows = np.stack([r for r, _ in more]) if more else x[:0]
            lines[k] = logistic(np.concatenate([x[~aside], rows]), np.r_[y[~aside], [label for _, label in more]], start=lines[k])
        if turn == rounds or surest is None:
            break
        views = [calibrated(Line(line.weights, line.bias), x[aside], y[aside]) for line, x in zip(lines, own, strict=True)]
        for k, (ids, *rows, labels) in enumerate(surest(*views)):
            for i, row, label in zip(ids, rows[1 - k], labels.tolist(), strict=True):
                given[1 - k].setdefault(i, (row, label))
    a, b = (calibrated(line, x[aside], y[aside]) for line, x in zip(lines, own, strict=True))
    both = logistic(np.stack([a.margin(text[aside]), b.margin(meta[aside])], axis=1), y[aside], ridge=1e-3)
    both.weights = np.maximum(both.weights, 0)  # a view may count for nothing, but never against itself
    return Views(a, b, both)


def cuts(counts: np.ndarray, share: float, sure: float) -> tuple[int, int]:
    """From a histogram of scores: the bin from which on a document is among the surest ``share``, and the one up to which it is among the
    least sure; never below ``sure`` or above the rest of it."""
    most = max(1, int(share * counts.sum()))
    high = int(np.searchsorted(-np.cumsum(counts[::-1])[::-1], -most, side="right")) - 1
    low = int(np.searchsorted(np.cumsum(counts), most))
    return max(high, int(np.ceil(sure * BINS))), min(low, int(np.floor((1 - sure) * BINS)) - 1)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_: str = "doc_id",
    text: str = "text",
    source: str = "source",
    lang: str = "lang",
    size: str = "n_chars",
    label: str = "quality",
    rows: int = FIT_ROWS,
    share: float = 0.05,
    sure: float = 0.9,
    taught: int = TAUGHT,
    **how,
) -> Views:
    """Views fitted on at most ``rows`` labelled documents, those whose id hashes lowest, and taught by all others.

    In every round both views score every document without a label, wherever it is stored; the surest ``share`` in either direction
    follows from a histogram of all scores. Only the rows that are handed on are bounded: ``taught`` of either kind a view and round,
    the surest first. Rows without an id do not count; of several labels or documents of one id the smallest counts. Without labels of
    both kinds all documents get the same score.
    """
    own = docs.where(F.col(id_).isNotNull())
    known = labels.where(F.col(label).isNotNull() & F.col(id_).isNotNull())
    known = known.groupBy(F.col(id_).alias("_id")).agg(F.min(F.col(label).cast("int")).alias("_label"))
    sample = known.orderBy(F.xxhash64("_id"), "_id").limit(rows)
    fields = {"_doc": id_, "_text": text, "_source": source, "_lang": lang, "_size": size}
    whole = own.select(*(F.col(f"`{c}`").alias(n) for n, c in fields.items()))
    a, b, found = _features(whole.join(F.broadcast(sample), F.col("_doc") == F.col("_id")))
    y = np.array(found.column("_label").to_pylist(), float)
    def surest(first: Line, second: Line) -> tuple[Taught, Taught]:
        # scores leave the labelled documents out, not texts: those would travel
        scores = _scores(whole, first, second).join(known.select("_id"), F.col("_doc") == F.col("_id"), "left_anti")
        scores = written(scores, "cotraining")
        parts = []
        for name in ("_p", "_q"):
            place = F.least(F.floor(F.col(name) * BINS), F.lit(BINS - 1)).cast("int")
            counts = np.zeros(BINS, np.int64)
            for r in scores.groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n")).collect():
                counts[r["bin"]] = r["n"]
            high, low = cuts(counts, share, sure)
            keyed = scores.select(F.col("_doc").alias("_id"), F.col(name).alias("_score"))
            good = keyed.where(place >= high).orderBy(F.desc("_score"), F.xxhash64("_id"), "_id").limit(taught)
            bad = keyed.where(place <= low).orderBy("_score", F.xxhash64("_id"), "_id").limit(taught)
            chosen = good.select("_id", F.lit(1).alias("_label")).unionByName(bad.select("_id", F.lit(0).alias("_label")))
            x, z, got = _features(whole.join(F.broadcast(chosen), F.col("_doc") == F.col("_id")))
            parts.append((got.column("_id").to_pylist(), x, z, np.array(got.column("_label").to_pylist(), float)))
        return parts[0], parts[1]

    return teach(a, b, y, surest if len(y) and y.min() != y.max() else None, **how)


def _features(joined: DataFrame):
    """Rows of both views and the table of ``_id, _label``, by id; of several documents of one id the least counts."""
    seen = both_views(joined, "_text", "_source", "_lang", "_size", ["_id", "_label"])
    one = seen.groupBy("_id").agg(F.min(F.struct("_label", "_content", "_meta")).alias("_one")).select("_id", "_one.*")
    got = one.toArrow().sort_by("_id")
    return _matrix(got.column("_content"), SHAPES + 3 * STEPS), _matrix(got.column("_meta"), META), got


def _scores(df: DataFrame, first: Line, second: Line) -> DataFrame:
    """``_p`` and ``_q``: what the two views think of every document."""

    def run(texts, sources, langs, sizes):
        p = sigmoid(first.margin(np.stack([content(t or "") for t in texts]))).astype(float)
        q = sigmoid(second.margin(np.stack([metadata(*m) for m in zip(sources, langs, sizes, strict=True)]))).astype(float)
        return [p, q]

    return batchwise(df, ["_text", "_source", "_lang", "_size"], "`_p` double, `_q` double", lambda: run, ["_doc"])


def _matrix(column, width: int) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.float32), *(c.flatten().to_numpy() for c in column.chunks)]).reshape(-1, width)


def both_views(df: DataFrame, text: str, source: str, lang: str, size: str, keep: Sequence[str]) -> DataFrame:
    def run(texts, sources, langs, sizes):
        return [[content(t or "") for t in texts], [metadata(*m) for m in zip(sources, langs, sizes, strict=True)]]

    return batchwise(df, [text, source, lang, size], "`_content` array<float>, `_meta` array<float>", lambda: run, keep)


def scored(
    docs: DataFrame,
    views: Views,
    text: str = "text",
    source: str = "source",
    lang: str = "lang",
    size: str = "n_chars",
    keep: Sequence[str] | None = None,
    threshold: float = 0.5,
) -> DataFrame:
    """``text_score``, ``meta_score`` and ``quality_score`` (0 to 1) of every document, and ``kept``: the last reaches ``threshold``.

    A null text is the empty one, a null of the metadata a value of its own. Repeated rows get the same scores, an empty table gives no
    rows, and columns named like the new ones are replaced.
    """

    def run(texts, sources, langs, sizes):
        a = np.stack([content(t or "") for t in texts])
        b = np.stack([metadata(*m) for m in zip(sources, langs, sizes, strict=True)])
        found = views.scores(a, b)
        return [*(s.astype(float) for s in found), found[2] >= threshold]

    outputs = "text_score double, meta_score double, quality_score double, kept boolean"
    return batchwise(docs, [text, source, lang, size], outputs, lambda: run, keep)
