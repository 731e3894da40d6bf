"""Quality rules: boosted trees over statistics of each document, below fixed rules that reject outright."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batchwise
from .trees import Forest, boost

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\r\x0b\x0c"
#: statistics a model sees, and whether its score may only rise (+1) or only fall (-1) with them
FEATURES = {
    "log_words": 0,
    "word_length": 0,
    "symbols_per_word": -1,
    "dup_line_share": -1,
    "repeat_share": -1,
    "distinct_share": 0,
    "upper_share": -1,
    "digit_share": 0,
    "exclamations_per_word": -1,
    "pipes_per_word": -1,
    "stops_per_word": 0,
    "words_per_line": 0,
    "longest_word": 0,
    "non_ascii_share": 0,
}
BASE = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"
#: labelled documents that a model is fitted on at most
FIT_ROWS = 20_000


def repeated_words(words: list[bytes]) -> tuple[int, int]:
    """Distinct words, and words inside three-word windows that occur twice or more."""
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    n = len(ids) - 2
    if n < 2:
        return len(number), 0
    _, pair = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)
    _, window, counts = np.unique(pair[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True)
    twice = counts[window] > 1
    covered = np.zeros(n + 2, bool)
    for shift in range(3):
        covered[shift : shift + n] |= twice
    return len(number), int(covered.sum())


def statistics(text: str) -> tuple[list[int], list[float]]:
    """The counts of ``BASE`` and the values of ``FEATURES`` of one text."""
    raw = text.encode()
    words = raw.split()  # bytes split at exactly these blanks: space and 9 to 13
    n, chars = len(words), len(text) - sum(map(text.count, BLANKS))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    duplicates = len(lines) - len(set(lines))
    distinct, repeats = repeated_words(words)
    codes = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    per, rows, size = max(n, 1), max(len(lines), 1), max(len(raw), 1)
    values = [
        np.log1p(n),
        chars / per,
        symbols / per,
        duplicates / rows,
        repeats / per,
        distinct / per,
        codes[65:91].sum() / size,
        codes[48:58].sum() / size,
        codes[33] / per,
        codes[124] / per,
        codes[[44, 46, 59, 63]].sum() / per,
        n / rows,
        max(map(len, words), default=0),
        codes[128:].sum() / size,
    ]
    return [n, chars, symbols, duplicates, repeats], [float(v) for v in values]


def measured(docs: DataFrame, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """The counts of ``BASE`` and ``features array<double>`` of every text; a null text has no words."""

    def make():
        def run(texts):
            found = [statistics(t or "") for t in texts]
            return [*([b[i] for b, _ in found] for i in range(5)), [f for _, f in found]]

        return run

    return batchwise(docs, [text], f"{BASE}, features array<double>", make, keep)


def fit(
    docs: DataFrame, labels: DataFrame, id_: str = "doc_id", text: str = "text", label: str = "quality", rows: int = FIT_ROWS, **how
) -> Forest:
    """A model of ``label`` (1: good) from at most ``rows`` labelled documents, those whose id hashes lowest.

    Rows without a label or an id do not count; of several labels or documents of one id the smallest counts. Without labels of
    both kinds the model gives every document the same score (0.5 without any).
    """
    known = labels.where(F.col(label).isNotNull() & F.col(id_).isNotNull())
    known = known.groupBy(F.col(id_).alias("_id")).agg(F.min(F.col(label).cast("int")).alias("_label"))
    sample = known.orderBy(F.xxhash64("_id"), "_id").limit(rows)
    chosen = docs.select(F.col(id_).alias("_doc"), F.col(text).alias("_text")).join(F.broadcast(sample), F.col("_doc") == F.col("_id"))
    seen = measured(chosen, "_text", ["_id", "_label"]).groupBy("_id").agg(F.min(F.struct("_label", "features")).alias("_one"))
    got = seen.select("_id", "_one.*").orderBy("_id").toArrow()
    if not got.num_rows:
        return boost(np.zeros((0, len(FEATURES))), np.zeros(0), list(FEATURES.values()))
    x = np.array(got.column("features").to_pylist())
    return boost(x, np.array(got.column("_label").to_pylist(), float), list(FEATURES.values()), **how)


def judged(
    docs: DataFrame,
    model: Forest,
    text: str = "text",
    keep: Sequence[str] | None = None,
    least_words: int = 50,
    most_repeated: float = 0.5,
    threshold: float = 0.5,
) -> DataFrame:
    """The counts of ``BASE``, ``base_failed``, ``quality_score`` (0 to 1) and ``kept`` of every document.

    ``base_failed``: fewer than ``least_words`` words, or more than that share of words in repeated three-word windows. ``kept`` is
    false for those, and otherwise whether the model's score reaches ``threshold``. A null or empty text has no words and fails.
    Repeated rows are each judged, an empty table gives no rows, and columns named like the new ones are replaced.
    """
    judge = _judge(model, least_words, most_repeated, threshold)
    return batchwise(docs, [text], f"{BASE}, base_failed boolean, quality_score double, kept boolean", lambda: judge, keep)


def kept_only(docs: DataFrame, model: Forest, text: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns and in one pass.

    Null, empty and short texts are rejected, repeated rows are each judged, long texts whole; an empty table gives no rows. The columns
    of ``docs`` come back as they are, whatever they are called.
    """
    least, most, threshold = how.get("least_words", 50), how.get("most_repeated", 0.5), how.get("threshold", 0.5)
    judge = _judge(model, least, most, threshold)
    mark = "_kept_"
    while mark.lower() in {c.lower() for c in docs.columns}:
        mark += "_"
    return batchwise(docs, [text], f"`{mark}` boolean", lambda: lambda texts: [judge(texts)[-1]], only=mark)


def _judge(model: Forest, least_words: int, most_repeated: float, threshold: float):
    def run(texts):
        found = [statistics(t or "") for t in texts]
        base = np.array([b for b, _ in found], np.int64).reshape(-1, 5)
        failed = (base[:, 0] < least_words) | (base[:, 4] > most_repeated * base[:, 0])
        score = model.probability(np.array([f for _, f in found]).reshape(-1, len(FEATURES)))
        return [*base.T, failed, score, ~failed & (score >= threshold)]

    return run

