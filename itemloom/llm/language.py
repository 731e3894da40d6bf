"""Language of a text by rank order: its most frequent n-grams against those of every language, by out-of-place distance.

A profile is the list of the most frequent n-grams (one to three characters of lower-cased words, a blank marking a word's edges). The
distance of a text to a language adds up, for every n-gram of the text's profile, how many places it stands apart from its place in the
language's profile, and the length of that profile where it is missing there.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import batchwise, text_of

#: n-grams of a language's profile, and of a text's
PROFILE, OWN = 1_000, 400
#: characters whose n-grams are counted at once, and n-grams a task holds before it hands them on
CHUNK, HELD = 1 << 18, 1 << 20
UNKNOWN = "und"
_BLANK, _BITS = 32, 21
_OTHER = regex.compile(r"[^\p{L}\p{M}]+")
_LETTER = regex.compile(r"\p{L}")


def ngrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of a whole text, packed into integers in ascending order, and how often each occurs; none without a letter."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not _LETTER.search(text):
        return none
    words = _OTHER.sub(" ", text.lower()).strip(" ")
    points = np.frombuffer(f" {words}  ".encode("utf-32-le", "replace"), np.uint32)
    found = []
    for at in range(0, len(points) - 2, CHUNK):
        a = points[at : at + CHUNK + 2].astype(np.int64)
        a, b, c = a[:-2], a[1:-1], a[2:]
        two = a << _BITS | b
        inside = b != _BLANK
        packed = np.concatenate([a[a != _BLANK], two[inside | (a != _BLANK)], (two << _BITS | c)[inside]])
        found.append(np.unique(packed, return_counts=True))
    return found[0] if len(found) == 1 else added(found)


def added(parts: Sequence[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of several lists of n-grams, put together."""
    grams, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    counts = np.zeros(len(grams), np.int64)
    np.add.at(counts, place, np.concatenate([p[1] for p in parts]))
    return grams, counts


def shown(gram: int) -> str:
    """The characters of a packed n-gram."""
    out = ""
    while gram:
        out, gram = chr(gram & (1 << _BITS) - 1) + out, gram >> _BITS
    return out


def ranked(grams: np.ndarray, counts: np.ndarray, most: int) -> np.ndarray:
    """The ``most`` frequent n-grams, most frequent first, ties by the n-gram."""
    if len(grams) > most:  # a tie at the cut keeps all of its n-grams, so the order below decides
        cut = np.partition(counts, len(counts) - most)[len(counts) - most]
        grams, counts = grams[counts >= cut], counts[counts >= cut]
    return grams[np.lexsort((grams, -counts))[:most]]


@dataclass
class Profiles:
    """``places[l, k]`` is the place of n-gram ``grams[k]`` in the profile of language ``l``, ``size`` where it has none.

    Languages stand in the order in which a tie of distances is settled: the one with more n-grams in training first, then by name.
    """

    languages: list[str]
    grams: np.ndarray
    places: np.ndarray
    size: int

    def distances(self, own: np.ndarray) -> np.ndarray:
        """Out-of-place distance of a text's ranked n-grams to every language, as a share of the largest there can be."""
        at = np.minimum(np.searchsorted(self.grams, own), max(len(self.grams) - 1, 0))
        known = self.grams[at] == own if len(self.grams) else np.zeros(len(own), bool)
        there = self.places[:, at[known]]
        apart = np.where(there < self.size, np.abs(there - np.flatnonzero(known)), self.size).sum(axis=1)
        return (apart + self.size * int((~known).sum())) / (self.size * max(len(own), 1))


def held_out(id_: str) -> Column:
    return F.pmod(F.crc32(text_of(F.col(f"`{id_}`").cast("string"))), F.lit(3)) == 1


def counted(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """``lang, gram, n``: how often each n-gram occurs in the texts of each language, over all rows with a language.

    Tasks add up what they read and hand it on when they hold ``HELD`` n-grams; the sums are combined by the shuffle.
    """
    own = docs.where(F.col(f"`{lang}`").isNotNull()).select(F.col(f"`{lang}`").cast("string"), text_of(F.col(f"`{text}`")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        size = 0

        def handed():
            for name, parts in held.items():
                grams, counts = added(parts)
                yield pa.RecordBatch.from_pydict({"lang": [name] * len(grams), "gram": grams, "n": counts})

        for batch in batches:
            for k in range(batch.num_rows):
                part = ngrams(batch.column(1)[k].as_py())
                mine = held.setdefault(batch.column(0)[k].as_py(), [])
                mine.append(part)
                size += len(part[0])
                if len(mine) >= 64:
                    size -= sum(len(p[0]) for p in mine)
                    mine[:] = [added(mine)]
                    size += len(mine[0][0])
                if size >= HELD:
                    yield from handed()
                    held, size = {}, 0
        yield from handed()

    return own.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, id_: str = "doc_id", text: str = "text", lang: str = "lang", size: int = PROFILE) -> Profiles:
    """Profiles of all languages, from every document with a language whose id's CRC-32 does not leave 1 over 3.

    The driver gets ``size`` n-grams a language and nothing that grows with the documents. A null id counts as the empty text. Without
    such documents, or without a letter in them, there are no languages.
    """
    counts = counted(docs.where(~held_out(id_)), text, lang)
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    best = counts.withColumn("place", place).where(F.col("place") <= size).toArrow().to_pylist()
    weight: dict[str, int] = {}
    for r in best:
        weight[r["lang"]] = weight.get(r["lang"], 0) + r["n"]
    languages = sorted(weight, key=lambda name: (-weight[name], name))
    grams = np.unique(np.array([r["gram"] for r in best], np.int64))
    places = np.full((len(languages), len(grams)), size, np.int32)
    row = {name: k for k, name in enumerate(languages)}
    for r in best:
        places[row[r["lang"]], np.searchsorted(grams, r["gram"])] = r["place"] - 1
    return Profiles(languages, grams, places, size)


def identified(docs: DataFrame, profiles: Profiles, text: str = "text", keep: Sequence[str] | None = None, own: int = OWN) -> DataFrame:
    """``lang_pred``, the language with the least distance to the whole text, and ``score`` (0 to 1), how close it is.

    The score is one less the distance as a share of the largest there can be; ``margin`` is the distance by which the next language
    is farther away (0 where there is none). Only the text is looked at. A null text and a text without a letter, blanks and digits
    say, are ``und`` with a score of 0, and so is every text when nothing was learned. Ties go to the language with more n-grams in
    training, then to the lesser name. Repeated rows get the same result, an empty table gives no rows, and columns named like the new
    ones are replaced.
    """

    def run(texts):
        names, scores, margins = [], [], []
        for value in texts:
            grams, counts = ngrams(value or "")
            if not len(grams) or not profiles.languages:
                names.append(UNKNOWN), scores.append(0.0), margins.append(0.0)
                continue
            apart = profiles.distances(ranked(grams, counts, own))
            best, *others = np.argsort(apart, kind="stable")[:2].tolist()
            names.append(profiles.languages[best])
            scores.append(float(1 - apart[best]))
            margins.append(float(apart[others[0]] - apart[best]) if others else 0.0)
        return [names, scores, margins]

    return batchwise(docs, [text], "lang_pred string, score double, margin double", lambda: run, keep)
