"""Personal data in DataFrame functions only: fixed patterns, and terms that reveal what the patterns found.

Patterns give the protected entities of a document. How strongly a term in a document of an entity reveals it is estimated from the
corpus: with ``I(e) = -log2(n(e) / N)``, what an entity tells, and ``PMI(e; t)``, how much of that a term tells, a term discloses an
entity when no more than ``residual`` bits stay hidden and at least half of the information is out. All places of such terms in a
document of the entity are spans of their own; ``sanitised`` generalises or removes them together with the entities.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import carried, field, restored, text_of, written


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    #: cheap test that every text with a match passes
    guard: Callable[[Column], Column]
    valid: Callable[[Column], Column]


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a text of digits passes: every second digit from the right doubled, nines cast out, the sum a multiple of ten."""
    size = F.length(digits)

    def add(total: Column, at: Column) -> Column:
        digit = F.substr(digits, size - at, F.lit(1)).cast("int")
        doubled = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return total + F.when(at % 2 == 1, doubled).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(0), size - 1), F.lit(0), add) % 10 == 0


def _card(match: Column) -> Column:
    return _let(_digits(match), lambda d: F.when(F.length(d).between(14, 19), luhn(d)).otherwise(False))


PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
# Possessive loops never give back what they took; here that changes no match, as what follows cannot start inside of it. A match can
# only start where a run of its first class starts, or where the match before it ended (\G): other starts are not tried.
LOCAL = "[A-Za-z0-9._%+-]"
KINDS = (
    Kind(
        "email",
        rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        lambda t: F.contains(t, F.lit("@")),
        lambda m: F.lit(True),
    ),
    Kind(
        "ip",
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        lambda t: F.rlike(t, F.lit(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]")),
        lambda m: F.rlike(m, F.lit(rf"\A{PART}(?:\.{PART}){{3}}\z")),
    ),
    Kind("card", r"[0-9](?:[ -]?[0-9])++", lambda t: F.rlike(t, F.lit(r"[0-9](?:[ -]?[0-9]){13}")), _card),
    Kind(
        "phone",
        r"\+[0-9][ ().0-9-]+[0-9]",
        lambda t: F.contains(t, F.lit("+")),
        lambda m: F.length(_digits(m)).between(10, 15),
    ),
)
TERM = r"[\p{L}\p{M}]{3,}"
TERM_KIND = "term"
NAMES = [*(k.name for k in KINDS), TERM_KIND]
#: matches whose places are added up together, and code points that are rewritten together
BLOCK, CHUNK = 64, 2048
#: rounds that Catalyst may take to resolve a query
ROUNDS = 400


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def located(text: Column, pattern: str) -> Column:
    """All matches of a pattern, left to right: start and end (code points, end exclusive), and value.

    The places follow from the lengths of the matches and of the pieces between them.
    """
    pieces, matches = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def joined(m: Column, p: Column) -> Column:
        return F.struct(m.alias("value"), (F.length(p) + F.length(m)).cast("bigint").alias("size"))

    def zipped(p: Column) -> Column:
        return F.filter(F.zip_with(matches, p, joined), lambda x: x["value"].isNotNull())

    def shaped(x: Column, end: Column) -> Column:
        return F.struct((end - F.length(x["value"])).alias("start"), end.alias("end"), x["value"].alias("value"))

    def chunk_ends(before: Column, chunk: Column) -> Column:
        upto = lambda i: F.aggregate(F.slice(chunk, 1, i + 1), before, lambda a, x: a + x["size"])
        return F.transform(chunk, lambda x, i: shaped(x, upto(i)))

    # ends are running sums: of the chunks first, then inside of each, so that no state grows with the matches
    def placed(chunks: Column) -> Column:
        total = lambda chunk: F.aggregate(chunk, F.lit(0).cast("bigint"), lambda a, x: a + x["size"])
        zero = F.lit(0).cast("bigint")
        ahead = lambda sums, c: F.aggregate(F.slice(sums, 1, c), zero, lambda a, x: a + x)
        return _let(
            F.transform(chunks, total),
            lambda sums: F.flatten(F.transform(chunks, lambda chunk, c: _let(ahead(sums, c), lambda o: chunk_ends(o, chunk)))),
        )

    def chunked(each: Column) -> Column:
        starts = F.when(F.size(each) > 0, F.sequence(F.lit(1), F.size(each), F.lit(BLOCK))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda at: F.slice(each, at, BLOCK))

    return _let(_let(_let(pieces, zipped), chunked), placed)


def base_spans(text: Column) -> Column:
    """The spans of all kinds, sorted by start and then by kind: ``start, kind`` (its place in ``NAMES``), ``end, value``."""

    def of(number: int, kind: Kind) -> Column:
        kept = F.filter(located(text, kind.pattern), lambda x: kind.valid(x["value"]))
        shaped = F.transform(
            kept, lambda x: F.struct(x["start"].alias("start"), F.lit(number).alias("kind"), x["end"].alias("end"), x["value"].alias("value"))
        )
        return F.when(kind.guard(text), shaped).otherwise(F.array().cast(SPANS))

    return F.array_sort(F.concat(*(of(i, k) for i, k in enumerate(KINDS))))


SPANS = "array<struct<start:bigint,kind:int,end:bigint,value:string>>"


def chunked(text: Column) -> Column:
    """The text in pieces of ``CHUNK`` code points."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))


def in_blocks(spans: Column) -> Column:
    """Sorted spans in blocks of ``BLOCK``."""
    starts = F.when(F.size(spans) > 0, F.sequence(F.lit(1), F.size(spans), F.lit(BLOCK))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda at: F.slice(spans, at, BLOCK))


def rewritten(text: Column, spans: Column, shown: Callable[..., Column]) -> Column:
    """The text with sorted spans replaced, in time that grows with the text.

    It is rewritten piece by piece, and a piece looks at the blocks of spans that reach it. ``shown`` gives what stands for the part of
    a span in a piece that no span before has covered: of the piece, the span, the part's start and end in the piece, and whether the
    span starts there. Of a covered part nothing stands.
    """

    def bounded(b: Column) -> Column:
        most = F.array_max(F.transform(b, lambda s: s["end"]))
        return F.struct(b[0]["start"].alias("low"), most.alias("high"), b.alias("spans"))

    def piece(chunk: Column, number: Column, blocks: Column) -> Column:
        low, size = number.cast("bigint") * CHUNK, F.length(chunk).cast("bigint")
        near = F.filter(blocks, lambda b: (b["low"] < low + size) & (b["high"] > low))
        own = F.filter(F.flatten(F.transform(near, lambda b: b["spans"])), lambda s: (s["start"] < low + size) & (s["end"] > low))

        def step(acc: Column, s: Column) -> Column:
            start, end = F.greatest(s["start"] - low, acc["at"]), F.least(s["end"] - low, size)
            between = F.substr(chunk, (acc["at"] + 1).cast("int"), (start - acc["at"]).cast("int"))
            part = F.when(end > start, F.concat(between, shown(chunk, s, start, end, s["start"] - low >= acc["at"]))).otherwise("")
            return F.struct(F.greatest(acc["at"], end).alias("at"), F.concat(acc["out"], part).alias("out"))

        begin = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))
        done = lambda acc: F.concat(acc["out"], F.substr(chunk, (acc["at"] + 1).cast("int")))
        return F.when(F.size(near) > 0, F.aggregate(own, begin, step, done)).otherwise(chunk)

    def whole(blocks: Column) -> Column:
        return F.array_join(F.transform(chunked(text), lambda chunk, number: piece(chunk, number, blocks)), "")

    return F.when(F.size(spans) > 0, _let(F.transform(in_blocks(spans), bounded), whole)).otherwise(text)


def blanked(text: Column, spans: Column) -> Column:
    """The text with blanks in place of its spans, so that all other places stay."""
    return rewritten(text, spans, lambda chunk, s, start, end, first: F.repeat(F.lit(" "), (end - start).cast("int")))


def _terms(text: Column, spans: Column) -> Column:
    """All words outside of the spans of a text that has some: ``term, start, end``."""
    words = F.transform(
        located(blanked(text, spans), TERM), lambda x: F.struct(F.lower(x["value"]).alias("term"), x["start"].alias("start"), x["end"].alias("end"))
    )
    return F.when(F.size(spans) > 0, words)


def _entities(spans: Column) -> Column:
    return F.array_distinct(F.transform(spans, lambda s: F.concat_ws(":", s["kind"].cast("string"), F.lower(s["value"]))))


def text_key(id_: Column, text: Column) -> list[Column]:
    """Two digests that rows share only if id and text are the same."""
    return [F.xxhash64(F.lit(1), id_, text).alias("_k1"), F.xxhash64(F.lit(2), text, id_).alias("_k2")]


def disclosing(seen: DataFrame, texts: DataFrame, residual: float, support: int) -> DataFrame:
    """``_k1, _k2, terms``: the sorted places of all terms that reveal an entity of their document, by counts over the whole corpus.

    ``seen`` has ``entities`` and ``words`` of every document, ``texts`` its ``_text``. Copies of a text count as documents, but as
    evidence they are one: at least ``support`` different texts must show the pair.
    """
    documents, each = texts.count(), ["_k1", "_k2"]
    held = seen.select(*each, "_text_key", F.explode("entities").alias("entity")).groupBy(*each, "_text_key", "entity").agg(F.count(F.lit(1)).alias("n"))
    known = held.groupBy("entity", "_text_key").agg(F.sum("n").alias("n")).groupBy("entity")
    known = known.agg(F.sum("n").alias("n_entity"), F.count(F.lit(1)).alias("n_texts")).where(F.col("n_texts") >= support)
    known = written(known.where(F.col("n_entity") < documents).select("entity", "n_entity"), "pii")
    most = known.agg(F.max("n_entity")).first()[0] or 0
    words = F.array_distinct(F.split(F.lower("_text"), r"[^\p{L}\p{M}]+"))
    spread = texts.select(F.explode(words).alias("term")).where(F.length("term") >= 3)
    # n_both is at most n_entity, so a term of more than 2 ** residual times as many documents leaves too much hidden: exact, not a cut
    times = 2.0**residual
    counts = spread.groupBy("term").agg(F.count(F.lit(1)).alias("n_term")).where((F.col("n_term") >= support) & (F.col("n_term") <= most * times))
    places = seen.select(*each, F.explode("words").alias("w")).select(*each, "w.*").join(counts, "term")
    places = written(places.groupBy(*each, "term", "n_term").agg(F.collect_set(F.struct("start", "end")).alias("places")), "pii")
    pairs = places.drop("places").join(held.join(known, "entity"), each).where(F.col("n_term") <= F.col("n_entity") * times)
    pairs = written(pairs.select(*each, "_text_key", "entity", "term", "n", "n_entity", "n_term"), "pii")
    joint = pairs.groupBy("entity", "term", "n_entity", "n_term", "_text_key").agg(F.sum("n").alias("n"))
    joint = joint.groupBy("entity", "term", "n_entity", "n_term").agg(F.sum("n").alias("n_both"), F.count(F.lit(1)).alias("n_texts"))
    told = F.log2(F.lit(float(documents)) / F.col("n_entity"))
    shared = F.log2(F.col("n_both") * float(documents) / (F.col("n_entity") * F.col("n_term")))
    enough = (F.col("n_texts") >= support) & (shared >= told - residual) & (shared >= told / 2)
    reveal = joint.where(enough).select("entity", "term")
    hidden = pairs.join(reveal, ["entity", "term"], "left_semi").select(*each, "term").distinct()
    spans = places.join(hidden, [*each, "term"], "left_semi").select(*each, F.explode("places").alias("p"))
    span = F.struct(F.col("p.start").alias("start"), F.lit(len(KINDS)).alias("kind"), F.col("p.end").alias("end"))
    return spans.groupBy(*each).agg(F.array_sort(F.collect_set(span)).alias("terms"))


def _joined(spans: Column) -> Column:
    named = lambda s: F.concat_ws(":", F.element_at(F.array(*map(F.lit, NAMES)), s["kind"] + 1), s["start"], s["end"])
    return F.concat_ws(",", F.transform(spans, named))


def _room(docs: DataFrame) -> None:
    """Lets Catalyst resolve functions inside of functions to the depth that they have here: each level takes it a few rounds."""
    conf, setting = docs.sparkSession.conf, "spark.sql.analyzer.maxIterations"
    if int(conf.get(setting, "100")) < ROUNDS:
        conf.set(setting, str(ROUNDS))


def spans_found(docs: DataFrame, id_: str = "doc_id", text: str = "text", residual: float = 1.0, support: int = 2) -> DataFrame:
    """Narrow and written: ``_k1, _k2`` of id and text, ``id_``, and ``base`` and ``terms``, sorted arrays of spans."""
    _room(docs)
    own = docs.select(F.col(f"`{id_}`"), text_of(F.col(f"`{text}`")).alias("_text"))
    keyed = own.select(f"`{id_}`", *text_key(F.col(f"`{id_}`"), F.col("_text")), "_text", base_spans(F.col("_text")).alias("_spans"))
    base = F.transform("_spans", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    found = [base.alias("base"), _entities(F.col("_spans")).alias("entities"), _terms(F.col("_text"), F.col("_spans")).alias("words")]
    seen = written(keyed.select(f"`{id_}`", "_k1", "_k2", F.xxhash64("_text").alias("_text_key"), *found), "pii")
    marked = disclosing(seen.where(F.size("entities") > 0), own, residual, support)
    return seen.select(f"`{id_}`", "_k1", "_k2", "base").join(marked, ["_k1", "_k2"], "left")


def found(docs: DataFrame, id_: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """Per document: its id, ``n_email, n_ip, n_card, n_phone``, ``base_sha256`` of the base spans, ``n_term``, and ``spans``, all of them.

    Spans are ``kind:start:end`` in code points, end exclusive, sorted by start and then kind, joined by commas. A null text is the empty
    one and has none. Repeated rows get the same spans; equal matches of two kinds are two spans; an empty table gives no rows. Other
    columns of ``docs`` are not read.
    """
    seen = spans_found(docs, id_, text, **how)
    every = F.when(F.col("terms").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "terms")))
    count = lambda i: F.size(F.filter("base", lambda s: s["kind"] == i)).cast("long")
    return seen.select(
        f"`{id_}`",
        *(count(i).alias(f"n_{k.name}") for i, k in enumerate(KINDS)),
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        F.coalesce(F.size("terms"), F.lit(0)).cast("long").alias("n_term"),
        _joined(every).alias("spans"),
    )


def masked(text: Column, spans: Column) -> Column:
    """The text with every span replaced: entities by the name of their kind, capitalised terms by a general word, other terms by nothing.

    Of overlapping spans the first names the whole.
    """

    def shown(chunk: Column, s: Column, start: Column, end: Column, first: Column) -> Column:
        initial = F.substr(chunk, (start + 1).cast("int"), F.lit(1))
        general = F.when(F.rlike(initial, F.lit(r"\A\p{Lu}")), F.lit("[NAME]")).otherwise(F.lit(""))
        names = F.array(*(F.lit(f"[{k.name.upper()}]") for k in KINDS))
        # a span is named where it starts, unless one before covers that
        return F.when(~first, F.lit("")).when(s["kind"] < len(KINDS), F.get(names, s["kind"])).otherwise(general)

    return rewritten(text, spans, shown)


def sanitised(docs: DataFrame, id_: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """``docs`` with its own columns, the text without what ``found`` reports. Rows keep their number; a null text stays null.

    Empty texts stay empty, rows of one id and text come out alike, long texts are read whole, an empty table gives no rows. Columns
    keep their values, whatever they are called.
    """
    seen = spans_found(docs, id_, text, **how)
    spans = F.when(F.col("terms").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "terms")))
    # rows of one key have one text, so any of their spans will do; rows without spans need no partner
    marked = seen.select(F.col("_k1").alias("_m1"), F.col("_k2").alias("_m2"), spans.alias("_spans")).where(F.size("_spans") > 0)
    marked = marked.groupBy("_m1", "_m2").agg(F.first("_spans").alias("_spans"))
    first, second = text_key(F.col(f"`{id_}`"), text_of(F.col(f"`{text}`")))
    joined = carried(docs, _k1=first, _k2=second).join(marked, (F.col("_k1") == F.col("_m1")) & (F.col("_k2") == F.col("_m2")), "left")
    clean = F.when(F.col("_spans").isNull(), field(text)).otherwise(masked(field(text), F.col("_spans")))
    return restored(joined, docs.columns, **{text: clean})
