"""Rows that operators must bear."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "word " * 120_000 + "x" * 50_000
ODD = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \n\t ", "en", "a", 4),
    (4, LONG, "en", "b", len(LONG)),
    (5, "same words here", "fr", "b", 15),
    (6, "same words here", None, "c", None),
    (7, "same words here", "fr", "b", 15),
    (7, "same words here", "fr", "b", 15),
    (None, "no id at all 1.2.3.4", "de", None, 20),
    (8, "😀 ünï code a@b.org", "xx", "d", 18),
]


def clashing(docs):
    """Extra columns named like results and like helpers."""
    from pyspark.sql import functions as F

    names = "Score kept n_words SIZE _fp _id _text spans n_tokens licenses shard _bin_x features _label _source_x".split()
    names += "_words _sum _epoch _rank _target _source _source_size _key _name _bin _within _k1 _m1 _spans _kept _kept_t _t _kept_ _row _root _one".split()
    return docs.withColumns({n: F.lit("extra") for n in names})
