"""Conversation repair against a search through all edits, odd rows, and segments of any length."""

import hashlib
import heapq
import random
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from itemloom.llm import dialogue

SCHEMA = "conv_id long, turn long, role string, text string"
BLANKS = " \t\n\x0b\x0c\r"


def brute_rows(rows):
    """Rows after damage, by conversation and in order."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        role, text = (" " if v is None else v for v in (role, text))
        kind = zlib.crc32(key.encode()) % 20
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        role = "user" if kind == 4 else role
        out[conv] += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    mark = lambda r: hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()
    return {c: sorted(r, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), mark(r))) for c, r in out.items()}


def brute_faults(rows):
    seen, faults = set(), []
    for _, role, text in rows:
        bare = text.strip(BLANKS)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return faults


def brute_audit(rows, faults):
    """The least of all edits by cost and letters, one state after the other (rows done, what the roles are like)."""
    after = {"": "u", "s": "u", "u": "a", "a": "u"}
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, last, kept = heapq.heappop(heap)
        if at == len(rows) and last in ("", "a"):
            return cost, audit, "\n".join(kept)
        if (at, last) in done:
            continue
        done.add((at, last))
        turn = {"u": "user", "a": "assistant"}[after[last]]
        heapq.heappush(heap, (cost + 2, audit + "I", at, after[last], (*kept, f"{turn}:")))
        if at < len(rows):
            _, role, text = rows[at]
            heapq.heappush(heap, (cost + 3, audit + "D", at + 1, last, kept))
            if faults[at] not in ("blank", "duplicate"):
                more = cost + (faults[at] == "truncated")
                heapq.heappush(heap, (more + 2, audit + "R", at + 1, after[last], (*kept, f"{turn}:{text}")))
                if role[:1] == after[last] or (role[:1] == "s" and not last):
                    heapq.heappush(heap, (more, audit + "K", at + 1, role[:1], (*kept, f"{role}:{text}")))


def brute(rows):
    convs, out = brute_rows(rows), {}
    for conv in {r[0] for r in rows}:
        own = convs.get(conv, [])
        faults = brute_faults(own)
        cost, audit, text = brute_audit(own, faults)
        turns = {r[0] for r in own if r[0] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        initials = [r[1][:1] for r in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        out[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


def rows_of(found):
    return {r["conv_id"]: tuple(r)[1:] for r in found.collect()}


def made(seed, convs, most):
    rng, rows = random.Random(seed), []
    for conv in [None, *range(convs)]:
        for turn in range(rng.randint(0, most)):
            turn = rng.choice([turn, turn, turn, turn + 3, None])
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rng.choice(["Yes.", "no", "", " \n", None, "Why?", f"said {rng.randint(0, 5)}!", f"cut {rng.randint(0, 3)} \t", "é."])
            rows += [(conv, turn, role, text)] * rng.choice([1, 1, 1, 1, 2, 5])
    return rows


@pytest.mark.parametrize("size", [2, 7, dialogue.SEGMENT])
def test_every_edit_tried(spark, size):
    """Short segments cut nearly every conversation; a third of all rows belong to one of them."""
    rows = made(size, 60, 9)
    rows += [(7, k, ("user", "assistant")[k % 2 if k % 11 else 0], f"{k}." if k % 5 else "same") for k in range(len(rows) // 2)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert rows_of(dialogue.audited(df, size=size)) == brute(rows)


def test_real_conversations(spark, sf):
    df = spark.read.parquet(f"{sf}/conversations.parquet")
    assert rows_of(dialogue.audited(df)) == brute([tuple(r) for r in df.collect()])


def test_many_equal_rows(spark):
    """Copies of one row are one run of deletions."""
    rows = [(1, 5, "user", "Same?")] * 9000 + [(1, 6, "assistant", "Yes.")]
    got = rows_of(dialogue.audited(spark.createDataFrame(rows, SCHEMA), damage=False, size=1000))[1]
    assert got[:7] == (0, 0, 8999, 0, 8999, 3 * 8999, "K" + "D" * 8999 + "K")


def test_odd_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert dialogue.audited(none).collect() == []
    nothing = hashlib.sha256().hexdigest()
    dropped = next(t for t in range(1000) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    rows = [(1, dropped, "user", "Gone."), (2, None, None, None), (3, -(2**63), "user", "a."), (3, 2**63 - 1, "assistant", "b.")]
    rows += [(4, 1, "user", "long " * 200_000 + "."), (4, 2, "assistant", "x" * 300_000)]
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, SCHEMA)
    more = df.withColumns({n: F.lit("extra") for n in ("conv", "mark", "n", "_kind", "AUDIT", "cost", "_every", "place", "at", "blank")})
    got = rows_of(dialogue.audited(more, damage=False))
    assert got == rows_of(dialogue.audited(df, damage=False))
    assert got[2] == (0, 1, 0, 0, 0, 3, "D", nothing) and got[3][0] is None
    assert got[4][:7] == (0, 0, 0, 1, 0, 1, "KK")
    assert rows_of(dialogue.audited(df.where("conv_id = 1")))[1] == (0, 0, 0, 0, 0, 0, "", nothing)


def test_repaired_rows(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 2, "user", "There?"), (1, 3, "assistant", ""), (1, 4, "bot", "Yes.")]
    found = dialogue.folded(spark.createDataFrame(rows, SCHEMA).toDF("conv", "turn", "role", "text"))
    got = dialogue.repaired(found, dialogue.audits(found)).collect()
    assert [tuple(r)[1:] for r in got] == [
        (0, "K", 0, "system", "Be kind."), (1, "K", 1, "user", "Hi."), (2, "I", None, "assistant", ""),
        (3, "K", 2, "user", "There?"), (4, "R", 4, "assistant", "Yes."),
    ]
    found_audit = dialogue.audits(found).first()["audit"]
    faults = brute_faults([r[1:] for r in rows])
    assert found_audit == brute_audit([r[1:] for r in rows], faults)[1]


# -- audits -------------------------------------------------------------------------------------


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**6), st.sampled_from("DIKR")), max_size=60), st.sampled_from([dialogue._PRIME, 3, 1]))
def test_order_of_audits(steps, prime):
    """Nodes compare like their texts, also where nearly all hashes collide."""
    old, dialogue._PRIME = dialogue._PRIME, prime
    try:
        tree, texts = dialogue.Audits(), [""]
        for parent, letter in steps:
            parent %= len(texts)
            assert tree.add(parent, letter) == len(texts)
            texts.append(texts[parent] + letter)
        for a, x in enumerate(texts[:20]):
            assert tree.text(a) == x
            for b, y in enumerate(texts[-20:], max(len(texts) - 20, 0)):
                assert tree.less(a, b) == (x < y)
    finally:
        dialogue._PRIME = old
