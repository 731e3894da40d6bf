"""Repair of conversation structure: the cheapest edits that give ``(s?(ua)+)?``, found by a dynamic program over persistent audits.

The program walks the rows of a conversation and keeps, for each state of the roles, the cheapest audit (one letter per edit) that leads
there. Audits share their prefixes: an audit is a node that points to the one it extends. A node knows its ancestors 1, 2, 4, ... steps
up and a rolling hash, so audits of equal cost are compared by a search for their longest common prefix; equal hashes are believed only
after the letters have been compared.

Rows are sorted over all partitions, and a conversation that spans several, or many rows, is cut into segments. A segment whose start is
not known is solved for every state it could start in; segments are put together afterwards. So no task holds a long conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import SLICE, written

#: states: nothing yet, after the system, after the user, after the assistant
START, SYSTEM, USER, ASSISTANT = range(4)
ACCEPTED = (START, ASSISTANT)
#: state and role that an inserted or renamed row has after each state
TURN = {START: (USER, "user"), SYSTEM: (USER, "user"), USER: (ASSISTANT, "assistant"), ASSISTANT: (USER, "user")}
#: state after a row that is kept, by the state before it and the initial of its role
KEPT = {
    (START, "s"): SYSTEM,
    (START, "u"): USER,
    (SYSTEM, "u"): USER,
    (USER, "a"): ASSISTANT,
    (ASSISTANT, "u"): USER,
}
LEGAL = ("su", "ua", "au")
KEEP, RENAME, DELETE, INSERT = "K", "R", "D", "I"
#: rows of a segment
SEGMENT = 4096
BLANKS = " \t\n\x0b\x0c\r"
_BASE, _PRIME = 1_000_003, (1 << 61) - 1


class Audits:
    """Texts that share prefixes. Node 0 is the empty one; every other node extends its parent by a piece."""

    def __init__(self):
        self.pieces, self.hashes, self.ups = [""], [0], [()]
        self.depths = [0]

    def add(self, node: int, piece: str) -> int:
        ups, up, k = [node], node, 0
        while len(self.ups[up]) > k:
            up = self.ups[up][k]
            ups.append(up)
            k += 1
        new = len(self.pieces)
        self.pieces.append(piece)
        self.ups.append(tuple(ups))
        self.depths.append(self.depths[node] + 1)
        self.hashes.append((self.hashes[node] * _BASE + self._value(piece)) % _PRIME)
        return new

    @staticmethod
    def _value(piece: str) -> int:
        return ord(piece) if len(piece) == 1 else int.from_bytes(hashlib.blake2b(piece.encode(), digest_size=7).digest(), "big")

    def ancestor(self, node: int, depth: int) -> int:
        while (above := self.depths[node] - depth) > 0:
            node = self.ups[node][above.bit_length() - 1]
        return node

    def same(self, a: int, b: int) -> bool:
        """Whether two nodes of one depth have the same pieces; equal hashes are verified up to where the nodes meet."""
        if a == b:
            return True
        if self.hashes[a] != self.hashes[b]:
            return False
        while a != b:
            if self.pieces[a] != self.pieces[b]:
                return False
            a, b = self.ups[a][0], self.ups[b][0]
        return True

    def less(self, a: int, b: int) -> bool:
        """Whether the text of ``a`` is smaller, by the first piece after the longest common prefix."""
        depth = min(self.depths[a], self.depths[b])
        x, y = self.ancestor(a, depth), self.ancestor(b, depth)
        if self.same(x, y):
            return self.depths[a] < self.depths[b]
        for k in reversed(range(len(self.ups[x]))):
            if k < len(self.ups[x]) and not self.same(self.ups[x][k], self.ups[y][k]):
                x, y = self.ups[x][k], self.ups[y][k]
        return self.pieces[x] < self.pieces[y]

    def text(self, node: int) -> str:
        out = []
        while node:
            out.append(self.pieces[node])
            node = self.ups[node][0]
        return "".join(reversed(out))


class Repair:
    """Cheapest audits from one state to all states, over the rows taken so far."""

    def __init__(self, start: int = START):
        self.audits = Audits()
        self.best: dict[int, tuple[int, int]] = {start: (0, 0)}

    def _offer(self, found: dict[int, tuple[int, int]], state: int, cost: int, node: int, piece: str) -> None:
        old = found.get(state)
        if old is not None and old[0] < cost:
            return
        new = self.audits.add(node, piece)
        if old is None or cost < old[0] or self.audits.less(new, old[1]):
            found[state] = (cost, new)

    def inserted(self) -> None:
        """Room for inserted rows before the next edit that is not forced."""
        done: set[int] = set()
        while rest := [s for s in self.best if s not in done]:
            state = min(rest, key=lambda s: self.best[s][0])
            done.add(state)
            cost, node = self.best[state]
            if TURN[state][0] not in done:
                self._offer(self.best, TURN[state][0], cost + 2, node, INSERT)

    def deleted(self, times: int) -> None:
        """Rows that must go. An insertion among them could as well follow them, and that audit is smaller."""
        for _ in range(times):
            self.best = {s: (cost + 3, self.audits.add(node, DELETE)) for s, (cost, node) in self.best.items()}

    def row(self, initial: str, truncated: int) -> None:
        self.inserted()
        found: dict[int, tuple[int, int]] = {}
        for state, (cost, node) in self.best.items():
            self._offer(found, state, cost + 3, node, DELETE)
            if (kept := KEPT.get((state, initial))) is not None:
                self._offer(found, kept, cost + truncated, node, KEEP)
            self._offer(found, TURN[state][0], cost + 2 + truncated, node, RENAME)
        self.best = found

    def joined(self, steps: dict[tuple[int, int], tuple[int, str]]) -> None:
        """A whole segment, given as cost and audit from state to state."""
        found: dict[int, tuple[int, int]] = {}
        for (state, after), (cost, audit) in sorted(steps.items()):
            if state in self.best:
                self._offer(found, after, self.best[state][0] + cost, self.best[state][1], audit)
        self.best = found

    def ended(self) -> tuple[int, str]:
        """Cost and audit of the whole conversation."""
        self.inserted()
        cost = min(self.best[s][0] for s in ACCEPTED if s in self.best)
        ends = [self.best[s][1] for s in ACCEPTED if s in self.best and self.best[s][0] == cost]
        return cost, self.audits.text(ends[0] if len(ends) == 1 or self.audits.less(*ends) else ends[1])


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            yield batch.slice(at, SLICE).to_pylist()


# -- rows of conversations ----------------------------------------------------------------------


def damaged(convs: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv, turn, role, text`` of the rows after damage by the CRC-32 of ``conv:turn`` over 20 (a null counts as one blank).

    0 drops the row, 1 empties its text, 2 removes its ``.``, ``!`` and ``?``, 3 repeats it, 4 makes its role ``user``.
    """
    whole = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")) for c in (conv, turn, role, text)]
    kind = F.crc32(F.concat(whole[0], F.lit(":"), whole[1])) % 20
    new = F.when(kind == 1, "").when(kind == 2, F.translate(whole[3], ".!?", "")).otherwise(whole[3])
    rows = convs.select(
        F.col(f"`{conv}`").alias("conv"),
        F.col(f"`{turn}`").cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(whole[2]).alias("role"),
        new.alias("text"),
        kind.alias("_kind"),
    )
    twice = F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(0))).otherwise(F.array(F.lit(0))))
    return rows.where("_kind <> 0").withColumn("_", twice).drop("_kind", "_")


def folded(rows: DataFrame) -> DataFrame:
    """``conv, turn, role, text`` with equal rows as one and their number ``n``, ``mark`` (a digest of role and text), and two faults.

    ``blank`` tells whether the text has nothing but blanks, ``cut`` whether its last other character is none of ``.``, ``!``, ``?``.
    """
    one = rows.groupBy("conv", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n"))
    end = F.rtrim(F.col("text"), F.lit(BLANKS))
    mark = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")))
    return one.select("*", mark.alias("mark"), (end == "").alias("blank"), (~F.substring(end, -1, 1).isin(".", "!", "?")).alias("cut"))


#: rows of a conversation by turn, nulls first, then by role, then by the digest of role and text
ORDER = ("_turned", "turn", "role", "mark")


def _turned():
    return F.col("turn").isNotNull().alias("_turned")


def judged(found: DataFrame) -> DataFrame:
    """Light rows of ``folded``: without texts, with the first fault of each.

    ``free`` is 1 where the first of the equal rows is neither blank nor a duplicate, ``cut`` whether that one is truncated. The first
    turn with a role and text comes from an aggregate, so a text that fills a conversation is no large group.
    """
    first = (
        found.where("not blank").groupBy(F.col("conv").alias("_c"), F.col("mark").alias("_m")).agg(F.min(F.struct(_turned(), "turn")).alias("_first"))
    )
    same = F.col("conv").eqNullSafe(F.col("_c")) & (F.col("mark") == F.col("_m"))
    light = found.select("conv", _turned(), "turn", "role", "mark", "n", "blank", "cut").join(first, same, "left")
    is_first = F.struct(F.col("_turned"), F.col("turn")).eqNullSafe(F.col("_first"))
    free = F.when(~F.col("blank") & is_first, 1).otherwise(0).cast("long")
    light = light.withColumn("free", free).withColumn("cut", F.when(F.col("cut"), F.col("free")).otherwise(F.lit(0)))
    return light.select("conv", *ORDER, F.substring("role", 1, 1).alias("initial"), "n", "blank", "free", "cut")


def segments(light: DataFrame, size: int = SEGMENT) -> DataFrame:
    """Cost and audit from state to state of each stretch of rows, and ``illegal``, its pairs of adjacent roles that may not meet.

    One row per segment and pair of states; ``at`` and ``part`` order the segments of a conversation. Rows are ranged over all
    partitions, so a long conversation is many tasks.
    """
    key = T.StructType([light.schema[c] for c in ORDER])
    schema = T.StructType([light.schema["conv"], T.StructField("at", key)])
    for name, kind in (("part", "long"), ("state", "int"), ("after", "int"), ("cost", "long"), ("audit", "string")):
        schema = schema.add(name, T._parse_datatype_string(kind))
    schema = schema.add("illegal", "long").add("head", "string").add("tail", "string")
    arrow = to_arrow_schema(schema)
    names = ["conv", *ORDER, "initial", "n", "free", "cut"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, begun, part = None, False, 0
        out: list[dict] = []

        def opened(row, known):
            starts = [START] if known else list(TURN)
            return {"at": row, "rows": 0, "illegal": 0, "head": None, "tail": None, "repairs": {s: Repair(s) for s in starts}}

        def closed(seg):
            nonlocal part
            part += 1
            for state, repair in seg["repairs"].items():
                for after, (cost, node) in repair.best.items():
                    row = {"conv": conv, "at": seg["at"], "part": part, "state": state, "after": after, "cost": cost}
                    out.append(row | {"audit": repair.audits.text(node)} | {k: seg[k] for k in ("illegal", "head", "tail")})

        seg = None
        for rows in slices(b.select(names) for b in batches):
            for row in rows:
                at = {k: row[k] for k in ORDER}
                if not begun or row["conv"] != conv:
                    if seg:
                        closed(seg)
                    # only the first conversation of a partition may have begun in the one before
                    seg, conv, begun = opened(at, begun), row["conv"], True
                left = row["n"]
                while left:
                    take = min(left, size - seg["rows"])
                    if not take:
                        closed(seg)
                        seg = opened(at, False)
                        continue
                    free = row["free"] if left == row["n"] else 0
                    for repair in seg["repairs"].values():
                        if free:
                            repair.row(row["initial"], row["cut"])
                        repair.deleted(take - free)
                    pair = (seg["tail"] or "") + row["initial"]
                    seg["illegal"] += take - 1 + (seg["tail"] is not None and pair not in LEGAL)
                    seg["head"] = row["initial"] if seg["head"] is None else seg["head"]
                    seg["tail"] = row["initial"]
                    seg["rows"] += take
                    left -= take
                if len(out) >= 2048:
                    yield pa.RecordBatch.from_pylist(out, schema=arrow)
                    out = []
        if seg:
            closed(seg)
        yield pa.RecordBatch.from_pylist(out, schema=arrow)

    ranged = light.repartitionByRange("conv", *ORDER).sortWithinPartitions("conv", *ORDER)
    return ranged.mapInArrow(run, schema)


def joined(parts: DataFrame) -> DataFrame:
    """``conv, illegal, cost, audit`` of whole conversations, from their segments in order."""
    schema = T.StructType([parts.schema["conv"]]).add("illegal", "long").add("cost", "long").add("audit", "string")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, here, repair, steps, illegal, tail, out = None, None, None, {}, 0, None, []

        def whole():
            repair.joined(steps)
            cost, audit = repair.ended()
            return {"conv": conv, "illegal": illegal, "cost": cost, "audit": audit}

        for rows in slices(batches):
            for row in rows:
                if repair is None or row["conv"] != conv:
                    if repair is not None:
                        out.append(whole())
                    conv, here, repair, steps, illegal, tail = row["conv"], None, Repair(), {}, 0, None
                if (row["at"], row["part"]) != here:
                    if here is not None:
                        repair.joined(steps)
                    here, steps = (row["at"], row["part"]), {}
                    illegal += row["illegal"] + (tail is not None and tail + row["head"] not in LEGAL)
                    tail = row["tail"]
                steps[row["state"], row["after"]] = row["cost"], row["audit"]
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)
                out = []
        if repair is not None:
            yield pa.RecordBatch.from_pylist([whole()], schema=arrow)

    return parts.repartition("conv").sortWithinPartitions("conv", "at", "part").mapInArrow(run, schema)


def audits(found: DataFrame, size: int = SEGMENT) -> DataFrame:
    """One row per conversation of ``folded``: ``conv, gaps, blank, duplicate, truncated, illegal, cost, audit``.

    ``gaps`` counts the turns missing between the first and the last one, nulls left aside; it is null where that number is beyond a
    long. Conversations may be null, which is one of its own.
    """
    light = written(judged(found), "dialogue")
    number = F.col("n")
    facts = light.groupBy("conv").agg(
        F.min("turn").alias("_low"),
        F.max("turn").alias("_high"),
        F.sum(F.when(F.col("blank"), number).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("blank"), 0).otherwise(number - F.col("free"))).alias("duplicate"),
        F.sum("cut").cast("long").alias("truncated"),
    )
    turns = light.where("turn is not null").groupBy("conv", "turn").agg(F.lit(1)).groupBy(F.col("conv").alias("_c")).agg(F.count("turn").alias("_turns"))
    wide = F.col("_high").cast("decimal(20,0)") - F.col("_low") + 1 - F.col("_turns")
    gaps = F.when(F.col("_low").isNull(), F.lit(0).cast("long")).otherwise(wide.try_cast("long"))
    facts = facts.join(turns, F.col("conv").eqNullSafe(F.col("_c")), "left").select("conv", gaps.alias("gaps"), "blank", "duplicate", "truncated")
    solved = joined(written(segments(light, size), "dialogue")).withColumnRenamed("conv", "_c")
    return facts.join(solved, F.col("conv").eqNullSafe(F.col("_c"))).drop("_c")


def repaired(found: DataFrame, audited: DataFrame) -> DataFrame:
    """The rows of the repaired conversations: ``conv, place`` (from 0), ``edit, turn, role, text``; an inserted row has no turn.

    The rows of a conversation stand together and in order within one partition, which streams them: the audit comes first.
    """
    schema = T.StructType([found.schema["conv"]])
    for name, kind in (("place", "long"), ("edit", "string"), ("turn", "long"), ("role", "string"), ("text", "string")):
        schema = schema.add(name, T._parse_datatype_string(kind))
    arrow = to_arrow_schema(schema)
    head = audited.select("conv", F.lit(0).alias("_kind"), F.col("audit").alias("text"))
    rows = head.unionByName(found.select("conv", F.lit(1).alias("_kind"), _turned(), "turn", "role", "mark", "n", "text"), allowMissingColumns=True)
    dealt = rows.repartition("conv").sortWithinPartitions("conv", "_kind", *ORDER).select("conv", "_kind", "turn", "role", "n", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, audit, at, state, place = None, "", 0, START, 0

        def inserts():
            nonlocal at, state, place
            while audit[at : at + 1] == INSERT:
                state, role = TURN[state]
                yield {"conv": conv, "place": place, "edit": INSERT, "turn": None, "role": role, "text": ""}
                at, place = at + 1, place + 1

        for rows in slices(batches):
            out = []
            for row in rows:
                if row["_kind"] == 0:
                    out.extend(inserts())
                    conv, audit, at, state, place = row["conv"], row["text"], 0, START, 0
                    continue
                for _ in range(row["n"]):
                    out.extend(inserts())
                    edit, role = audit[at], row["role"]
                    at += 1
                    if edit == DELETE:
                        continue
                    if edit == RENAME:
                        state, role = TURN[state]
                    else:
                        state = KEPT[state, role[:1]]
                    out.append({"conv": conv, "place": place, "edit": edit, "turn": row["turn"], "role": role, "text": row["text"]})
                    place += 1
            yield pa.RecordBatch.from_pylist(out, schema=arrow)
        yield pa.RecordBatch.from_pylist(list(inserts()), schema=arrow)

    return dealt.mapInArrow(run, schema)


def digests(rows: DataFrame) -> DataFrame:
    """``conv, sha256`` (hex) of the rows that ``repaired`` gives, as ``role:text`` joined by line breaks, read as they stream by."""
    schema = T.StructType([rows.schema["conv"]]).add("sha256", "string")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, digest = None, None
        for rows in slices(batches):
            out = []
            for row in rows:
                if row["place"] == 0:
                    if digest is not None:
                        out.append({"conv": conv, "sha256": digest.hexdigest()})
                    conv, digest = row["conv"], hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{row['role']}:{row['text']}".encode())
            yield pa.RecordBatch.from_pylist(out, schema=arrow)
        if digest is not None:
            yield pa.RecordBatch.from_pylist([{"conv": conv, "sha256": digest.hexdigest()}], schema=arrow)

    return rows.select("conv", "place", "role", "text").mapInArrow(run, schema)


def audited(
    convs: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", damage: bool = True, size: int = SEGMENT
) -> DataFrame:
    """Per conversation of ``convs``: its id, ``gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.

    Rows stand by turn (nulls first), then by role, then by a digest of role and text; nulls of role and text count as one blank, and
    with ``damage`` rows are damaged first. Repeated rows are duplicates, blank ones (empty texts too) blanks; both have to go.
    Conversations without rows after the damage have zeros, an empty audit and the hash of nothing, as have those that lose all rows
    to the repair but for their audit; a null id is a conversation of its own. Ties of audits go to the one that is least in ASCII. An
    empty table gives no rows, texts of any length are read whole, and further columns do not matter.
    """
    names = dict(conv=conv, turn=turn, role=role, text=text)
    if damage:
        rows = damaged(convs, **names)
    else:
        whole = [F.coalesce(F.col(f"`{names[c]}`").cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
        rows = convs.select(F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"), *whole)
    found = written(folded(rows), "dialogue")
    made = written(audits(found, size), "dialogue")
    hashes = digests(repaired(found, made)).withColumnRenamed("conv", "_c")
    every = convs.select(F.col(f"`{conv}`").alias("_every")).distinct()
    out = every.join(made, F.col("_every").eqNullSafe(F.col("conv")), "left").join(hashes, F.col("_every").eqNullSafe(F.col("_c")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")]
    gaps = F.when(F.col("audit").isNull(), F.lit(0).cast("long")).otherwise(F.col("gaps")).alias("gaps")
    nothing = hashlib.sha256().hexdigest()
    return out.select(
        F.col("_every").alias(conv),
        gaps,
        *counts,
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.lit(nothing)).alias("repaired_sha256"),
    )
