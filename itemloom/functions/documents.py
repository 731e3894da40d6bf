"""Nested documents as variants: tagging, untagging and checks.

Values of columns are walked whole, at any depth (``walks``). With a stated depth, and inside lambda functions, a document is walked
level by level by nested higher-order functions: each level handles objects and lists in one step, so the expression grows linearly
with the depth, and a document nested deeper than that fails the query rather than losing its tail.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from . import walks
from .types import SET_DESCRIPTORS
from .values import decode_string, decoded_base64, format_number, parse_number, strict_json

DEFAULT_DEPTH = 8

# Fixed value: a number as JSON writes it.
JSON_NUMBER = r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?$"
# Fixed value: characters that JSON texts escape.
NEEDS_ESCAPE = r'["\\\x00-\x1f]'

_FIELDS = "map<string,variant>"
_ITEMS = "array<variant>"


def json_text(text: Column) -> Column:
    """A string as JSON text, quotes included. Most texts hold nothing to escape."""
    quoted_text = F.concat(F.lit('"'), text, F.lit('"'))
    return F.when(text.rlike(NEEDS_ESCAPE), F.to_json(text.cast("variant"))).otherwise(quoted_text)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often ``use`` mentions it."""
    return F.transform(F.array(value), use)[0]


def room_for(depth: int) -> None:
    """Lets Catalyst resolve nested functions of this depth: each level takes it a few rounds."""
    session = SparkSession.getActiveSession()
    if session is None or depth <= DEFAULT_DEPTH:
        return
    for setting in ("spark.sql.analyzer.maxIterations", "spark.sql.optimizer.maxIterations"):
        if int(session.conf.get(setting)) < 60 * depth:
            session.conf.set(setting, str(60 * depth))


def _at(node: Column, path: str, kind: str) -> Column:
    return F.try_variant_get(node, path, kind)


def _entries(fields: Column, items: Column) -> Column:
    """Members of an object (with name) or of a list (without)."""
    named = F.transform(
        F.map_entries(fields), lambda e: F.struct(e["key"].alias("name"), e["value"].alias("node"))
    )
    plain = F.transform(items, lambda v: F.struct(F.lit(None).cast("string").alias("name"), v.alias("node")))
    return F.coalesce(named, plain)


def _rebuild(named: Column, fields: Column, items: Column, visit: Callable[[Column], Column]) -> Column:
    """JSON text of an object (where ``named``) or list with every member rewritten."""
    body = F.array_join(
        F.transform(
            _entries(fields, items),
            lambda e: F.concat(
                F.when(e["name"].isNotNull(), F.concat(json_text(e["name"]), F.lit(":"))).otherwise(F.lit("")),
                visit(e["node"]),
            ),
        ),
        ",",
    )
    # the body stands in the expression once: a second mention would double it at every level
    return F.concat(F.when(named, F.lit("{")).otherwise(F.lit("[")), body, F.when(named, F.lit("}")).otherwise(F.lit("]")))


def _members(node: Column) -> Column:
    """Fields and items of a node, for a walk to bind once."""
    return F.struct(_at(node, "$", _FIELDS).alias("fields"), _at(node, "$", _ITEMS).alias("items"))


def _too_deep() -> Column:
    return F.raise_error(F.lit("document is nested deeper than the stated depth")).cast("string")


def tag_text(node: Column, depth: int = DEFAULT_DEPTH) -> Column:
    """Tagged JSON text of a plain document."""

    def scalar(kind: Column) -> Column:
        return (
            F.when(kind == "STRING", F.concat(F.lit('{"S":'), F.to_json(node), F.lit("}")))
            .when(kind == "BOOLEAN", F.concat(F.lit('{"BOOL":'), F.to_json(node), F.lit("}")))
            .when((kind == "VOID") | node.isNull(), F.lit('{"NULL":true}'))
            .when(
                kind.startswith("DECIMAL") | (kind == "BIGINT"),
                F.concat(F.lit('{"N":"'), F.to_json(node), F.lit('"}')),
            )
            .otherwise(F.concat(F.lit('{"N":"'), format_number(_at(node, "$", "double")), F.lit('"}')))
        )

    def tagged(m: Column) -> Column:
        named = m["fields"].isNotNull()
        nested = _too_deep() if depth == 0 else _rebuild(named, m["fields"], m["items"], lambda v: tag_text(v, depth - 1))
        opener = F.when(named, F.lit('{"M":')).otherwise(F.lit('{"L":'))
        whole = F.concat(opener, nested, F.lit("}"))
        # the kind of a value is asked for scalars only: of anything else it would take a look at all that is inside
        return F.when(named | m["items"].isNotNull(), whole).otherwise(bound(F.schema_of_variant(node), scalar))

    return bound(_members(node), tagged)


def untag_text(node: Column, depth: int = DEFAULT_DEPTH) -> Column:
    """Plain JSON text of a tagged document; parts without a tag stay as they are."""

    def plain(m: Column) -> Column:
        def member(tag: str, kind: str) -> Column:
            return F.try_element_at(m["fields"], F.lit(tag)).try_cast(kind)

        text, num, named = member("S", "string"), member("N", "string"), member("M", _FIELDS)
        items = F.coalesce(member("L", _ITEMS), m["items"])
        is_map = F.coalesce(F.map_contains_key(m["fields"], F.lit("M")), F.lit(False))
        nested = _too_deep() if depth == 0 else _rebuild(is_map, named, items, lambda v: untag_text(v, depth - 1))
        return (
            F.when(text.isNotNull(), json_text(text))
            .when(num.rlike(JSON_NUMBER), num)
            .when(num.isNotNull(), F.coalesce(F.to_json(parse_number(num).cast("variant")), F.lit("null")))
            .when(member("BOOL", "boolean").isNotNull(), member("BOOL", "string"))
            .when(member("NULL", "boolean"), F.lit("null"))
            .when(member("B", "string").isNotNull(), json_text(member("B", "string")))
            .when((is_map & named.isNotNull()) | (~is_map & items.isNotNull()), nested)
            .otherwise(F.coalesce(F.to_json(node), F.lit("null")))
        )

    return bound(_members(node), plain)


def base64_text(node: Column, depth: int = DEFAULT_DEPTH) -> Column:
    """JSON text of a plain document with padded base64 texts inside decoded."""

    def decoded(m: Column) -> Column:
        named = m["fields"].isNotNull()
        nested = _too_deep() if depth == 0 else _rebuild(named, m["fields"], m["items"], lambda v: base64_text(v, depth - 1))
        is_text = F.schema_of_variant(node) == "STRING"
        scalar = F.when(is_text, json_text(decode_string(_at(node, "$", "string"), base64=True)))
        return F.when(named | m["items"].isNotNull(), nested).otherwise(F.coalesce(scalar, F.to_json(node), F.lit("null")))

    return bound(_members(node), decoded)


def decode_list(col: Column, depth: int | None = None) -> Column:
    """Elements of list JSON text, plain or tagged, as ``array<variant>``."""
    if depth is None:
        plain = walks.untag_text(F.to_json(F.try_parse_json(col)))
    else:
        room_for(depth)
        plain = bound(F.try_parse_json(col), lambda node: untag_text(node, depth))
    return F.parse_json(plain).try_cast(_ITEMS)


def decode_map(col: Column, base64: bool = False, depth: int | None = None) -> Column:
    """Map JSON text as a variant; with ``base64``, padded base64 texts inside are decoded."""
    if base64 and depth is None:
        node = F.try_parse_json(col)
        return F.when(F.schema_of_variant(node).startswith("OBJECT"), F.parse_json(walks.unpack_text(F.to_json(node))))
    room_for(depth or 0)

    def decoded(node: Column) -> Column:
        parsed = F.parse_json(base64_text(node, depth)) if base64 else node
        return F.when(F.schema_of_variant(node).startswith("OBJECT"), parsed)

    return bound(F.try_parse_json(col), decoded)


def decode_binary(col: Column) -> Column:
    """Bytes as a variant: JSON if they hold JSON (base64-in-JSON decoded one map level deep), else text."""

    def inner(value: Column) -> Column:
        """JSON text inside base64 text, null if there is none."""
        return F.to_json(strict_json(F.try_validate_utf8(decoded_base64(value).cast("string"))))

    def member(value: Column) -> Column:
        is_text = F.schema_of_variant(value) == "STRING"
        return F.coalesce(F.when(is_text, inner(_at(value, "$", "string"))), F.to_json(value), F.lit("null"))

    def decoded(node: Column) -> Column:
        kind = F.schema_of_variant(node)
        rebuilt = _rebuild(F.lit(True), _at(node, "$", _FIELDS), F.lit(None).cast(_ITEMS), member)
        return (
            F.when(node.isNull(), col.cast("string").cast("variant"))
            .when(kind == "STRING", F.coalesce(F.parse_json(inner(_at(node, "$", "string"))), node))
            .when(kind.startswith("OBJECT"), F.parse_json(rebuilt))
            .otherwise(node)
        )

    value = bound(strict_json(F.try_validate_utf8(col.cast("string"))), decoded)
    return F.when(F.length(col) > 0, value)


def _is_set(node: Column) -> Column:
    found = F.lit(False)
    for tag in SET_DESCRIPTORS:
        found = found | _at(node, f"$.{tag}", _ITEMS).isNotNull()
    return found


def has_nested_set(node: Column, depth: int = DEFAULT_DEPTH) -> Column:
    """True where a tagged value holds a set inside a map or a list."""
    if depth == 0:
        return F.raise_error(F.lit("document is nested deeper than the stated depth")).cast("boolean")
    entries = _entries(_at(node, "$.M", _FIELDS), _at(node, "$.L", _ITEMS))
    below = F.exists(entries, lambda e: _is_set(e["node"]) | has_nested_set(e["node"], depth - 1))
    return F.when(entries.isNotNull(), below).otherwise(F.lit(False))

