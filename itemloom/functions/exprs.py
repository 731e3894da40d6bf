"""Expression text with ``#name`` and ``:value`` placeholders, as Spark columns.

Spark's own parser reads the text (``F.expr``). What happens here is substitution of
whole tokens: names, values, the word operators and the infix text operators.
"""

from __future__ import annotations

import datetime as dt
import decimal
import re
from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import ValidationError
from .tagged import untag

# Word operators and what they stand for.
WORD_OPERATORS = {"EQ": "=", "LT": "<", "GT": ">", "LE": "<=", "GE": ">="}
# Infix text operators and the Spark function or operator behind each.
INFIX_TEXT = {"contains": "contains", "startsWith": "startswith", "endsWith": "endswith", "matches": "rlike"}

_COMPARISONS = {"=", "==", "<>", "!=", "<", "<=", ">", ">="}
_TOKEN = re.compile(
    r"'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\"|`(?:[^`]|``)*`"  # text and quoted names stay whole
    r"|::|<=|>=|<>|!=|=="
    r"|:[A-Za-z_]\w*"
    r"|(?:#\w+|[A-Za-z_]\w*)(?:\.(?:#\w+|[A-Za-z_]\w*))*"  # name or dotted path
    r"|\d+(?:\.\d+)?(?:[eE][+-]?\d+)?[A-Za-z]*"
    r"|\s+|."
)


class SqlText(str):
    """Text that is already SQL, such as the quoted name of a column with per-row values."""


def sql_literal(value: Any) -> str:
    """A Python value as Spark SQL literal text."""
    if isinstance(value, SqlText):
        return str(value)
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, int):
        return f"{value}L" if -(2**63) <= value < 2**63 else f"{value}BD"
    if isinstance(value, float):
        if value != value or value in (float("inf"), float("-inf")):
            raise ValidationError(f"{value} is not a number that an item can hold")
        return f"{value!r}D"
    if isinstance(value, decimal.Decimal):
        return f"{value:f}BD"
    if isinstance(value, str):
        if "'" in value or "\\" in value:
            return f"cast(X'{value.encode().hex()}' AS string)"
        return f"'{value}'"
    if isinstance(value, (bytes, bytearray)):
        return f"X'{bytes(value).hex()}'"
    if isinstance(value, dt.datetime):
        return f"timestamp'{value.isoformat(sep=' ')}'"
    if isinstance(value, dt.date):
        return f"date'{value.isoformat()}'"
    if isinstance(value, (list, tuple)):
        return f"array({', '.join(map(sql_literal, value))})"
    if isinstance(value, (set, frozenset)):
        return f"array({', '.join(map(sql_literal, sorted(value)))})"
    if isinstance(value, Mapping):
        pairs = ", ".join(f"{sql_literal(k)}, {sql_literal(v)}" for k, v in value.items())
        return f"map({pairs})"
    raise ValidationError(f"no literal for a value of type {type(value).__name__}")


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def bind_names(text: str, names: Mapping[str, str] | None = None) -> str:
    """Replace each ``#name`` token by its (quoted) column name."""
    return "".join(_name_token(t, names or {}) for t in _TOKEN.findall(text))


def _name_token(token: str, names: Mapping[str, str]) -> str:
    if "#" not in token or token[0] in "'\"`" or token == "#":
        return token
    parts = []
    for part in token.split("."):
        if part.startswith("#"):
            if part not in names:
                raise ValidationError(f"name {part} is not bound")
            part = _quote(names[part])
        parts.append(part)
    return ".".join(parts)


def _value_of(token: str, values: Mapping[str, Any]) -> Any:
    if token not in values:
        raise ValidationError(f"value {token} is not bound")
    return untag(values[token])


def bind(
    text: str,
    names: Mapping[str, str] | None = None,
    values: Mapping[str, Any] | None = None,
    schema: T.StructType | None = None,
) -> str:
    """Spark SQL text of an expression: names and values bound, operators in Spark's spelling.

    With ``schema``, dotted paths into a JSON text or variant column are read from the
    document, and ``size`` counts the elements of a variant list.
    """
    names, values = names or {}, values or {}
    tokens = [t for t in _TOKEN.findall(text)]
    solid = [i for i, t in enumerate(tokens) if not t.isspace()]
    before = {i: (tokens[solid[n - 1]] if n else "") for n, i in enumerate(solid)}
    after = {i: [tokens[j] for j in solid[n + 1 : n + 3]] for n, i in enumerate(solid)}
    types = {f.name: f.dataType for f in schema.fields} if schema else {}

    out: list[str] = []
    for i, token in enumerate(tokens):
        if token.isspace() or token[0] in "'\"`" or token in ("::", ":", "#"):
            out.append(token)
        elif token.startswith(":"):
            out.append(_bound_value(_value_of(token, values), before[i]))
        elif token in WORD_OPERATORS and before[i].lower() not in ("", "(", ",", "and", "or", "not"):
            out.append(WORD_OPERATORS[token])
        elif token == "==":
            out.append("=")
        elif token[0] == "#" or token[0].isalpha() or token[0] == "_":
            out.append(_path_token(token, names, values, types, before[i], after[i], tokens, i))
        else:
            out.append(token)
    return _functions(_infix(out), types)


def _bound_value(value: Any, previous: str) -> str:
    if previous.lower() == "in" and isinstance(value, (list, tuple, set, frozenset)):
        members = sorted(value) if isinstance(value, (set, frozenset)) else value
        return f"({', '.join(map(sql_literal, members))})" if members else "(NULL)"
    return sql_literal(value)


def _path_token(token, names, values, types, previous, following, tokens, i) -> str:
    raw = [names.get(p, p) if p.startswith("#") else p for p in token.split(".")]
    kind = types.get(raw[0])
    if len(raw) == 1 or not isinstance(kind, (T.StringType, T.VariantType)):
        return _name_token(token, names)
    # a path into a document: read as the type it is compared with
    other = None
    if following and following[0] in (_COMPARISONS | set(WORD_OPERATORS)):
        other = following[1] if len(following) > 1 else None
    elif previous in (_COMPARISONS | set(WORD_OPERATORS)):
        solid = [t for t in tokens[:i] if not t.isspace()]
        other = solid[-2] if len(solid) > 1 else None
    target = "string"
    if other:
        sample = _value_of(other, values) if other.startswith(":") else other
        if isinstance(sample, bool) or str(sample).lower() in ("true", "false"):
            target = "boolean"
        elif isinstance(sample, (int, float)) or (isinstance(sample, str) and re.fullmatch(r"\d+(\.\d+)?", other)):
            target = "double"
    return json_path_sql(_quote(raw[0]), raw[1:], target, isinstance(kind, T.VariantType))


def json_path_sql(column: str, path: list[str], target: str = "string", variant: bool = False) -> str:
    steps = "$" + "".join(f".{p}" if re.fullmatch(r"\w+", p) else f"['{p}']" for p in path)
    literal = steps.replace("'", '"') if "'" in steps else steps
    if variant:
        return f"try_variant_get({column}, '{literal}', '{target}')"
    got = f"get_json_object({column}, '{steps}')" if "'" not in steps else f'get_json_object({column}, "{steps}")'
    return got if target == "string" else f"try_cast({got} AS {target})"


def _infix(tokens: list[str]) -> str:
    """``a contains b`` and its kin, for operands of one token each."""
    solid = [i for i, t in enumerate(tokens) if t and not t.isspace()]
    out = list(tokens)
    for n, i in enumerate(solid):
        if out[i] not in INFIX_TEXT or n == 0 or n + 1 >= len(solid):
            continue
        left, right = solid[n - 1], solid[n + 1]
        if out[right] == "(" or out[left] in ("(", ",") or out[left].lower() in ("and", "or", "not"):
            continue  # the function form
        out[left] = f"{INFIX_TEXT[out[i]]}({out[left]}, {out[right]})"
        out[i] = out[right] = ""
    return "".join(out)


_CALL = re.compile(r"\b(begins_with|attribute_exists|attribute_not_exists|size)\s*\(([^()]*)", re.IGNORECASE)


def _functions(text: str, types: Mapping[str, T.DataType]) -> str:
    def call(match: re.Match) -> str:
        name, inner = match.group(1).lower(), match.group(2)
        if name == "begins_with":
            return f"startswith({inner}"
        if name == "attribute_exists":
            return f"isnotnull({inner}"
        if name == "attribute_not_exists":
            return f"isnull({inner}"
        if isinstance(types.get(inner.strip().strip("`")), T.VariantType):
            return f"size(try_cast({inner} AS array<variant>)"
        return match.group(0)

    # text literals are left alone
    pieces = re.split(r"('(?:[^'\\]|\\.)*')", text)
    return "".join(p if p.startswith("'") else _CALL.sub(call, p) for p in _glue(pieces))


def _glue(pieces: list[str]) -> list[str]:
    return [p for p in pieces if p]


def predicate(
    text: str,
    names: Mapping[str, str] | None = None,
    values: Mapping[str, Any] | None = None,
    schema: T.StructType | None = None,
) -> Column:
    """Filter column; rows where it is unknown are left out by ``where`` itself."""
    return F.expr(bind(text, names, values, schema))


def condition(
    text: str,
    names: Mapping[str, str] | None = None,
    values: Mapping[str, Any] | None = None,
    schema: T.StructType | None = None,
) -> Column:
    """Write condition on the old item: unknown counts as failed."""
    return F.coalesce(predicate(text, names, values, schema), F.lit(False))


def json_path(column: str, path: str, target: str = "string", variant: bool = False) -> Column:
    """Field of a JSON text or variant column by dotted path."""
    return F.expr(json_path_sql(_quote(column), path.split("."), target, variant))
