"""Update actions: each turns the old value of one attribute into the new one.

Every right side reads the old item; all new values of a row are built in one projection.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import ValidationError
from ..table import quoted
from .documents import bound
from .exprs import bind, sql_literal
from .tagged import DESCRIPTORS, untag
from .types import loose
from .values import is_infinite, parse_number


@dataclass(frozen=True)
class Action:
    """``kind`` of change to attribute ``column``; ``path`` and ``index`` reach inside it."""

    column: str
    kind: str
    value: Any = None
    path: tuple[str, ...] = ()
    index: int | None = None
    text: str | None = None


def assign(column: str, value: Any) -> Action:
    return Action(column, "assign", value)


def plus(column: str, value: Any) -> Action:
    return Action(column, "plus", value)


def minus(column: str, value: Any) -> Action:
    return Action(column, "minus", value)


def if_not_exists(column: str, value: Any) -> Action:
    return Action(column, "if_not_exists", value)


def if_exists(column: str, value: Any) -> Action:
    return Action(column, "if_exists", value)


def list_append(column: str, value: Any) -> Action:
    return Action(column, "list_append", value)


def set_path(column: str, path: str | Sequence[str], value: Any) -> Action:
    return Action(column, "path", value, tuple(path.split(".") if isinstance(path, str) else path))


def list_prepend(column: str, value: Any) -> Action:
    return Action(column, "list_prepend", value)


def set_index(column: str, index: int, value: Any, path: Sequence[str] = ()) -> Action:
    return Action(column, "index", value, tuple(path), index=index)


def add(column: str, value: Any, path: Sequence[str] = ()) -> Action:
    """Number: sum. Set (or list): union. ``path`` leads to a member of the attribute."""
    return Action(column, "add", value, tuple(path))


def delete(column: str, value: Any, path: Sequence[str] = ()) -> Action:
    """Set difference; nothing left means the attribute is absent."""
    return Action(column, "delete", value, tuple(path))


def replace_set(column: str, value: Any) -> Action:
    return Action(column, "replace_set", value)


def remove(column: str, path: Sequence[str] = ()) -> Action:
    return Action(column, "remove", path=tuple(path))


def remove_index(column: str, index: int, path: Sequence[str] = ()) -> Action:
    return Action(column, "remove_index", path=tuple(path), index=index)


def expression(column: str, text: str) -> Action:
    """Any Spark SQL expression over the old item."""
    return Action(column, "expression", text=text)


# -- expression text --------------------------------------------------------------------------

_NAME = r"(?:#\w+|[A-Za-z_]\w*|`[^`]+`)"
_TARGET = rf"({_NAME}(?:\.{_NAME})*)(?:\[(\d+)\])?"
_OPERAND = r"(:\w+|[+-]?\d+(?:\.\d+)?)"


def _outside_quotes(text: str) -> str:
    """The text with quoted parts blanked, so that positions can be searched safely."""
    return re.sub(r"'(?:[^'\\]|\\.)*'|`[^`]*`", lambda m: " " * len(m.group(0)), text)


def clauses(text: str) -> list[tuple[str, str]]:
    """``(SET | REMOVE | ADD | DELETE, rest)`` in order, keywords in any case."""
    found = list(re.finditer(r"(?<![\w#:.])(SET|REMOVE|ADD|DELETE)(?=\s)", _outside_quotes(text), re.IGNORECASE))
    if not found or text[: found[0].start()].strip():
        raise ValidationError(f"no action in update expression {text!r}")
    ends = [m.start() for m in found[1:]] + [len(text)]
    return [(m.group(1).upper(), text[m.end() : end].strip()) for m, end in zip(found, ends)]


def top_level_parts(text: str) -> list[str]:
    """Split at commas outside brackets and quotes."""
    depth, start, parts = 0, 0, []
    for at, char in enumerate(_outside_quotes(text)):
        depth += (char in "([{") - (char in ")]}")
        if char == "," and depth == 0:
            parts.append(text[start:at].strip())
            start = at + 1
    return [p for p in [*parts, text[start:].strip()] if p]


def actions_from_text(
    text: str, names: Mapping[str, str] | None = None, values: Mapping[str, Any] | None = None
) -> list[Action]:
    """Actions of an update expression such as ``SET a = a + :v REMOVE b ADD s :set``."""
    names, values = names or {}, values or {}
    out = []
    for keyword, body in clauses(text):
        for part in top_level_parts(body):
            out.append(_action(keyword, part, names, values))
    return out


def _resolve(name: str, names: Mapping[str, str]) -> list[str]:
    parts = []
    for part in re.findall(_NAME, name):
        if part.startswith("#"):
            if part not in names:
                raise ValidationError(f"name {part} is not bound")
            part = names[part]
        parts.append(part.strip("`"))
    return parts


def _operand(token: str, values: Mapping[str, Any]) -> Any:
    if token.startswith(":"):
        if token not in values:
            raise ValidationError(f"value {token} is not bound")
        return values[token]
    return float(token) if "." in token else int(token)


def _is_set(value: Any) -> bool:
    tagged = isinstance(value, Mapping) and len(value) == 1 and next(iter(value)) in ("SS", "NS", "BS")
    return tagged or isinstance(value, (set, frozenset))


def _action(keyword: str, part: str, names: Mapping[str, str], values: Mapping[str, Any]) -> Action:
    if keyword == "REMOVE":
        target = re.fullmatch(_TARGET, part)
        if not target:
            raise ValidationError(f"cannot remove {part!r}")
        path = _resolve(target.group(1), names)
        if target.group(2) is not None:
            return remove_index(path[0], int(target.group(2)), path[1:])
        return remove(path[0], path[1:])
    if keyword in ("ADD", "DELETE"):
        found = re.fullmatch(rf"{_TARGET}\s+{_OPERAND}", part)
        if not found:
            raise ValidationError(f"cannot read {keyword} {part!r}")
        if found.group(2) is not None:
            raise ValidationError(f"{keyword} of a list element: {part!r}")
        path = _resolve(found.group(1), names)
        return (add if keyword == "ADD" else delete)(path[0], _operand(found.group(3), values), path[1:])

    left, equals, right = part.partition("=")
    target = re.fullmatch(_TARGET, left.strip())
    if not equals or not target:
        raise ValidationError(f"cannot read SET {part!r}")
    path, right = _resolve(target.group(1), names), right.strip()
    plain = re.fullmatch(_OPERAND, right)
    if target.group(2) is not None:
        if not plain:
            raise ValidationError(f"a list element is set to a plain value, not {right!r}")
        return set_index(path[0], int(target.group(2)), _operand(right, values), path[1:])
    if len(path) > 1:
        if not plain:
            raise ValidationError(f"a nested attribute is set to a plain value, not {right!r}")
        return set_path(path[0], path[1:], _operand(right, values))
    name = path[0]
    if plain:
        value = _operand(right, values)
        return replace_set(name, value) if _is_set(value) else assign(name, value)
    for kind, build in (("if_not_exists", if_not_exists), ("if_exists", if_exists), ("list_append", list_append)):
        call = re.fullmatch(rf"{kind}\s*\(\s*({_NAME})\s*,\s*{_OPERAND}\s*\)", right, re.IGNORECASE)
        if call and _resolve(call.group(1), names)[0] == name:
            return build(name, _operand(call.group(2), values))
    call = re.fullmatch(rf"list_append\s*\(\s*{_OPERAND}\s*,\s*({_NAME})\s*\)", right, re.IGNORECASE)
    if call and _resolve(call.group(2), names)[0] == name:
        return list_prepend(name, _operand(call.group(1), values))
    sum_of = re.fullmatch(rf"({_NAME})\s*([+-])\s*{_OPERAND}", right)
    if sum_of and _resolve(sum_of.group(1), names)[0] == name:
        return (plus if sum_of.group(2) == "+" else minus)(name, _operand(sum_of.group(3), values))
    text = re.sub(r"\bif_not_exists\s*\(", "coalesce(", right, flags=re.IGNORECASE)
    text = re.sub(r"\blist_append\s*\(", "concat(", text, flags=re.IGNORECASE)
    per_row = [v for v in re.findall(r":\w+", text) if isinstance(values.get(v), Column)]
    if per_row:
        raise ValidationError(f"{right!r}: per-row values need one of the stated action forms")
    return expression(name, bind(text, names, values))


# -- values -----------------------------------------------------------------------------------


def value_column(value: Any, target: T.DataType | None) -> Column:
    """A request value as a column; a document when the attribute is one."""
    if isinstance(value, Column):
        return value
    native = untag(value) if isinstance(value, Mapping) and set(value) <= set(DESCRIPTORS) else value
    mixed = isinstance(native, (list, tuple)) and len({type(v) for v in native}) > 1
    if isinstance(target, T.VariantType) or mixed:
        return F.parse_json(F.lit(json.dumps(native)))
    if isinstance(native, (list, tuple, set, frozenset)) and not native and isinstance(target, T.ArrayType):
        return F.array().cast(target)
    return F.expr(sql_literal(native))


def payload_name(at: int) -> str:
    return f"__p{at}"


def payload(actions: Sequence[Action], schema: T.StructType) -> list[Column]:
    """The per-request values of the actions, as columns next to the request keys."""
    kinds = {f.name: loose(f.dataType) for f in schema.fields}
    out = []
    for at, action in enumerate(actions):
        if action.kind in ("remove", "expression"):
            continue
        if action.kind == "remove_index":
            out.append(F.lit(1).alias(payload_name(at)))
        else:
            out.append(value_column(action.value, _value_target(action, kinds)).alias(payload_name(at)))
    return out


def _value_target(action: Action, kinds: Mapping[str, T.DataType]) -> T.DataType | None:
    kind = _kind_at(kinds.get(action.column), action.path if action.kind != "path" else ())
    if action.kind in ("assign", "if_not_exists", "if_exists", "add", "delete", "replace_set"):
        return kind
    if action.kind in ("list_append", "list_prepend", "index", "path") and isinstance(kind, T.VariantType):
        return kind
    if action.kind == "index" and isinstance(kind, T.ArrayType):
        return kind.elementType
    if action.kind in ("list_append", "list_prepend") and isinstance(action.value, (list, tuple)):
        return kind
    return None


def _kind_at(kind: T.DataType | None, path: Sequence[str]) -> T.DataType | None:
    """Type of the member that a path leads to; None where it leads to no typed member."""
    for name in path:
        if isinstance(kind, T.StructType):
            kind = kind[name].dataType if name in kind.names else None
        elif isinstance(kind, T.MapType):
            kind = kind.valueType
        elif not isinstance(kind, T.VariantType):
            return None
    return kind


# -- new values -------------------------------------------------------------------------------


def _empty(kind: T.DataType) -> Column:
    return F.array().cast(kind)


def _list_of(old: Column, kind: T.DataType) -> tuple[Column, T.ArrayType]:
    """A list attribute as an array, be it declared or a document."""
    if isinstance(kind, T.VariantType):
        return old.try_cast("array<variant>"), T.ArrayType(T.VariantType())
    if not isinstance(kind, T.ArrayType):
        raise ValidationError(f"a {kind.simpleString()} attribute is no list")
    return old, kind


def _back(col: Column, kind: T.DataType) -> Column:
    return F.to_variant_object(col) if isinstance(kind, T.VariantType) else col


def _as_kind(value: Column, kind: T.DataType | None, to: T.DataType) -> Column:
    """The value in a type; one that does not keep itself there is refused elsewhere and null here."""
    return value.cast(to) if kind is None else fitted(value, kind, to)[0]


def _with_path(old: Column, kind: T.DataType, path: Sequence[str], value: Column, given: T.DataType | None = None) -> Column:
    """``old`` with the field at ``path`` set; a path that leads nowhere leaves it unchanged."""
    head, rest = path[0], path[1:]
    if isinstance(kind, T.StructType):
        if head not in kind.names:
            if rest:
                return old
            return F.when(old.isNotNull(), old.withField(f"`{head}`", value)).otherwise(old)
        inner = kind[head].dataType
        new = _with_path(old.getField(head), inner, rest, value, given) if rest else _as_kind(value, given, inner)
        return F.when(old.isNotNull(), old.withField(f"`{head}`", new)).otherwise(old)
    variant = isinstance(kind, T.VariantType)
    if not variant and not isinstance(kind, T.MapType):
        return old
    inner = T.VariantType() if variant else kind.valueType
    fields = F.try_variant_get(old, "$", "map<string,variant>") if variant else old
    current = F.try_element_at(fields, F.lit(head))
    new = _with_path(current, inner, rest, value, given) if rest else _as_kind(value, given, inner)
    others = F.map_filter(fields, lambda k, _: k != F.lit(head))
    changed = _back(F.map_concat(others, F.create_map(F.lit(head), new)), kind)
    reachable = fields.isNotNull() & (current.isNotNull() if rest else F.lit(True))
    return F.when(reachable, changed).otherwise(old)


def _changed_at(old: Column, kind: T.DataType, path: Sequence[str], change, drop: bool) -> Column:
    """``old`` with the member at ``path`` changed (``change`` of its value and type) or, with ``drop``, taken out.

    A path that leads nowhere leaves the value as it is; a struct keeps its fields, so there a dropped one becomes null.
    """
    head, rest = path[0], path[1:]
    if isinstance(kind, T.StructType):
        if head not in kind.names:
            return old
        inner, current = kind[head].dataType, old.getField(head)
        if rest:
            new = _changed_at(current, inner, rest, change, drop)
        else:
            new = F.lit(None).cast(inner) if drop else change(current, inner).cast(inner)
        return F.when(old.isNotNull(), old.withField(f"`{head}`", new)).otherwise(old)
    variant = isinstance(kind, T.VariantType)
    if not variant and not isinstance(kind, T.MapType):
        return old
    inner = T.VariantType() if variant else kind.valueType
    fields = F.try_variant_get(old, "$", "map<string,variant>") if variant else old
    current = F.try_element_at(fields, F.lit(head))
    others = F.map_filter(fields, lambda k, _: k != F.lit(head))
    if drop and not rest:
        return F.when(fields.isNotNull(), _back(others, kind)).otherwise(old)
    new = _changed_at(current, inner, rest, change, drop) if rest else change(current, inner)
    new = new.cast("variant") if variant and not rest else new.cast(inner)
    there = fields.isNotNull() & (current.isNotNull() if rest else new.isNotNull())
    return F.when(there, _back(F.map_concat(others, F.create_map(F.lit(head), new)), kind)).otherwise(old)


#: sums on whole numbers are added up in this type: 28 digits before the point
EXACT = "decimal(38,10)"


def exact_number(value: Column, kind: T.DataType) -> Column:
    """The number, a text's too, without rounding of any kind; null if it is none, too long, or needs more than ten digits after the point."""
    return kept_decimal(value, kind, T.DecimalType(38, 10))


def _places(text: Column) -> Column:
    """Digits after the point that the number of a text needs."""
    mantissa = F.regexp_replace(text, "[eE].*|[^0-9.eE]", "")
    digits = F.translate(mantissa, ".", "")
    needed = F.length(F.regexp_extract(mantissa, r"\.([0-9]*)", 1)) - F.length(digits) + F.length(F.rtrim(digits, F.lit("0")))
    exponent = F.coalesce(F.regexp_extract(text, "[eE]([+-]?[0-9]+)", 1).try_cast("int"), F.lit(0))
    return F.when(F.rtrim(digits, F.lit("0")) == "", F.lit(0)).otherwise(needed - exponent)


def kept_decimal(value: Column, kind: T.DataType, to: T.DecimalType) -> Column:
    """The number, a text's too, in a decimal type; null if it is none or would change there."""
    if isinstance(kind, T.StringType):
        return F.when(_places(value) <= to.scale, parse_number(value, to.simpleString()))
    new = value.try_cast(to)
    if isinstance(kind, T.DecimalType) and kind.scale > to.scale:
        part = value % F.lit(1).cast("decimal(1,0)")
        return F.when(part.cast(f"decimal({min(to.scale + 1, 38)},{to.scale})") == part, new)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.when(new.cast(kind) == value, new)
    return new


def summand(kind: T.DecimalType) -> T.DecimalType:
    """The type in which numbers are added to a decimal attribute: its own scale, room for sums of many."""
    return T.DecimalType(min(kind.precision + 10, 38), kind.scale)


def decimal_sum(a: Column, b: Column, kind: T.DecimalType, minus: bool = False) -> Column:
    """The exact sum (or difference) of two numbers of one decimal type, in a type of its scale; null beyond 38 digits.

    Spark rounds the sum of two decimals of 38 digits, so there whole parts and fractions are added by themselves. It also rounds a
    negated decimal to 34 digits, so nothing is negated.
    """
    add = F.try_subtract if minus else F.try_add
    if kind.precision < 38 or kind.scale == 0:
        return add(a, b)
    if kind.scale > 36:
        raise ValidationError(f"sums on {kind.simpleString()} are not supported")
    one, whole = F.lit(1).cast("decimal(1,0)"), f"decimal({39 - kind.scale},0)"
    cut = lambda x: F.when(x < 0, F.ceil(x)).otherwise(F.floor(x)).cast(whole)
    fraction = add(a % one, b % one)
    high, low = F.try_add(add(cut(a), cut(b)), cut(fraction)), fraction % one
    # both parts with one sign
    step = F.when((high > 0) & (low < 0), F.lit(1)).when((high < 0) & (low > 0), F.lit(-1)).otherwise(F.lit(0)).cast("decimal(1,0)")
    high, low = high - step, low + step
    sign = F.when((high < 0) | (low < 0), F.lit("-")).otherwise(F.lit(""))
    digits = F.substring_index(F.format_number(low, kind.scale), ".", -1)
    return F.concat(sign, F.translate(high.cast("string"), "-", ""), F.lit("."), digits).try_cast(kind)


# Fixed value: a whole number that every reading takes alike.
FEW_DIGITS = r"^[+-]?[0-9]{1,18}$"


def _whole(exact: Column, to: T.IntegralType) -> Column:
    """The number in a whole-number type; null if it would change there."""
    return bound(exact, lambda x: F.when(x.try_cast(to).cast(EXACT) == x, x.try_cast(to)))


def fitted(value: Column, kind: T.DataType, to: T.DataType) -> tuple[Column, Column | None]:
    """The value as type ``to``, and where a value there is does not keep itself in it (None: it always does).

    Texts that are no numbers, fractions in whole-number types and numbers beyond a type's range do not. A list does if all its members do.
    """
    kind, to = loose(kind), loose(to)
    if kind != to and isinstance(kind, T.ArrayType) and isinstance(to, T.ArrayType):
        if fitted(F.lit(None), kind.elementType, to.elementType)[1] is None:
            return value.cast(to), None
        off = F.exists(value, lambda x: fitted(x, kind.elementType, to.elementType)[1])
        return F.transform(value, lambda x: fitted(x, kind.elementType, to.elementType)[0]), F.coalesce(off, F.lit(False))
    scalar = (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    if kind == to or not isinstance(kind, scalar) or not isinstance(to, scalar):
        return (value if kind == to else value.cast(to)), None
    if isinstance(to, T.StringType):
        return value.cast(to), None
    if isinstance(to, T.DecimalType):
        new = kept_decimal(value, kind, to)
        return new, value.isNotNull() & new.isNull()
    if isinstance(to, T.IntegralType):
        if isinstance(kind, T.StringType):
            # few digits are read at once; the long way is worked out once, in a lambda function: generated code with it is too long to be compiled
            new = F.when(value.rlike(FEW_DIGITS), value.try_cast(to)).otherwise(bound(value, lambda text: _whole(exact_number(text, kind), to)))
            return new, value.isNotNull() & new.isNull()
        exact = exact_number(value, kind)
        new = exact.try_cast(to)
        return new, value.isNotNull() & ~F.coalesce(new.cast(EXACT) == exact, F.lit(False))
    if isinstance(to, T.NumericType):
        new = parse_number(value).cast(to) if isinstance(kind, T.StringType) else value.try_cast(to)
        return new, value.isNotNull() & new.isNull()
    new = value.try_cast(to)
    return new, value.isNotNull() & new.isNull()


def _total(action: Action, old: Column, kind: T.DataType, given: Column, given_kind: T.DataType) -> tuple[Column, Column]:
    """Sum (or difference) in the attribute's type, and where it is refused: no number, infinite, or not in the type."""
    if isinstance(kind, T.DecimalType):
        wide = summand(kind)
        addend = kept_decimal(given, given_kind, wide)
        new = decimal_sum(F.coalesce(old.cast(wide), F.lit(0).cast(wide)), addend, wide, action.kind == "minus").try_cast(kind)
        return new, new.isNull()
    if isinstance(kind, T.IntegralType):
        addend = exact_number(given, given_kind)
        start = F.coalesce(old.cast(EXACT), F.lit(0).cast(EXACT))
        total = (F.try_subtract if action.kind == "minus" else F.try_add)(start, addend)
        new = total.try_cast(kind)
        return new, ~F.coalesce(new.cast(EXACT) == total.try_cast(EXACT), F.lit(False))
    addend = parse_number(given) if isinstance(given_kind, T.StringType) else given
    start = F.coalesce(old, F.lit(0))
    new = (start - addend if action.kind == "minus" else start + addend).cast(kind)
    return new, F.coalesce(is_infinite(new), F.lit(True))


def new_value(action: Action, old: Column, old_kind: T.DataType | None, at: int, requests: T.StructType) -> Column:
    """Column of the attribute after the action, over the joined row of old item and request."""
    given = F.col(payload_name(at))
    given_kind = requests[payload_name(at)].dataType if payload_name(at) in requests.names else None
    kind = loose(old_kind if old_kind is not None else given_kind) if old_kind or given_kind else None
    if old_kind is None and action.kind not in ("remove", "expression"):
        old = F.lit(None).cast(kind)
    numeric = isinstance(kind, T.NumericType)
    if action.path and action.kind != "path":
        if kind is None:
            return old

        def change(current: Column, inner: T.DataType) -> Column:
            return new_value(replace(action, path=()), current, inner, at, requests)

        return _changed_at(old, kind, action.path, change, action.kind == "remove")

    match action.kind:
        case "assign":
            return fitted(given, given_kind, kind)[0]
        case "replace_set":
            return _as_kind(F.array_distinct(given), given_kind, kind)
        case "plus" | "minus" if numeric:
            return _total(action, old, kind, given, given_kind)[0]
        case "plus":
            return (F.coalesce(old, F.lit(0)) + given).cast(kind)
        case "minus":
            return (F.coalesce(old, F.lit(0)) - given).cast(kind)
        case "if_not_exists":
            return F.coalesce(old, fitted(given, given_kind, kind)[0])
        case "if_exists":
            return F.when(old.isNotNull(), fitted(given, given_kind, kind)[0])
        case "add" if numeric:
            return _total(action, old, kind, given, given_kind)[0]
        case "add" if isinstance(kind, T.VariantType):
            number, held = given.try_cast("double"), old.try_cast("double")
            total = (F.coalesce(held, F.lit(0.0)) + number).cast("variant")
            summed = F.when(old.isNull() | held.isNotNull(), total).otherwise(old)
            if isinstance(given_kind, T.NumericType):
                return summed
            members, kind_of = _list_of(old, kind)
            added = given.try_cast("array<variant>") if isinstance(given_kind, T.VariantType) else given.cast(kind_of)
            grown = _back(F.concat(F.coalesce(members, _empty(kind_of)), added), kind)
            return F.when(number.isNotNull(), summed).otherwise(grown) if isinstance(given_kind, T.VariantType) else grown
        case "add":
            members, kind_of = _list_of(old, kind)
            return F.array_union(F.coalesce(members, _empty(kind_of)), _as_kind(given, given_kind, kind_of))
        case "delete":
            left = F.array_except(old, _as_kind(given, given_kind, kind))
            return F.when(F.size(left) > 0, left)
        case "list_append" | "list_prepend":
            members, kind_of = _list_of(old, kind)
            if isinstance(given_kind, T.VariantType):
                added = F.coalesce(given.try_cast("array<variant>"), F.array(given))
            elif isinstance(given_kind, T.ArrayType):
                added = _as_kind(given, given_kind, kind_of)
            else:
                added = F.array(_as_kind(given, given_kind, kind_of.elementType))
            own = F.coalesce(members, _empty(kind_of))
            return _back(F.concat(added, own) if action.kind == "list_prepend" else F.concat(own, added), kind)
        case "index":
            members, kind_of = _list_of(old, kind)
            element, place = _as_kind(given, given_kind, kind_of.elementType), F.lit(action.index)
            changed = F.transform(members, lambda x, i: F.when(i == place, element).otherwise(x))
            longer = F.concat(members, F.array(element))
            fits = F.size(members) >= place
            result = F.when(F.size(members) == place, longer).otherwise(changed)
            return F.when(fits, _back(result, kind)).otherwise(old)
        case "remove_index":
            members, _ = _list_of(old, kind)
            first, behind = F.lit(action.index), F.lit(action.index) + given
            left = F.filter(members, lambda _, i: (i < first) | (i >= behind))
            return F.when(members.isNotNull(), _back(left, kind)).otherwise(old)
        case "path":
            return _with_path(old, kind, action.path, given, given_kind)
        case "remove":
            return F.lit(None).cast(kind if kind is not None else T.StringType())
        case "expression":
            value = F.expr(action.text)
            return value.cast(kind) if kind is not None else value
    raise ValidationError(f"unknown action {action.kind!r}")


def violation(
    action: Action, old: Column, new: Column, old_kind: T.DataType | None, at: int, requests: T.StructType
) -> Column | None:
    """True where an action's result is refused: an infinite number, no number, or one that its type does not hold."""
    kind, given_kind = old_kind, None
    if payload_name(at) in requests.names:
        given_kind = requests[payload_name(at)].dataType
    if kind is None:
        kind, old = given_kind, F.lit(None).cast(given_kind or T.StringType())
    if action.path:
        inner = _kind_at(kind, action.path)
        if inner is None or isinstance(inner, T.VariantType):
            return None
        if action.kind == "path":
            return fitted(F.col(payload_name(at)), given_kind, loose(inner))[1]
        current = _member_at(old, kind, action.path)
        return violation(replace(action, path=()), current, new, inner, at, requests)
    if isinstance(kind, T.ArrayType) and given_kind is not None and action.kind in _MEMBERS:
        whole = isinstance(given_kind, T.ArrayType) and action.kind != "index"
        return fitted(F.col(payload_name(at)), given_kind, loose(kind) if whole else loose(kind.elementType))[1]
    if action.kind in ("assign", "if_not_exists", "if_exists"):
        bad = fitted(F.col(payload_name(at)), given_kind, loose(kind))[1]
        return bad if bad is None or action.kind == "assign" else bad & (old.isNull() if action.kind == "if_not_exists" else old.isNotNull())
    if not isinstance(kind, T.NumericType):
        return None
    if action.kind in ("plus", "minus", "add"):
        return _total(action, old, loose(kind), F.col(payload_name(at)), given_kind)[1]
    if action.kind == "expression":
        return F.coalesce(is_infinite(new), F.lit(False))
    return None


#: actions whose value becomes members of a list or set
_MEMBERS = ("add", "delete", "replace_set", "list_append", "list_prepend", "index")


def _member_at(old: Column, kind: T.DataType, path: Sequence[str]) -> Column:
    """The member that a path of typed fields leads to."""
    for name in path:
        if isinstance(kind, T.StructType):
            old, kind = old.getField(name), kind[name].dataType
        else:
            old, kind = F.try_element_at(old, F.lit(name)), kind.valueType
    return old


# -- several updates of one key ---------------------------------------------------------------

_FOLDS_LAST = ("assign", "if_exists", "path", "index", "replace_set")


def fold_updates(
    requests: DataFrame, keys: Sequence[str], seq: str, actions: Sequence[Action], schema: T.StructType
) -> DataFrame:
    """One request per key with the effect of all of them, applied in ``seq`` order.

    Sums and last values combine before the shuffle. Set members are made distinct per key first,
    so a key with very many requests is spread by its members.
    """
    aggregates, member_columns = [], []
    kinds = {f.name: f.dataType for f in schema.fields}
    for at, action in enumerate(actions):
        name = payload_name(at)
        if action.kind == "remove":
            continue
        if action.kind == "expression":
            raise ValidationError("a general expression takes one request per key")
        is_set = action.kind == "delete" or (
            action.kind == "add" and isinstance(requests.schema[name].dataType, T.ArrayType)
        )
        if is_set:
            member_columns.append(name)
        elif action.kind in ("plus", "minus", "add"):
            given, target = requests.schema[name].dataType, kinds.get(action.column)
            if isinstance(target, T.DecimalType):
                addend = kept_decimal(F.col(name), given, summand(target))
            elif isinstance(target, T.IntegralType):
                addend = exact_number(F.col(name), given)
            else:
                addend = parse_number(F.col(name)) if isinstance(given, T.StringType) else F.col(name)
            # doubles end in infinity, other types in an error or, here, in no sum
            floats = isinstance(given, (T.DoubleType, T.FloatType, T.StringType)) and not isinstance(target, (T.IntegralType, T.DecimalType))
            total = F.sum if floats else F.try_sum
            # one addend that is no number spoils the sum, which refuses the key
            aggregates.append(F.when(F.count(addend) == F.count(F.lit(1)), total(addend)).alias(name))
        elif action.kind == "remove_index":
            aggregates.append(F.sum(name).cast("int").alias(name))
        elif action.kind == "if_not_exists":
            # a request without a value sets none: the first value counts
            aggregates.append(F.min_by(name, F.when(F.col(name).isNotNull(), quoted(seq))).alias(name))
        elif action.kind == "list_append":
            # the appended elements are the new value of the attribute: they belong in one row
            element = F.col(name) if isinstance(requests.schema[name].dataType, T.ArrayType) else F.array(name)
            ordered = F.array_sort(F.collect_list(F.struct(quoted(seq).alias("at"), element.alias("given"))))
            aggregates.append(F.flatten(F.transform(ordered, lambda x: x["given"])).alias(name))
        elif action.kind in _FOLDS_LAST:
            aggregates.append(F.max_by(name, seq).alias(name))
        else:
            raise ValidationError(f"{action.kind} takes one request per key")
    key_columns = [quoted(k) for k in keys]
    folded = requests.groupBy(*key_columns).agg(*(aggregates or [F.count(F.lit(1)).alias("__n")]))
    for name in member_columns:
        members = (
            requests.select(*key_columns, F.explode(name).alias("__member"))
            .distinct()
            .groupBy(*key_columns)
            .agg(F.collect_list("__member").alias(name))
        )
        folded = folded.join(members, list(keys), "left")
        folded = folded.withColumn(name, F.coalesce(name, F.array().cast(requests.schema[name].dataType)))
    return folded.drop("__n")


