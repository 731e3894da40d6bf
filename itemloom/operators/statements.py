"""Single-table statements. Spark's SQL parser reads every clause; texts are only taken apart at
the keywords of the write statements that Spark SQL does not run on plain tables."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from typing import Any

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import VALIDATION, ValidationError
from ..functions.documents import bound
from ..functions.exprs import sql_literal
from ..functions.tagged import untag
from ..functions.types import descriptor_of
from ..functions.updates import _outside_quotes, fitted, top_level_parts
from ..functions.values import convert_literal, is_infinite, literal_error
from ..table import Catalog, ItemTable, quoted
from .write import BAD, WriteResult, _with, put_items


def parameter(value: Any) -> Column:
    """A ``?`` value, native or tagged, as a typed literal."""
    return F.expr(sql_literal(untag(value)))


def select(catalog: Catalog, text: str, params: Sequence[Any] = (), limit: int | None = None) -> DataFrame:
    """Any SELECT over registered tables, with positional ``?`` values and an optional cap of the request."""
    rows = catalog.spark.sql(_table_names(catalog, text), args=[parameter(p) for p in params] or None)
    return rows if limit is None else rows.limit(limit)


def _table_names(catalog: Catalog, text: str) -> str:
    """Registered names in FROM position, quoted or with dashes, in the form of their views. Text literals stay as they are."""
    shown = re.sub(r'"(?:[^"\\]|\\.)*"', lambda m: " " * len(m.group(0)), _outside_quotes(text))

    def view(m: re.Match) -> str:
        inside = not shown[m.start() : m.start() + 4].strip()
        return m.group(0) if inside else m.group(1) + m.group(2).replace("-", "_")

    named = re.sub(r"(?i)(\b(?:FROM|JOIN)\s+)[\"`]?([\w-]+)[\"`]?", view, text)
    known = set(catalog.names())
    clauses = [m.span(1) for m in _FROM_CLAUSE.finditer(_outside_quotes(named))]

    def listed(m: re.Match) -> str:
        clean = m.group(2).replace("-", "_")
        return m.group(1) + clean if clean in known and any(a <= m.start() < b for a, b in clauses) else m.group(0)

    # further names of a comma list
    return re.sub(r"(,\s*)[\"`]?([\w-]+)[\"`]?", listed, named)


#: what follows FROM up to the next clause or the end of a subquery
_FROM_CLAUSE = re.compile(r"(?is)\bFROM\b(.*?)(?=\b(?:WHERE|GROUP|HAVING|ORDER|LIMIT|OFFSET|UNION|EXCEPT|INTERSECT|SELECT)\b|[()]|\Z)")


def insert_value(table: ItemTable, rows: DataFrame, literals: bool = False, on_conflict: str | None = None) -> WriteResult:
    """INSERT INTO … VALUE for many rows; with ``literals`` every column is literal text cast by descriptor.

    ``on_conflict="nothing"`` leaves an item that is there as it is and reports its key as a failed condition.
    """
    if on_conflict not in (None, "nothing"):
        raise ValidationError(f"cannot do {on_conflict!r} on a conflict")
    if literals:
        for name in rows.columns:
            if name not in table.df.columns:
                raise ValidationError(f"table {table.name!r} has no attribute {name!r}")
        # a literal is read once, however often the reading mentions it, and outside the generated code, which it would make too long to be compiled
        read = rows.select(*[bound(quoted(n), _literal_reader(table.df.schema[n].dataType)).alias(n) for n in rows.columns])
        bad = reduce(lambda a, b: a | b, (quoted(n)["off"] for n in rows.columns), F.lit(False))
        rows = read.select(*[quoted(n)["value"].alias(n) for n in rows.columns], bad.alias(BAD))
    rejected = None
    if BAD in rows.columns:
        rejected = rows.where(F.col(BAD)).select(*[quoted(k) for k in table.keys], F.lit(VALIDATION).alias("code"))
        rows = rows.where(~F.col(BAD)).drop(BAD)
    condition = f"attribute_not_exists({table.partition_key})" if on_conflict else None
    result = put_items(table, rows, condition=condition)
    return result if rejected is None else replace(result, rejected=_with(result.rejected, rejected))


def _literal_reader(kind: T.DataType) -> Callable[[Column], Column]:
    """Of literal text, ``value`` in the attribute's type and ``off`` where it does not keep itself there; no literal at all is an error."""

    def read(text: Column) -> Column:
        none = F.coalesce(_no_literal(text, kind), F.lit(False))
        # a value that does not keep itself is null
        one = lambda v: F.struct(v.alias("value"), (text.isNotNull() & v.isNull()).alias("off"))
        return bound(F.when(none, _failed(text, kind)).otherwise(typed_literal(text, kind)[0]), one)

    return read


_TIMES = (T.TimestampType, T.TimestampNTZType, T.DateType)


def _no_literal(text: Column, kind: T.DataType) -> Column:
    """True where a text is no literal at all for the attribute: that is an error of the caller."""
    if isinstance(kind, (T.VariantType, *_TIMES)):
        return F.lit(False)
    return literal_error(text, descriptor_of(kind))


def _failed(text: Column, kind: T.DataType) -> Column:
    return F.raise_error(F.concat(F.lit("literal does not fit: "), text)).cast(kind)


def typed_literal(text: Column, kind: T.DataType) -> tuple[Column, Column | None]:
    """Literal text as a value of the attribute's type, and where it does not keep itself there (a fraction in a whole number, say)."""
    if isinstance(kind, T.VariantType):
        value = F.try_parse_json(text)
    elif isinstance(kind, _TIMES):
        value = convert_literal(text, "S").try_cast(kind)
    elif isinstance(kind, T.NumericType):
        return fitted(text, T.StringType(), kind)
    else:
        value = convert_literal(text, descriptor_of(kind)).try_cast(kind)
    return value, text.isNotNull() & value.isNull()


def _with_params(text: str, params: list[Any]) -> str:
    """``?`` marks replaced by literals in order; ``params`` is used up."""
    out, blanked = [], _outside_quotes(text)
    for char, shown in zip(text, blanked):
        if shown == "?":
            if not params:
                raise ValidationError("more ? marks than parameters")
            out.append(sql_literal(untag(params.pop(0))))
        else:
            out.append(char)
    return "".join(out)


@dataclass(frozen=True)
class UpdateResult:
    """The new state of a table, and the rows an UPDATE hit but left as they are, since a value does not fit: their key and a code."""

    state: DataFrame
    failures: DataFrame
    #: the new values of the rows that were hit
    values: DataFrame


def update_rows(
    table: ItemTable, assignments: Mapping[str, str | Column], where: str | None = None, params: Sequence[Any] = ()
) -> UpdateResult:
    """UPDATE … SET … WHERE …: all right sides read the old row. A row with a value that its attribute cannot hold is refused whole."""
    left = list(params)
    new, bad = {}, F.lit(False)
    for name, value in assignments.items():
        if name not in table.attributes:
            raise ValidationError(f"attribute {name!r} cannot be set")
        column = value if isinstance(value, Column) else F.expr(_with_params(value, left))
        kind = table.df.select(column.alias("v")).schema["v"].dataType
        new[name], off = fitted(column, kind, table.df.schema[name].dataType)
        if isinstance(table.df.schema[name].dataType, (T.DoubleType, T.FloatType)):
            off = is_infinite(new[name]) if off is None else off | is_infinite(new[name])
        bad = bad if off is None else bad | F.coalesce(off, F.lit(False))
    hit = F.coalesce(F.expr(_with_params(where, left)), F.lit(False)) if where else F.lit(True)
    if left:
        raise ValidationError("more parameters than ? marks")
    columns = [
        F.when(hit & ~bad, new[c]).otherwise(quoted(c)).alias(c) if c in new else quoted(c) for c in table.df.columns
    ]
    refused = table.df.where(hit & bad).select(*[quoted(k) for k in table.keys], F.lit(VALIDATION).alias("code"))
    return UpdateResult(table.df.select(*columns), refused, table.df.where(hit).select(*[new[n].alias(n) for n in new], bad.alias(BAD)))


def update_where(
    table: ItemTable, assignments: Mapping[str, str | Column], where: str | None = None, params: Sequence[Any] = ()
) -> DataFrame:
    """The new state of ``update_rows``."""
    return update_rows(table, assignments, where, params).state


def delete_where(table: ItemTable, where: str | None = None, params: Sequence[Any] = ()) -> DataFrame:
    """DELETE FROM … WHERE …: the rows that stay."""
    left = list(params)
    hit = F.coalesce(F.expr(_with_params(where, left)), F.lit(False)) if where else F.lit(True)
    if left:
        raise ValidationError("more parameters than ? marks")
    return table.df.where(~hit)


@dataclass(frozen=True)
class StatementResult:
    """Rows of a SELECT, or the new state of the table a write statement named and what the statement refused (key and code)."""

    rows: DataFrame | None = None
    state: DataFrame | None = None
    failures: DataFrame | None = None


_NAME = r"[\"`]?([\w-]+)[\"`]?"
_INSERT = re.compile(rf"(?is)^\s*INSERT\s+INTO\s+{_NAME}\s+VALUE\s+(\{{.*\}})\s*(?:ON\s+CONFLICT\s+(.*?))?;?\s*$")
_UPDATE = re.compile(rf"(?is)^\s*UPDATE\s+{_NAME}\s+SET\s+(.*)$")
_DELETE = re.compile(rf"(?is)^\s*DELETE\s+FROM\s+{_NAME}(?:\s+WHERE\s+(.*?))?;?\s*$")


def execute_statement(catalog: Catalog, text: str, params: Sequence[Any] = (), limit: int | None = None) -> StatementResult:
    """SELECT, INSERT … VALUE, UPDATE or DELETE by the first word; writes become the table's new state.

    What a write reads and sets is worked out once before the state is kept: a statement that fails there is an error and leaves the
    table as it was, so none can spoil it for later ones. Values that do not fit are refused in ``failures``.
    """
    word = (text.split() or [""])[0].upper()
    if word == "SELECT":
        return StatementResult(rows=select(catalog, text, params, limit))
    if word == "INSERT" and (found := _INSERT.match(text)):
        table = catalog.table(found.group(1))
        conflict = found.group(3)
        if conflict is not None and conflict.upper().split() != ["DO", "NOTHING"]:
            raise ValidationError(f"cannot do {conflict!r} on a conflict")
        rows = _value_row(catalog, table, found.group(2), list(params))
        _settled(rows)
        outcome = insert_value(table, rows, on_conflict="nothing" if conflict else None)
        state, failures = outcome.state, outcome.failures
    elif word == "UPDATE" and (found := _UPDATE.match(text)):
        table = catalog.table(found.group(1))
        body = found.group(2).rstrip().rstrip(";")
        cut = re.search(r"(?i)\bWHERE\b", _outside_quotes(body))
        sets, where = (body[: cut.start()], body[cut.end() :]) if cut else (body, None)
        pairs = [part.partition("=") for part in top_level_parts(sets)]
        changed = update_rows(table, {n.strip(" `\""): v for n, _, v in pairs}, where, params)
        _settled(changed.values)
        state, failures = changed.state, changed.failures
    elif word == "DELETE" and (found := _DELETE.match(text)):
        table = catalog.table(found.group(1))
        state, failures = delete_where(table, found.group(2), params), None
        _settled(state.select(*[quoted(k) for k in table.keys]))
    else:
        raise ValidationError(f"cannot read statement {text!r}")
    catalog.replace(table.name, state)
    return StatementResult(state=state, failures=failures)


def _settled(rows: DataFrame) -> None:
    """Works the rows out; what fails is an error of the statement."""
    try:
        rows.write.format("noop").mode("overwrite").save()
    except PySparkException as error:
        raise ValidationError(f"statement fails: {str(error).splitlines()[0]}") from error


def _value_row(catalog: Catalog, table: ItemTable, literal: str, params: list[Any]) -> DataFrame:
    """One row from ``{'name': value, …}``; Spark's JSON reader takes the single quotes."""
    out, blanked = [], _outside_quotes(literal)
    for char, shown in zip(literal, blanked):
        out.append(json.dumps(untag(params.pop(0))) if shown == "?" else char)
    declared = T.StructType(
        [T.StructField(c, T.StringType() if not isinstance(k, (T.ArrayType, T.MapType, T.StructType)) else k)
         for c, k in ((f.name, f.dataType) for f in table.df.schema.fields)]
    )
    text = F.lit("".join(out))
    row = catalog.spark.range(1).select(
        F.from_json(text, declared, {"mode": "FAILFAST"}).alias("r"), F.map_keys(F.from_json(text, "map<string,string>")).alias("carried")
    )
    columns, bad = [], F.lit(False)
    for field in table.df.schema.fields:
        value = F.col("r").getField(field.name)
        if isinstance(declared[field.name].dataType, T.StringType):
            value, off = typed_literal(value, field.dataType)
            bad, value = (bad, value) if off is None else (bad | off, F.when(~off, value))
        columns.append(value.alias(field.name))
    return row.select(*columns, F.col("carried").alias("_present"), bad.alias(BAD))
