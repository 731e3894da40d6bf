"""Mutations in bulk: a table and a DataFrame of requests in, the new state out.

Requests are joined with the items once. Every result is lazy: the new state, the requests that
were refused, and the before / after images of the ones that were carried out.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import CONDITION_FAILED, VALIDATION, ValidationError
from ..functions import updates as U
from ..functions.codec import PRESENT
from ..functions.exprs import SqlText
from ..functions.exprs import condition as condition_column
from ..functions.types import loose
from ..table import ItemTable, quoted
from .sizes import requests_travel

RETURN_MODES = ("NONE", "ALL_OLD", "ALL_NEW", "UPDATED_OLD", "UPDATED_NEW")

def _key(name: str) -> str:
    return f"__k_{name}"


def _has(name: str) -> str:
    return f"__h_{name}"


def _new(name: str) -> str:
    return f"__v_{name}"


def unique_requests(table: ItemTable, requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Requests with a whole key that no other request has, and a failure row per other key."""
    _need_keys(table, requests)
    keys = [quoted(k) for k in table.keys]
    rest = [c for c in requests.columns if c not in table.keys]
    # of a key with one request any value is the value; column by column, numbers stay in a hash aggregate
    grouped = requests.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__n"), *[F.any_value(quoted(c)).alias(c) for c in rest]
    )
    good = (F.col("__n") == 1) & table.has_key
    rows = grouped.where(good).select(*keys, *[quoted(c) for c in rest])
    bad = grouped.where(~good).select(*keys, F.lit(VALIDATION).alias("code"))
    return rows, bad


BAD = "__bad"


def typed_requests(table: ItemTable, requests: DataFrame, names: Sequence[str]) -> DataFrame:
    """Requests with these columns in the table's types, and ``__bad`` where one of them does not keep itself in its type.

    A value that does not is null from here on. Types are settled before anything looks for repeats, so no two keys become one unseen.
    """
    kinds = {f.name: f.dataType for f in table.df.schema.fields}
    columns, bad = [], F.lit(False)
    for name in requests.columns:
        value = quoted(name)
        if name in names and name in kinds:
            value, off = U.fitted(quoted(name), requests.schema[name].dataType, kinds[name])
            if off is not None:
                carried = F.array_contains(PRESENT, name) if PRESENT in requests.columns and name not in table.keys else F.lit(True)
                bad, value = bad | (off & carried), F.when(~off, value)
        columns.append(value.alias(name))
    return requests.select(*columns, bad.alias(BAD))


def fitting_keys(table: ItemTable, requests: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Requests with their keys in the table's types, and a failure row (without that key) for each key that does not fit."""
    typed = typed_requests(table, requests, table.keys)
    if all(requests.schema[k].dataType == table.df.schema[k].dataType for k in table.keys):
        return requests, None
    keys = [quoted(k) for k in table.keys]
    return typed.where(~F.col(BAD)).drop(BAD), typed.where(F.col(BAD)).select(*keys, F.lit(VALIDATION).alias("code"))


def _with(rejected: DataFrame | None, more: DataFrame | None) -> DataFrame | None:
    if rejected is None or more is None:
        return more if rejected is None else rejected
    return rejected.unionByName(more)


def _need_keys(table: ItemTable, requests: DataFrame) -> None:
    missing = [k for k in table.keys if k not in requests.columns]
    if missing:
        raise ValidationError(f"requests lack {', '.join(missing)}")


@dataclass(frozen=True)
class WriteResult:
    """Outcome of one batch of requests against ``table`` (its state before).

    ``requests`` holds one row per key: the key as ``__k_*`` plus the values the columns in
    ``changes`` read. ``changes`` gives the new value of each touched attribute.
    """

    table: ItemTable
    requests: DataFrame
    changes: Mapping[str, Column] = field(default_factory=dict)
    condition: Column | None = None
    refused: Column | None = None
    rejected: DataFrame | None = None
    deletes: bool = False
    #: columns a request adds to the table
    added: Mapping[str, T.DataType] = field(default_factory=dict)
    #: true for the requests that remove their item, where others do not
    drops: Column | None = None

    # -- joining ------------------------------------------------------------------------------

    @property
    def _on(self) -> Column:
        return reduce(lambda a, b: a & b, (quoted(k) == quoted(_key(k)) for k in self.table.keys))

    @property
    def _ok(self) -> Column:
        ok = self.condition if self.condition is not None else F.lit(True)
        return ok & ~self.refused if self.refused is not None else ok

    def _base(self) -> DataFrame:
        df = self.table.df
        for name, kind in self.added.items():
            df = df.withColumn(name, F.lit(None).cast(kind))
        return df.withColumn("__old", F.lit(True))

    def _asked(self) -> DataFrame:
        return self.requests.withColumn("__asked", F.lit(True))

    def _absent(self, base: DataFrame) -> DataFrame:
        """Requests whose key has no item, with empty old columns."""
        keys = [quoted(k) for k in self.table.keys]
        asked_keys = self.requests.select(*[quoted(_key(k)) for k in self.table.keys])
        found = self.table.df.select(*keys).join(asked_keys, self._on, "left_semi")
        fresh = self._asked().join(found, self._on, "left_anti")
        empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in base.schema.fields]
        return fresh.select(*empty, *[quoted(c) for c in fresh.columns])

    def _joined(self, how: str) -> DataFrame:
        """Items next to their requests. ``how``: ``right`` keeps all requests, ``full`` all items as well.

        With few requests the items stay where they are and the requests travel to them;
        otherwise both sides meet by key.
        """
        base, asked = self._base(), self._asked()
        if not requests_travel(self.table.df, self.requests):
            return base.join(asked, self._on, how)
        met = base.join(asked, self._on, "left" if how == "full" else "inner")
        return met.unionByName(self._absent(base).select(*[quoted(c) for c in met.columns]))

    def _after(self, name: str) -> Column:
        """New value of a column on a carried-out request."""
        if name in self.table.keys:
            return F.coalesce(quoted(name), quoted(_key(name)))
        if self.deletes:
            return F.lit(None)
        return self.changes.get(name, quoted(name))

    # -- results ------------------------------------------------------------------------------

    @property
    def columns(self) -> list[str]:
        return [*self.table.df.columns, *self.added]

    @property
    def state(self) -> DataFrame:
        """All items after the batch."""
        table = self.table
        if self.deletes:
            on = self._on if self.condition is None else self._on & self.condition
            return table.df.join(self.requests, on, "left_anti")
        joined = self._joined("full")
        if self.drops is not None:
            joined = joined.where(F.col("__asked").isNull() | ~self.drops)
        hit = F.col("__asked").isNotNull() & F.coalesce(self._ok, F.lit(False))
        free = self.condition is None and self.refused is None
        if free:
            hit = F.col("__asked").isNotNull()
        else:
            joined = joined.where(F.col("__old").isNotNull() | hit)
        columns = []
        for name in self.columns:
            if name in table.keys:
                columns.append(self._after(name).alias(name))
            elif name in self.changes:
                columns.append(F.when(hit, self.changes[name]).otherwise(quoted(name)).alias(name))
            else:
                columns.append(quoted(name))
        return joined.select(*columns)

    @property
    def table_after(self) -> ItemTable:
        return self.table.with_df(self.state)

    @property
    def failures(self) -> DataFrame:
        """Refused requests: their key and a code."""
        keys = self.table.keys
        parts = []
        if self.condition is not None or self.refused is not None:
            rows = self._joined("right")
            if self.condition is not None:
                code = F.when(~self.condition, F.lit(CONDITION_FAILED))
                if self.refused is not None:
                    code = code.when(self.refused, F.lit(VALIDATION))
            else:
                code = F.when(self.refused, F.lit(VALIDATION))
            rows = rows.select(*[quoted(_key(k)).alias(k) for k in keys], code.alias("code"))
            parts.append(rows.where(F.col("code").isNotNull()))
        if self.rejected is not None:
            parts.append(self.rejected)
        if not parts:
            none = self.requests.select(*[quoted(_key(k)).alias(k) for k in keys], F.lit(VALIDATION).alias("code"))
            return none.where(F.lit(False))
        return reduce(DataFrame.unionByName, parts)

    def return_values(self, mode: str = "NONE") -> DataFrame:
        """Images of the carried-out requests: key plus old or new attributes, all or only the touched ones."""
        if mode not in RETURN_MODES:
            mode = "ALL_NEW"
        keys = self.table.keys
        rows = self._joined("right").where(F.coalesce(self._ok, F.lit(False)))
        key_columns = [quoted(_key(k)).alias(k) for k in keys]
        if mode == "NONE":
            return rows.select(*key_columns).where(F.lit(False))
        if mode.endswith("_OLD") or self.deletes:
            rows = rows.where(F.col("__old").isNotNull())
        touched = list(self.changes) if mode.startswith("UPDATED") else [c for c in self.columns if c not in keys]
        if mode.endswith("_OLD"):
            return rows.select(*key_columns, *[quoted(c) for c in touched])
        return rows.select(*key_columns, *[self._after(c).alias(c) for c in touched])


# -- put --------------------------------------------------------------------------------------


def last_write_wins(items: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """Several puts of one key as one: of each attribute the value put last.

    The result names the attributes that any of the puts carried in ``_present``.
    """
    attributes = [c for c in items.columns if c not in (*keys, seq, PRESENT)]
    key_columns = [quoted(k) for k in keys]
    if PRESENT not in items.columns:
        merged = items.groupBy(*key_columns).agg(
            F.max_by(F.struct(*[quoted(a) for a in attributes]), quoted(seq)).alias("__last")
        )
        return merged.select(
            *key_columns,
            *[F.col("__last").getField(a).alias(a) for a in attributes],
            F.array(*[F.lit(a) for a in attributes]).cast("array<string>").alias(PRESENT),
        )
    aggregates = []
    for name in attributes:
        carried = F.array_contains(PRESENT, name)
        aggregates.append(F.max_by(quoted(name), F.when(carried, quoted(seq))).alias(name))
        aggregates.append(F.bool_or(carried).alias(_has(name)))
    merged = items.groupBy(*key_columns).agg(*aggregates)
    names = F.array_compact(F.array(*[F.when(F.col(_has(a)), F.lit(a)) for a in attributes]))
    return merged.select(*key_columns, *[quoted(a) for a in attributes], names.cast("array<string>").alias(PRESENT))


def put_items(
    table: ItemTable,
    items: DataFrame,
    condition: str | None = None,
    names: Mapping[str, str] | None = None,
    values: Mapping[str, Any] | None = None,
    seq: str | None = None,
    mode: str = "merge",
    unique: bool = False,
) -> WriteResult:
    """Insert or update items.

    ``merge`` keeps attributes an item does not carry (``_present`` names those it does; without
    that column it carries all of its columns); ``replace`` drops them. ``seq`` orders several
    items of one key. Without it such items are refused, unless ``unique`` says there are none.
    """
    if mode not in ("merge", "replace"):
        raise ValidationError("mode is 'merge' or 'replace'")
    _need_keys(table, items)
    items, off = fitting_keys(table, items)
    rejected = None
    if seq is not None:
        if condition is not None:
            raise ValidationError("a conditional put takes one item per key")
        rejected = items.where(~table.has_key).select(*[quoted(k) for k in table.keys], F.lit(VALIDATION).alias("code"))
        items = last_write_wins(items.where(table.has_key), table.keys, seq)
    elif not unique:
        items, rejected = unique_requests(table, items)
    rejected = _with(rejected, off)
    tracked = PRESENT in items.columns
    attributes = [c for c in items.columns if c not in (*table.keys, PRESENT)]
    kinds = {f.name: f.dataType for f in table.df.schema.fields}
    payload, misfits = [], []
    for name in attributes:
        value = quoted(name)
        if name in kinds and loose(kinds[name]) != loose(items.schema[name].dataType):
            value, misfit = U.fitted(value, items.schema[name].dataType, kinds[name])
            if misfit is not None:
                misfits.append(misfit & F.array_contains(PRESENT, name) if tracked else misfit)
        payload.append(value.alias(_new(name)))
        if tracked:
            payload.append(F.array_contains(PRESENT, name).alias(_has(name)))
    if misfits:
        payload.append(reduce(lambda a, b: a | b, misfits).alias(BAD))
    requests = items.select(*[quoted(k).cast(kinds[k]).alias(_key(k)) for k in table.keys], *payload)
    changes = {}
    for name in attributes:
        value = quoted(_new(name))
        if tracked:
            kept = quoted(name) if mode == "merge" else F.lit(None)
            value = F.when(quoted(_has(name)), value).otherwise(kept)
        changes[name] = value
    if mode == "replace":
        for name in table.attributes:
            changes.setdefault(name, F.lit(None).cast(kinds[name]))
    return WriteResult(
        table,
        requests,
        changes,
        condition_column(condition, names, values, table.df.schema) if condition else None,
        refused=F.col(BAD) if misfits else None,
        rejected=rejected,
        added={a: items.schema[a].dataType for a in attributes if a not in kinds},
    )


def batch_put(table: ItemTable, items: DataFrame, seq: str | None = None) -> WriteResult:
    """Unconditional bulk put."""
    return put_items(table, items, seq=seq)


def put_nested(table: ItemTable, items: DataFrame, path: str, value: str, **options: Any) -> WriteResult:
    """Put whose attribute is a dotted path: one field of a map attribute gets column ``value`` of the items."""
    column, *rest = path.split(".")
    action = U.set_path(column, rest, quoted(value))
    return update_items(table, items, [action], **options)


def merge_images(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Old items overlaid with the attributes the new ones carry; keys of either side."""
    table = ItemTable("images", old, keys[0], keys[1] if len(keys) > 1 else None)
    return put_items(table, new, unique=True).state


# -- delete -----------------------------------------------------------------------------------


def delete_items(
    table: ItemTable,
    keys: DataFrame,
    condition: str | None = None,
    names: Mapping[str, str] | None = None,
    values: Mapping[str, Any] | None = None,
) -> WriteResult:
    """Remove the items with these keys; a key without an item is fine."""
    _need_keys(table, keys)
    keys, off = fitting_keys(table, keys)
    key_columns = [quoted(k) for k in table.keys]
    rejected = _with(keys.where(~table.has_key).select(*key_columns, F.lit(VALIDATION).alias("code")), off)
    requests = keys.where(table.has_key).select(*[quoted(k).alias(_key(k)) for k in table.keys]).distinct()
    return WriteResult(
        table,
        requests,
        condition=condition_column(condition, names, values, table.df.schema) if condition else None,
        rejected=rejected,
        deletes=True,
    )


def batch_delete(table: ItemTable, keys: DataFrame) -> WriteResult:
    """Unconditional bulk delete."""
    return delete_items(table, keys)


# -- mixed batches ----------------------------------------------------------------------------

#: marks a request row that drops what was there before it / that puts something
RESET, PUTS = "_reset", "_puts"


def as_requests(df: DataFrame, keys: Sequence[str], op: str, seq: str, attributes: Sequence[str]) -> DataFrame:
    """Write requests (``op``: put or delete) in the form ``fold_requests`` takes; the order is column ``_at``."""
    is_put = F.lower(quoted(op)) == "put"
    carried = F.col(PRESENT) if PRESENT in df.columns else F.array(*[F.lit(a) for a in attributes])
    return df.select(
        *[quoted(k) for k in keys],
        *[quoted(a) for a in attributes],
        F.when(is_put, carried).otherwise(F.array().cast("array<string>")).cast("array<string>").alias(PRESENT),
        (~is_put).alias(RESET),
        is_put.alias(PUTS),
        quoted(seq).alias("_at"),
    )


def fold_requests(requests: DataFrame, keys: Sequence[str], attributes: Sequence[str], at: str = "_at") -> DataFrame:
    """All requests of a key as one, in the order of ``at``. Folding folded rows again gives the same.

    Everything is a maximum per key, so it combines before the shuffle whatever the number of
    requests a key has.
    """
    order = quoted(at)
    aggregates = [
        F.max(F.when(F.col(RESET), order)).alias("__reset_at"),
        F.max(F.when(F.col(PUTS), order)).alias("__put_at"),
        F.max(order).alias(at),
    ]
    for name in attributes:
        carried = F.when(F.array_contains(PRESENT, name), order)
        aggregates.append(F.max_by(quoted(name), carried).alias(name))
        aggregates.append(F.max(carried).alias(_has(name)))
    folded = requests.groupBy(*[quoted(k) for k in keys]).agg(*aggregates)

    # a request row that resets and puts at once does it in this order
    def alive(c: Column) -> Column:
        return F.coalesce(c >= F.col("__reset_at"), c.isNotNull())

    names = F.array_compact(F.array(*[F.when(alive(quoted(_has(a))), F.lit(a)) for a in attributes]))
    return folded.select(
        *[quoted(k) for k in keys],
        *[F.when(alive(quoted(_has(a))), quoted(a)).alias(a) for a in attributes],
        names.cast("array<string>").alias(PRESENT),
        F.col("__reset_at").isNotNull().alias(RESET),
        F.coalesce(alive(F.col("__put_at")), F.lit(False)).alias(PUTS),
        quoted(at),
    )


def apply_requests(table: ItemTable, folded: DataFrame) -> DataFrame:
    """State after folded requests (one row per key)."""
    attributes = [a for a in table.attributes if a in folded.columns]
    kinds = {f.name: f.dataType for f in table.df.schema.fields}
    requests = folded.select(
        *[quoted(k).alias(_key(k)) for k in table.keys],
        *[quoted(a).cast(loose(kinds[a])).alias(_new(a)) for a in attributes],
        *[F.array_contains(PRESENT, a).alias(_has(a)) for a in attributes],
        RESET,
        PUTS,
    )
    result = WriteResult(table, requests)
    joined = result._joined("full")
    joined = joined.where(F.col("__asked").isNull() | F.col(PUTS) | (~F.col(RESET) & F.col("__old").isNotNull()))
    columns = []
    for name in table.df.columns:
        if name in table.keys:
            columns.append(result._after(name).alias(name))
        elif name in attributes:
            value = F.when(quoted(_has(name)), quoted(_new(name))).when(~F.coalesce(F.col(RESET), F.lit(False)), quoted(name))
            columns.append(value.alias(name))
        else:
            columns.append(F.when(~F.coalesce(F.col(RESET), F.lit(False)), quoted(name)).alias(name))
    return joined.select(*columns)


@dataclass(frozen=True)
class BatchWriteResult:
    state: DataFrame
    unprocessed: DataFrame


def batch_write(table: ItemTable, requests: DataFrame, op: str = "op", seq: str | None = None) -> BatchWriteResult:
    """Puts and deletes of one table: all puts first (in ``seq`` order), then all deletes.

    Requests without a whole key, with another ``op`` or with a value that its attribute cannot hold come back as unprocessed.
    """
    _need_keys(table, requests)
    fit = table.has_key & F.coalesce(F.lower(quoted(op)).isin("put", "delete"), F.lit(False)) & ~F.col(BAD)
    attributes = [c for c in requests.columns if c not in (*table.keys, op, seq, PRESENT)]
    unknown = [a for a in attributes if a not in table.df.columns]
    if unknown:
        raise ValidationError(f"table {table.name!r} has no attributes {', '.join(unknown)}")
    requests = typed_requests(table, requests, [*table.keys, *attributes])
    good, bad = requests.where(fit), requests.where(~fit)
    turn = (F.lower(quoted(op)) == "delete").cast("int")
    order = F.struct(turn.alias("turn"), quoted(seq).alias("at")) if seq else turn
    rows = as_requests(good.withColumn("__order", order), table.keys, op, "__order", attributes)
    folded = fold_requests(rows, table.keys, attributes)
    failed = bad.select(*[quoted(k) for k in table.keys], quoted(op), F.lit(VALIDATION).alias("code"))
    return BatchWriteResult(apply_requests(table, folded), failed)


def batch_write_many(catalog, requests: Mapping[str, DataFrame], **options: Any) -> dict[str, BatchWriteResult]:
    """One result per table; an unknown table is an error before anything runs."""
    tables = {name: catalog.table(name) for name in requests}
    return {name: batch_write(tables[name], df, **options) for name, df in requests.items()}


# -- update -----------------------------------------------------------------------------------


def update_items(
    table: ItemTable,
    requests: DataFrame,
    expression: str | Sequence[U.Action],
    names: Mapping[str, str] | None = None,
    values: Mapping[str, Any] | None = None,
    condition: str | None = None,
    seq: str | None = None,
    unique: bool = False,
) -> WriteResult:
    """One update expression for many keys. A value given as a column is read from each request.

    ``expression`` is text (``SET a = a + :v REMOVE b``) or actions. A key without an item gets
    one. ``seq`` orders several requests of one key, which are then folded into one.
    """
    _need_keys(table, requests)
    requests, off = fitting_keys(table, requests)
    actions = U.actions_from_text(expression, names, values) if isinstance(expression, str) else list(expression)
    whole = [a.column for a in actions]
    if len(set(whole)) != len(whole):
        raise ValidationError("an update expression names each attribute once")
    if set(whole) & set(table.keys):
        raise ValidationError("key attributes cannot be updated")
    schema = table.df.schema
    kinds = {f.name: f.dataType for f in schema.fields}
    per_row_condition = {k: v for k, v in (values or {}).items() if isinstance(v, Column)} if condition else {}
    bound = {k: v for k, v in (values or {}).items() if k not in per_row_condition}
    extra = []
    for k, v in per_row_condition.items():
        extra.append(v.alias(f"__c{k[1:]}"))
        bound[k] = SqlText(f"`__c{k[1:]}`")
    asked = requests.select(*[quoted(k) for k in table.keys], *U.payload(actions, schema), *extra, *([quoted(seq).alias("__seq")] if seq else []))
    if seq:
        if condition:
            raise ValidationError("a conditional update takes one request per key")
        rejected = asked.where(~table.has_key).select(*[quoted(k) for k in table.keys], F.lit(VALIDATION).alias("code"))
        asked = U.fold_updates(asked.where(table.has_key), table.keys, "__seq", actions, schema)
    elif unique:
        rejected = None
    else:
        asked, rejected = unique_requests(table, asked)
    rejected = _with(rejected, off)
    rows = asked.select(
        *[quoted(k).cast(kinds[k]).alias(_key(k)) for k in table.keys],
        *[quoted(c) for c in asked.columns if c not in table.keys],
    )
    changes, violations, added = {}, [], {}
    for at, action in enumerate(actions):
        kind = kinds.get(action.column)
        new = U.new_value(action, quoted(action.column), kind, at, rows.schema)
        broken = U.violation(action, quoted(action.column), new, kind, at, rows.schema)
        if broken is not None:
            violations.append(broken)
        if kind is None:
            if action.kind in ("remove", "remove_index", "path", "expression"):
                raise ValidationError(f"table {table.name!r} has no attribute {action.column!r}")
            added[action.column] = rows.schema[U.payload_name(at)].dataType
        changes[action.column] = new
    return WriteResult(
        table,
        rows,
        changes,
        condition_column(condition, names, bound, schema) if condition else None,
        refused=reduce(lambda a, b: a | b, violations) if violations else None,
        rejected=rejected,
        added=added,
    )
