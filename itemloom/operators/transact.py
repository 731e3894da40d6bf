"""All-or-nothing batches over several tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..errors import CONDITION_FAILED, VALIDATION, ValidationError
from ..functions import updates as U
from ..functions.exprs import condition as condition_column
from ..table import Catalog, ItemTable, quoted
from .write import WriteResult, _key, _with, delete_items, fitting_keys, put_items, update_items


@dataclass(frozen=True)
class Put:
    table: str
    rows: DataFrame
    condition: str | None = None
    names: Mapping[str, str] | None = None
    values: Mapping[str, Any] | None = None


@dataclass(frozen=True)
class Update:
    table: str
    rows: DataFrame
    expression: str | Sequence[U.Action]
    condition: str | None = None
    names: Mapping[str, str] | None = None
    values: Mapping[str, Any] | None = None


@dataclass(frozen=True)
class Delete:
    table: str
    rows: DataFrame
    condition: str | None = None
    names: Mapping[str, str] | None = None
    values: Mapping[str, Any] | None = None


@dataclass(frozen=True)
class Check:
    table: str
    rows: DataFrame
    condition: str
    names: Mapping[str, str] | None = None
    values: Mapping[str, Any] | None = None


Request = Put | Update | Delete | Check


def condition_check(
    table: ItemTable,
    keys: DataFrame,
    condition: str,
    names: Mapping[str, str] | None = None,
    values: Mapping[str, Any] | None = None,
) -> DataFrame:
    """``holds`` for every asked-for whole key; a missing item is checked as one without attributes."""
    requests = keys.where(table.has_key).select(*[quoted(k).alias(_key(k)) for k in table.keys]).distinct()
    rows = WriteResult(table, requests)._joined("right")
    holds = condition_column(condition, names, values, table.df.schema)
    return rows.select(*[quoted(_key(k)).alias(k) for k in table.keys], holds.alias("holds"))


def _planned(request: Request, table: ItemTable, checked: bool) -> WriteResult:
    """The request against ``table``; once ``checked``, its condition is known to hold."""
    options = dict(names=request.names, values=request.values)
    if not checked:
        options["condition"] = request.condition
    if isinstance(request, Put):
        return put_items(table, request.rows, unique=checked, **options)
    if isinstance(request, Update):
        return update_items(table, request.rows, request.expression, unique=checked, **options)
    if isinstance(request, Delete):
        return delete_items(table, request.rows, **options)
    raise ValidationError(f"unknown request {request!r}")


#: number of the request that a row of a tagged frame belongs to
REQUEST = "__r"


def _checked(request: Check, table: ItemTable) -> WriteResult:
    """A check as a request that writes nothing."""
    keys, off = fitting_keys(table, request.rows)
    partial = _with(keys.where(~table.has_key).select(*[quoted(k) for k in table.keys], F.lit(VALIDATION).alias("code")), off)
    asked = keys.where(table.has_key).select(*[quoted(k).alias(_key(k)) for k in table.keys]).distinct()
    condition = condition_column(request.condition, request.names, request.values, table.df.schema)
    return WriteResult(table, asked, condition=condition, rejected=partial)


def _grouped(plans: Sequence[tuple[int, WriteResult]]) -> list[list[tuple[int, WriteResult]]]:
    """Requests whose payloads go into one frame: what has one name in two of them has one type."""
    groups: list[tuple[dict[str, Any], list[tuple[int, WriteResult]]]] = []
    for at, plan in plans:
        kinds = {f.name: f.dataType for f in plan.requests.schema.fields} | {f"+{n}": k for n, k in plan.added.items()}
        for known, members in groups:
            if all(known.get(n, k) == k for n, k in kinds.items()):
                known |= kinds
                members.append((at, plan))
                break
        else:
            groups.append((dict(kinds), [(at, plan)]))
    return [members for _, members in groups]


def _tagged(plans: Sequence[tuple[int, WriteResult]]) -> DataFrame:
    """The requests of several plans on one table, each row with its number."""
    frames = [plan.requests.withColumn(REQUEST, F.lit(at)) for at, plan in plans]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _table_failures(table: ItemTable, plans: Sequence[tuple[int, WriteResult]]) -> list[DataFrame]:
    """``request``, key and ``code`` of what the plans refuse. All conditions of a group are looked at in one join with the table."""
    keys = [quoted(k) for k in table.keys]
    parts = [plan.rejected.select(F.lit(at).alias("request"), *keys, "code") for at, plan in plans if plan.rejected is not None]
    for group in _grouped([(at, p) for at, p in plans if p.condition is not None or p.refused is not None]):
        code = F.lit(None).cast("string")
        for at, plan in group:
            mine = F.col(REQUEST) == at
            if plan.refused is not None:
                code = F.when(mine & plan.refused, F.lit(VALIDATION)).otherwise(code)
            if plan.condition is not None:
                code = F.when(mine & ~plan.condition, F.lit(CONDITION_FAILED)).otherwise(code)
        rows = WriteResult(table, _tagged(group))._joined("right")
        rows = rows.select(F.col(REQUEST).alias("request"), *[quoted(_key(k)).alias(k) for k in table.keys], code.alias("code"))
        parts.append(rows.where(F.col("code").isNotNull()))
    return parts


def _table_after(table: ItemTable, plans: Sequence[tuple[int, WriteResult]]) -> ItemTable:
    """The table after requests that are known to be carried out, no two of them on one key: one join for each group of payloads."""
    for group in _grouped(plans):
        added = {n: k for _, p in group for n, k in p.added.items() if n not in table.df.columns}
        wide = [F.lit(None).cast(k).alias(n) for n, k in added.items()]
        base = table.with_df(table.df.select("*", *wide)) if wide else table
        changes = {}
        for name in dict.fromkeys(n for _, p in group for n in p.changes):
            value = quoted(name)
            for at, plan in group:
                if name in plan.changes:
                    value = F.when(F.col(REQUEST) == at, plan.changes[name]).otherwise(value)
            changes[name] = value
        gone = [at for at, plan in group if plan.deletes]
        drops = F.col(REQUEST).isin(gone) if gone else None
        table = base.with_df(WriteResult(base, _tagged(group), changes, drops=drops).state)
    return table


def _key_text(table: ItemTable):
    return F.to_json(F.struct(*[quoted(k) for k in table.keys])).alias("key")


def transaction_failures(catalog: Catalog, requests: Sequence[Request]) -> DataFrame:
    """Reasons to abort: ``(request, table, key, code)``. Conditions read the state before.

    A key that two writing requests aim at is one of them.
    """
    parts = []
    plans: dict[str, list[tuple[int, WriteResult]]] = {}
    for at, request in enumerate(requests):
        table = catalog.table(request.table)
        plan = _checked(request, table) if isinstance(request, Check) else _planned(request, table, checked=False)
        plans.setdefault(table.name, []).append((at, plan))
    for name, own in plans.items():
        table = catalog.table(name)
        for rows in _table_failures(table, own):
            parts.append(rows.select("request", F.lit(name).alias("table"), _key_text(table), "code"))
    for name in dict.fromkeys(catalog.table(r.table).name for r in requests):
        table = catalog.table(name)
        writers = [(at, r) for at, r in enumerate(requests) if catalog.table(r.table).name == name and not isinstance(r, Check)]
        if len(writers) > 1:
            keys = [
                r.rows.select(*[quoted(k) for k in table.keys], F.lit(at).alias("request")).distinct()
                for at, r in writers
            ]
            twice = (
                reduce(DataFrame.unionByName, keys)
                .groupBy(*[quoted(k) for k in table.keys])
                .agg(F.count(F.lit(1)).alias("n"), F.max("request").alias("request"))
                .where("n > 1")
            )
            parts.append(
                twice.select("request", F.lit(name).alias("table"), _key_text(table), F.lit(VALIDATION).alias("code"))
            )
    if not parts:
        text = F.lit("").alias("key")
        return catalog.spark.range(0).select(F.lit(0).alias("request"), F.lit("").alias("table"), text, F.lit("").alias("code"))
    return reduce(DataFrame.unionByName, parts)


@dataclass(frozen=True)
class TransactResult:
    committed: bool
    #: state of every table named, after the commit or (aborted) as before
    states: dict[str, DataFrame]
    failures: DataFrame
    #: per request what it would answer: the written items, or None where nothing is answered
    results: list[DataFrame | None]


def transact_write(catalog: Catalog, requests: Sequence[Request]) -> TransactResult:
    """Puts, updates, deletes and checks over several tables, all or nothing.

    Whether to commit is settled here, by looking for a first failure; the new states stay lazy.
    Writing them out together is ``SnapshotStore.commit``.
    """
    if not requests:
        raise ValidationError("no requests")
    failures = transaction_failures(catalog, requests)
    before = {catalog.table(r.table).name: catalog.table(r.table) for r in requests}
    if not failures.isEmpty():
        return TransactResult(False, {n: t.df for n, t in before.items()}, failures, [None] * len(requests))
    writes: dict[str, list[tuple[int, WriteResult]]] = {}
    results: list[DataFrame | None] = []
    for at, request in enumerate(requests):
        if isinstance(request, Check):
            results.append(None)
            continue
        # no two requests write one key, so each may be planned on the state before
        table = catalog.table(request.table)
        outcome = _planned(request, table, checked=True)
        results.append(None if isinstance(request, Delete) else outcome.return_values("UPDATED_NEW"))
        writes.setdefault(table.name, []).append((at, outcome))
    after = {n: _table_after(t, writes[n]).df if n in writes else t.df for n, t in before.items()}
    return TransactResult(True, after, failures, results)
