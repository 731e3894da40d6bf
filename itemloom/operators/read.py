"""Keyed and filtered reads: get, batch get, query, scan, count, paging."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import ValidationError
from ..functions.codec import item_json
from ..functions.exprs import predicate, sql_literal
from ..functions.tagged import untag
from ..table import Catalog, ItemTable, quoted
from .sizes import fits_broadcast

#: rows of a page when the request states no limit
DEFAULT_LIMIT = 5000

#: least number of parts that the rows of one partition key are spread over when they meet many asked keys
KEY_SLICES = 16


def key_slices(df: DataFrame) -> int:
    """A part for each shuffle partition, so a hot key uses the cluster it runs on."""
    return max(KEY_SLICES, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))

_UNHASHED = (T.MapType, T.VariantType, T.StructType, T.ArrayType)

Names = Mapping[str, str] | None
Values = Mapping[str, Any] | None


# -- projection -------------------------------------------------------------------------------


def projected_names(table: ItemTable, expression: str | None, names: Names = None) -> list[str]:
    """Columns of a comma list: unknown names vanish, repeats collapse, order is kept."""
    if not expression:
        return table.columns
    asked = [(names or {}).get(p, p) for p in (part.strip() for part in expression.split(","))]
    known = set(table.columns)
    return [c for c in dict.fromkeys(asked) if c in known]


def project(table: ItemTable, expression: str | None = None, names: Names = None) -> DataFrame:
    return table.df.select(*[quoted(c) for c in projected_names(table, expression, names)])


def names_with_keys(table: ItemTable, expression: str | None, names: Names = None) -> list[str]:
    """Projection of queries: the keys (of an index also those of its table) always come along."""
    chosen = projected_names(table, expression, names)
    return list(dict.fromkeys([*chosen, *table.keys, *table.base_keys]))


def project_with_keys(table: ItemTable, expression: str | None, names: Names = None) -> DataFrame:
    return table.df.select(*[quoted(c) for c in names_with_keys(table, expression, names)])


def all_columns(table: ItemTable) -> DataFrame:
    return project(table)


# -- rows of a query --------------------------------------------------------------------------


def matching(
    table: ItemTable,
    key_condition: str | None = None,
    filter: str | None = None,
    names: Names = None,
    values: Values = None,
) -> DataFrame:
    """Rows that have a sort key and meet key condition and filter."""
    df = table.df
    if table.sort_key:
        df = df.where(quoted(table.sort_key).isNotNull())
    for text in (key_condition, filter):
        if text:
            df = df.where(predicate(text, names, values, table.df.schema))
    return df


def sort_order(table: ItemTable, ascending: bool = False) -> list[Column]:
    """By sort key, descending unless asked otherwise; ties by the other keys."""
    order = []
    if table.sort_key:
        key = quoted(table.sort_key)
        order.append(key.asc() if ascending else key.desc())
    rest = [table.partition_key, *[k for k in table.base_keys if k not in table.keys]]
    return [*order, *[quoted(k).asc() for k in rest]]


def start_offset(start: int | Mapping[str, Any] | None) -> int:
    """Rows to skip: a number, or the ``offset`` number of a start key."""
    if isinstance(start, Mapping):
        start = untag(start.get("offset"))
    return int(start) if isinstance(start, (int, float)) and not isinstance(start, bool) else 0


def query(
    table: ItemTable,
    key_condition: str | None = None,
    filter: str | None = None,
    project: str | None = None,
    names: Names = None,
    values: Values = None,
    index: str | None = None,
    limit: int | None = None,
    start: int | Mapping[str, Any] | None = None,
    ascending: bool = False,
    ordered: bool | None = None,
) -> DataFrame:
    """Filtered, projected rows of a table or index.

    Rows come sorted when a limit or an offset cuts them, or with ``ordered=True``; an uncut
    result is left unsorted, which saves a shuffle of the whole table.
    """
    view = table.index(index) if index else table
    skip = start_offset(start)
    df = matching(view, key_condition, filter, names, values)
    if ordered if ordered is not None else (limit is not None or skip > 0):
        df = df.orderBy(*sort_order(view, ascending))
    if skip:
        df = df.offset(skip)
    if limit is not None:
        df = df.limit(limit)
    return df.select(*[quoted(c) for c in names_with_keys(view, project, names)])


def scan(table: ItemTable, filter: str | None = None, count: bool = False, **options: Any) -> DataFrame:
    """Whole-table read with the options of ``query``; ``count=True`` gives one count row."""
    if count:
        picked = {k: options.get(k) for k in ("names", "values", "index")}
        return count_items(table, filter=filter, **picked)
    return query(table, filter=filter, **options)


def count_items(
    table: ItemTable,
    key_condition: str | None = None,
    filter: str | None = None,
    names: Names = None,
    values: Values = None,
    index: str | None = None,
) -> DataFrame:
    """Number of matching rows; limit and projection play no part."""
    view = table.index(index) if index else table
    rows = matching(view, key_condition, filter, names, values)
    return rows.agg(F.count(quoted(view.partition_key)).alias("count"))


def count_by_partition(
    table: ItemTable,
    filter: str | None = None,
    names: Names = None,
    values: Values = None,
    index: str | None = None,
) -> DataFrame:
    """One count per partition key."""
    view = table.index(index) if index else table
    rows = matching(view, None, filter, names, values).where(quoted(view.partition_key).isNotNull())
    return rows.groupBy(quoted(view.partition_key)).agg(F.count(F.lit(1)).alias("count"))


# -- paging -----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Page:
    """One page: its items, and one row with the key to go on from (no row on the last page)."""

    items: DataFrame
    last_key: DataFrame
    #: the rows of the page and the first one of the next, in order
    top: DataFrame
    keys: tuple[str, ...]
    limit: int
    skip: int

    def fetch(self) -> tuple[list[Row], dict[str, Any] | None]:
        """Items and the key to go on from, by one sorted read."""
        rows = self.top.collect()
        if len(rows) <= self.limit:
            return rows, None
        return rows[: self.limit], {k: rows[self.limit - 1][k] for k in self.keys} | {"offset": self.skip + self.limit}

    @property
    def count(self) -> DataFrame:
        return self.items.agg(F.count(F.lit(1)).alias("count"))


def query_page(
    table: ItemTable,
    key_condition: str | None = None,
    filter: str | None = None,
    project: str | None = None,
    names: Names = None,
    values: Values = None,
    index: str | None = None,
    limit: int | None = None,
    start: int | Mapping[str, Any] | None = None,
    ascending: bool = False,
) -> Page:
    """A page of ``limit`` rows; one row beyond the page tells whether there is a next one."""
    limit = DEFAULT_LIMIT if limit is None else limit
    if limit < 1:
        raise ValidationError("a page has at least one row")
    skip = start_offset(start)
    view = table.index(index) if index else table
    common = dict(key_condition=key_condition, filter=filter, names=names, values=values, index=index)
    items = query(table, **common, project=project, limit=limit, start=skip, ascending=ascending)
    top = query(table, **common, project=project, limit=limit + 1, start=skip, ascending=ascending)
    keys = list(dict.fromkeys([*view.keys, *view.base_keys]))
    tail = query(table, **common, project=",".join(keys), limit=limit + 1, start=skip, ascending=ascending)
    # no more rows than a page and one
    position = Window.orderBy(*sort_order(view, ascending))
    last_key = (
        tail.withColumn("__at", F.row_number().over(position))
        .withColumn("__more", F.lead(F.lit(True)).over(position))
        .where((F.col("__at") == limit) & F.col("__more"))
        .select(*[quoted(k) for k in keys], F.lit(skip + limit).cast("long").alias("offset"))
    )
    return Page(items, last_key, top, tuple(keys), limit, skip)


def _content_slice(df: DataFrame, slices: int) -> Column:
    """A slice number by a hash of the row's content: a task that runs again slices the same way."""
    scalar = [f.name for f in df.schema.fields if not isinstance(f.dataType, _UNHASHED)]
    return F.pmod(F.xxhash64(*[quoted(c) for c in scalar]), F.lit(slices)).cast("int")


def first_per_partition(df: DataFrame, partition: str, order: Sequence[Column], n: int, rank: str) -> DataFrame:
    """The first ``n`` rows of every partition key, numbered in ``rank``.

    For a small ``n`` Spark cuts every partition key before the shuffle by itself. Beyond that
    setting a key is first cut in slices spread over the cluster, so no key is sorted whole by one task.
    """
    spark = df.sparkSession
    if n > int(spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
        sliced = df.withColumn("__slice", _content_slice(df, slices))
        within = Window.partitionBy(quoted(partition), "__slice").orderBy(*order)
        df = sliced.withColumn(rank, F.row_number().over(within)).where(F.col(rank) <= n).drop("__slice", rank)
    window = Window.partitionBy(quoted(partition)).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)


def query_pages(
    table: ItemTable,
    limit: int,
    keys: DataFrame | None = None,
    filter: str | None = None,
    project: str | None = None,
    names: Names = None,
    values: Values = None,
    index: str | None = None,
    ascending: bool = False,
) -> DataFrame:
    """The first page of every partition key (of those in ``keys``) in one plan.

    ``keys`` may carry a column ``after``: the sort key its page starts behind. Added columns:
    ``page_rank`` (1 is the first row), ``has_more``, and ``is_last_key`` on the row whose
    key starts the next page.
    """
    view = table.index(index) if index else table
    rows = matching(view, None, filter, names, values).where(quoted(view.partition_key).isNotNull())
    chosen = names_with_keys(view, project, names)
    if keys is not None:
        rows = _rows_of_keys(rows, view, keys, ascending)
    rows = rows.select(*[quoted(c) for c in chosen])
    rows = first_per_partition(rows, view.partition_key, sort_order(view, ascending), limit + 1, "page_rank")
    whole = Window.partitionBy(quoted(view.partition_key))
    return (
        rows.withColumn("has_more", F.max("page_rank").over(whole) > limit)
        .where(F.col("page_rank") <= limit)
        .withColumn("is_last_key", F.col("has_more") & (F.col("page_rank") == limit))
    )


def _rows_of_keys(rows: DataFrame, view: ItemTable, keys: DataFrame, ascending: bool) -> DataFrame:
    """Rows of the asked partition keys, behind their start where one is given.

    A partition key may hold a large part of the table. Few keys travel to the rows; many keys meet
    them in slices, each key once per slice, so that the rows of one key are spread.
    """
    partition = quoted(view.partition_key)
    if "after" in keys.columns:
        if not view.sort_key:
            raise ValidationError("a page that starts behind a sort key needs a table with one")
        start = F.min("after") if ascending else F.max("after")
        asked = keys.groupBy(partition.alias("__pk")).agg(start.alias("__after"))
    else:
        asked = keys.select(partition.alias("__pk")).distinct()
    on = partition == F.col("__pk")
    if not fits_broadcast(asked):
        slices = key_slices(rows)
        asked = asked.withColumn("__part", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
        rows = rows.withColumn("__slice", _content_slice(rows, slices))
        on = on & (F.col("__slice") == F.col("__part"))
    if "after" in keys.columns:
        sort = quoted(view.sort_key)
        behind = sort > F.col("__after") if ascending else sort < F.col("__after")
        met = rows.join(asked, on).where(F.col("__after").isNull() | behind)
    else:
        met = rows.join(asked, on, "left_semi")
    return met.drop("__pk", "__after", "__part", "__slice")


def query_index(table: ItemTable, index: str, **options: Any) -> DataFrame:
    return query(table, index=index, **options)


def keyset_page(
    table: ItemTable,
    after: Mapping[str, Any] | None,
    limit: int,
    ascending: bool = False,
    key_condition: str | None = None,
    filter: str | None = None,
    project: str | None = None,
    names: Names = None,
    values: Values = None,
    index: str | None = None,
) -> DataFrame:
    """Next page behind a key, without counting off the rows before it."""
    view = table.index(index) if index else table
    df = matching(view, key_condition, filter, names, values)
    if after is not None:
        df = df.where(_behind(view, after, ascending))
    df = df.orderBy(*sort_order(view, ascending)).limit(limit)
    return df.select(*[quoted(c) for c in names_with_keys(view, project, names)])


def _behind(view: ItemTable, after: Mapping[str, Any], ascending: bool) -> Column:
    """Rows past ``after`` in the sort order of ``view``."""
    steps = [(view.sort_key, ascending)] if view.sort_key else []
    steps += [(k, True) for k in [view.partition_key, *[b for b in view.base_keys if b not in view.keys]]]
    past, equal = F.lit(False), F.lit(True)
    for name, up in steps:
        if name not in after:
            raise ValidationError(f"the start key lacks {name!r}")
        bound = F.expr(sql_literal(untag(after[name])))
        column = quoted(name)
        past = past | (equal & (column > bound if up else column < bound))
        equal = equal & (column == bound)
    if view.sort_key:
        # stated alone as well, so that it reaches the scan
        first = F.expr(sql_literal(untag(after[view.sort_key])))
        edge = quoted(view.sort_key) >= first if ascending else quoted(view.sort_key) <= first
        past = edge & past
    return past


# -- keyed reads ------------------------------------------------------------------------------


def key_filter(table: ItemTable, key: Mapping[str, Any]) -> Column:
    missing = [k for k in table.keys if k not in key]
    if missing:
        raise ValidationError(f"the key lacks {', '.join(missing)}")
    parts = [quoted(k) == F.expr(sql_literal(untag(key[k]))) for k in table.keys]
    return reduce(lambda a, b: a & b, parts)


def get_item(table: ItemTable, key: Mapping[str, Any], project: str | None = None, names: Names = None) -> DataFrame:
    """The item with this key: one row or none."""
    found = table.df.where(key_filter(table, key))
    return found.select(*[quoted(c) for c in projected_names(table, project, names)])


def _distinct_keys(table: ItemTable, keys: DataFrame) -> DataFrame:
    missing = [k for k in table.keys if k not in keys.columns]
    if missing:
        raise ValidationError(f"the keys lack {', '.join(missing)}")
    # combined before the shuffle, so a key asked for very often is no hot spot
    return keys.select(*[quoted(k) for k in table.keys]).distinct()


def batch_get(
    table: ItemTable, keys: DataFrame, project: str | None = None, names: Names = None, push_keys: int = 0
) -> DataFrame:
    """Items of many keys; a missing key gives no row, a repeated one gives one.

    With ``push_keys`` a job first looks whether at most that many partition keys are asked for; if so they
    are also stated as a filter, which lets the scan of a table sorted by key skip most of it.
    """
    asked = _distinct_keys(table, keys)
    items = table.df
    if push_keys > 0:
        few = asked.select(quoted(table.partition_key)).distinct().limit(push_keys + 1).collect()
        if len(few) <= push_keys:
            items = items.where(quoted(table.partition_key).isin([r[0] for r in few]))
    found = items.join(asked, table.keys, "left_semi")
    return found.select(*[quoted(c) for c in projected_names(table, project, names)])


def missing_keys(table: ItemTable, keys: DataFrame) -> DataFrame:
    """Asked-for keys that have no item."""
    return _distinct_keys(table, keys).join(table.df.select(*[quoted(k) for k in table.keys]), table.keys, "left_anti")


def batch_get_many(catalog: Catalog, requests: Mapping[str, DataFrame], **options: Any) -> dict[str, DataFrame]:
    """One result per table."""
    return {name: batch_get(catalog.table(name), keys, **options) for name, keys in requests.items()}


@dataclass(frozen=True)
class GetRequest:
    table: str
    keys: DataFrame
    project: str | None = None
    names: Names = None


def transact_get(catalog: Catalog, requests: Sequence[GetRequest]) -> DataFrame:
    """Items of several tables as ``(table, item)``, the item as tagged JSON; missing keys give no row.

    All rows come from the states the catalog points at when the plan is built.
    """
    parts = []
    for request in requests:
        rows = batch_get(catalog.table(request.table), request.keys, request.project, request.names)
        parts.append(rows.select(F.lit(request.table).alias("table"), item_json(rows).alias("item")))
    if not parts:
        raise ValidationError("no requests")
    return reduce(DataFrame.unionByName, parts)
