"""Change records: what happened to each item between two states of a table, and in which order records are told."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.codec import item_json
from ..sources.snapshots import SnapshotStore
from ..table import ItemTable, quoted


def change_feed(table: ItemTable, new: DataFrame, unchanged: bool = False) -> DataFrame:
    """``table, event_name, keys, old_image, new_image`` per item that was inserted, modified or removed.

    Images are tagged item texts with absent attributes left out. Items are compared column by
    column, null-safe; the texts are built for the changed ones only.
    """
    keys = table.keys
    old = table.df.select(*[quoted(c).alias(f"__o_{c}") for c in table.columns], F.lit(True).alias("__old"))
    fresh = [c for c in new.columns if c != "commit_timestamp"]
    now = new.select(*[quoted(c).alias(f"__n_{c}") for c in fresh], F.lit(True).alias("__now"))
    on = reduce(lambda a, b: a & b, (quoted(f"__o_{k}") == quoted(f"__n_{k}") for k in keys))
    joined = old.join(now, on, "full_outer")

    differs = F.lit(False)
    for name in dict.fromkeys([*table.columns, *fresh]):
        if name in keys:
            continue
        left = quoted(f"__o_{name}") if name in table.columns else F.lit(None)
        right = quoted(f"__n_{name}") if name in fresh else F.lit(None)
        kind = (table.df.schema if name in table.columns else new.schema)[name].dataType
        left, right = (_comparable(left, kind), _comparable(right, kind))
        differs = differs | ~left.eqNullSafe(right)
    event = (
        F.when(F.col("__old").isNull(), F.lit("INSERT"))
        .when(F.col("__now").isNull(), F.lit("REMOVE"))
        .when(differs, F.lit("MODIFY"))
    )
    rows = joined.withColumn("event_name", event)
    if not unchanged:
        rows = rows.where(F.col("event_name").isNotNull())
    key_struct = F.struct(*[F.coalesce(quoted(f"__n_{k}"), quoted(f"__o_{k}")).alias(k) for k in keys])
    return rows.select(
        F.lit(table.name).alias("table"),
        "event_name",
        F.to_json(key_struct).alias("keys"),
        F.when(F.col("__old").isNotNull(), item_json(rows, table.columns, nulls="absent", prefix="__o_")).alias("old_image"),
        F.when(F.col("__now").isNotNull(), item_json(rows, fresh, nulls="absent", prefix="__n_")).alias("new_image"),
    )


def _holds_uncomparable(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _holds_uncomparable(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_holds_uncomparable(f.dataType) for f in kind.fields)
    return isinstance(kind, (T.VariantType, T.MapType))


def _comparable(col, kind: T.DataType):
    """The value in a form that Spark compares, at every level: maps as sorted entries, documents as text."""
    if not _holds_uncomparable(kind):
        return col
    if isinstance(kind, T.VariantType):
        return F.to_json(col)
    if isinstance(kind, T.ArrayType):
        return F.transform(col, lambda x: _comparable(x, kind.elementType))
    if isinstance(kind, T.MapType):
        entries = F.transform(
            F.map_entries(col),
            lambda e: F.struct(e["key"].alias("key"), _comparable(e["value"], kind.valueType).alias("value")),
        )
        return F.array_sort(entries)
    fields = [_comparable(col.getField(f.name), f.dataType).alias(f.name) for f in kind.fields]
    return F.when(col.isNotNull(), F.struct(*fields))


def stream_enabled(changes: DataFrame, config: DataFrame) -> DataFrame:
    """Change rows of the tables whose config row (``tableName, enabledStream``) has the flag ``1``.

    The config has one row per table, so its names are read first: as a plain filter they keep the feeds of
    other tables from being worked out at all.
    """
    enabled = config.where(F.trim(F.col("enabledStream").cast("string")) == "1")
    names = sorted(r["tableName"] for r in enabled.select("tableName").distinct().collect())
    return changes.where(F.col("table").isin(names))


def sequenced(feed: DataFrame, version: int, at_millis: int, first: int = 1, ranges: int = 256) -> DataFrame:
    """Change records with ``sequence``, ``event_id``, ``version`` and ``created_at``.

    ``sequence`` counts the records of all tables from ``first`` without a gap, by table and by the digest of their keys: the same
    records always get the same numbers. Counts per range of the digest are summed up first, so only the records of one of the
    ``ranges`` (a power of two) are sorted together. ``event_id`` is a digest of table, version, event and keys, ``created_at`` the
    time of the version in milliseconds.
    """
    digest = F.md5(F.concat_ws("\x1f", "table", "keys"))
    bits = (ranges - 1).bit_length()
    at = F.shiftright(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), 32 - bits)
    marked = feed.withColumn("__digest", digest).withColumn("__range", at)
    counts = marked.groupBy("table", "__range").agg(F.count(F.lit(1)).alias("__n"))
    # at most a row per table and range
    before = Window.orderBy("table", "__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col("table").alias("__t"), F.col("__range").alias("__r"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before")
    )
    place = F.row_number().over(Window.partitionBy("table", "__range").orderBy("__digest", "keys"))
    numbered = marked.withColumn("__place", place).join(offsets, (F.col("table") == F.col("__t")) & (F.col("__range") == F.col("__r")))
    event = F.md5(F.concat_ws("\x1f", "table", F.lit(str(version)), "event_name", "keys"))
    return numbered.select(
        *[quoted(c) for c in feed.columns],
        (F.col("__before") + F.col("__place") + F.lit(first - 1)).cast("long").alias("sequence"),
        event.alias("event_id"),
        F.lit(version).cast("long").alias("version"),
        F.lit(at_millis).cast("long").alias("created_at"),
    )


def changes_between(store: SnapshotStore, table: str, old: int, new: int, first: int = 1) -> DataFrame:
    """Numbered change records of a bucketed table between two of its versions; buckets that are the same files are not opened."""
    buckets = store.changed_buckets(table, old, new)
    before, after = (store.item_table(table, version, buckets) for version in (old, new))
    return sequenced(change_feed(before, after.df), new, int(store.manifest(new).get("time", 0)), first)
