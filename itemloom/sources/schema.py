"""Schemas of items: inferred from data, recorded as metadata rows, compared, applied."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import TableNotFound, ValidationError
from ..functions.tagged import DESCRIPTORS
from ..functions.types import STORED_TYPES, descriptor_of, spark_type, stored_type
from ..table import Catalog, Index, ItemTable, clean_name, quoted

# Columns of the metadata rows, in their order. A metadata table that names them otherwise
# is read and written with a map from these names to its own (``columns``).
METADATA_COLUMNS = (
    "column",
    "tableName",
    "dataType",
    "originalColumn",
    "partitionKey",
    "sortKey",
    "indexName",
    "actualTable",
    "storedType",
)
# Fixed value: characters that a stored column name cannot have.
SPECIAL_CHARACTERS = r"[\]\^\\/\[.()\-]"


def sanitized(name: str) -> str:
    return re.sub(SPECIAL_CHARACTERS, "_", name)


def infer_item_schema(items: DataFrame, col: str = "item", sample_n: int | None = None) -> DataFrame:
    """One row per attribute of tagged item texts: ``attribute, descriptor, conflicts, items``.

    The descriptor seen most often wins (null markers count only if there is nothing else);
    ``conflicts`` lists all others. All items are looked at unless ``sample_n`` asks for a sample.
    """
    sample = items.select(quoted(col).alias("item"))
    if sample_n is not None:
        sample = sample.limit(sample_n)
    # every tag as raw text: the descriptor is the one that is there
    tags = T.StructType([T.StructField(d, T.StringType()) for d in DESCRIPTORS])
    parsed = F.from_json("item", T.MapType(T.StringType(), tags))
    attributes = sample.select(F.explode(parsed).alias("attribute", "tag"))
    descriptor = F.coalesce(*[F.when(F.col("tag").getField(d).isNotNull(), F.lit(d)) for d in DESCRIPTORS], F.lit("S"))
    counted = attributes.groupBy("attribute", descriptor.alias("descriptor")).agg(F.count(F.lit(1)).alias("n"))
    weight = F.struct((F.col("descriptor") != "NULL").alias("typed"), F.col("n"), F.col("descriptor"))
    best = counted.groupBy("attribute").agg(
        F.max_by("descriptor", weight).alias("descriptor"),
        F.array_sort(F.collect_list("descriptor")).alias("seen"),
        F.sum("n").alias("items"),
    )
    return best.select(
        "attribute",
        "descriptor",
        F.array_except("seen", F.array("descriptor", F.lit("NULL"))).alias("conflicts"),
        "items",
    )


def _stored_type_column(descriptor):
    chain = F.lit(stored_type(""))
    for name, stored in STORED_TYPES.items():
        chain = F.when(descriptor == name, F.lit(stored)).otherwise(chain)
    return chain


def schema_metadata(
    schema: DataFrame,
    table: str,
    partition_key: str,
    sort_key: str | None = None,
    index: str = "",
    actual_table: str | None = None,
    columns: Mapping[str, str] | None = None,
) -> DataFrame:
    """Metadata rows of an inferred schema (``attribute, descriptor``), one per column."""
    stored_name = F.regexp_replace("attribute", SPECIAL_CHARACTERS, "_")
    rows = schema.select(
        stored_name.alias("column"),
        F.lit(table).alias("tableName"),
        F.col("descriptor").alias("dataType"),
        F.col("attribute").alias("originalColumn"),
        F.lit(partition_key).alias("partitionKey"),
        F.lit(sort_key or "").alias("sortKey"),
        F.lit(index).alias("indexName"),
        F.lit(actual_table or table).alias("actualTable"),
        _stored_type_column(F.col("descriptor")).alias("storedType"),
    )
    return rows.withColumnsRenamed(dict(columns or {}))


def declared_schema(df: DataFrame) -> DataFrame:
    """``attribute, descriptor`` rows of a DataFrame's own columns."""
    rows = [(f.name, descriptor_of(f.dataType)) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "attribute string, descriptor string")


def table_metadata(table: ItemTable) -> DataFrame:
    """Metadata rows of a table as it is declared."""
    return schema_metadata(
        declared_schema(table.df), table.name, table.partition_key, table.sort_key, index=",".join(table.indexes)
    )


def index_metadata(table: ItemTable) -> DataFrame | None:
    """Metadata rows of the indexes of a table, None without any: each is named as a table of its own over the actual one."""
    parts = []
    for name, index in table.indexes.items():
        carried = declared_schema(table.index(name).df)
        parts.append(schema_metadata(carried, name, index.partition_key, index.sort_key, index=name, actual_table=table.name))
    return reduce(DataFrame.unionByName, parts) if parts else None


def struct_from_metadata(rows: DataFrame) -> T.StructType:
    """Spark schema of metadata rows (one row per column of one table)."""
    pairs = sorted((r["column"], r["dataType"]) for r in rows.select("column", "dataType").collect())
    return T.StructType([T.StructField(name, spark_type(descriptor)) for name, descriptor in pairs])


def register_from_metadata(
    catalog: Catalog,
    metadata: DataFrame,
    frames: Mapping[str, DataFrame],
    columns: Mapping[str, str] | None = None,
) -> list[str]:
    """Register the tables that metadata rows describe (one row per column), over the given frames.

    Columns are read under their original names, cast by descriptor and kept under their stored names. A name over an actual table
    of another name is an index of that one where its rows call it so (``indexName`` is that name too), with their keys and columns;
    else it is an alias. An index that only the rows of its table name has the table's own keys. Returns the registered names.
    """
    metadata = metadata.withColumnsRenamed({theirs: ours for ours, theirs in (columns or {}).items()})
    described: dict[str, list] = {}
    for row in metadata.select(*METADATA_COLUMNS).distinct().collect():
        described.setdefault(row["tableName"], []).append(row)
    aliases, indexes = [], {}
    for name, rows in described.items():
        first = rows[0]
        actual = clean_name(first["actualTable"] or name)
        if actual != clean_name(name) and first["indexName"] == name:
            indexes.setdefault(actual, {})[name] = rows
    for name, rows in sorted(described.items()):
        first = rows[0]
        actual = clean_name(first["actualTable"] or name)
        if name in indexes.get(actual, {}):
            continue
        if actual != clean_name(name):
            aliases.append((name, first["actualTable"]))
            continue
        if name not in frames:
            raise TableNotFound(name)
        df, by_origin = frames[name], {r["originalColumn"]: r for r in rows}
        unknown = [c for c in df.columns if c not in by_origin]
        if unknown:
            raise ValidationError(f"no metadata for columns {', '.join(unknown)} of {name!r}")
        columns = [
            quoted(c).cast(spark_type(by_origin[c]["dataType"])).alias(by_origin[c]["column"]) for c in df.columns
        ]
        named = [n for n in (first["indexName"] or "").split(",") if n]
        own = {n: Index(first["partitionKey"], first["sortKey"] or None) for n in named}
        own |= {n: _index_of(found, by_origin) for n, found in indexes.get(clean_name(name), {}).items()}
        catalog.register_table(name, df.select(*columns), first["partitionKey"], first["sortKey"] or None, own)
    for name, actual in aliases:
        catalog.register_table(name, alias_of=actual)
    return sorted(described)


def _index_of(rows: Sequence, columns: Mapping) -> Index:
    """The index that metadata rows describe; one that carries all columns of its table narrows nothing."""
    carried = {r["column"] for r in rows}
    keys = (rows[0]["partitionKey"], rows[0]["sortKey"] or None)
    whole = carried >= {r["column"] for r in columns.values()}
    return Index(*keys, include=None if whole else tuple(sorted(carried - set(keys))))


def schema_diff(declared: DataFrame, actual: DataFrame, keep: Sequence[str] = ("commit_timestamp",)) -> DataFrame:
    """``attribute, descriptor, change``: ``add`` what items have and the table lacks, ``drop`` the reverse."""
    added = actual.join(declared, "attribute", "left_anti").select("attribute", "descriptor", F.lit("add").alias("change"))
    gone = (
        declared.where(~F.col("attribute").isin(*keep))
        .join(actual, "attribute", "left_anti")
        .select("attribute", "descriptor", F.lit("drop").alias("change"))
    )
    return added.unionByName(gone)


def evolve_schema(df: DataFrame, diff: DataFrame) -> DataFrame:
    """Apply a schema diff: added columns are null, dropped ones go. The diff has one row per attribute."""
    changes = sorted((r["change"], r["attribute"], r["descriptor"]) for r in diff.collect())
    dropped = {name for change, name, _ in changes if change == "drop"}
    added = [(name, descriptor) for change, name, descriptor in changes if change == "add" and name not in df.columns]
    kept = [quoted(c) for c in df.columns if c not in dropped]
    return df.select(*kept, *[F.lit(None).cast(spark_type(d)).alias(n) for n, d in added])


def sanitize_columns(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """Columns under stored names, with the map back to the original ones. Collisions are an error."""
    originals: dict[str, str] = {}
    for name in df.columns:
        stored = sanitized(name)
        if stored in originals:
            raise ValidationError(f"columns {originals[stored]!r} and {name!r} are both stored as {stored!r}")
        originals[stored] = name
    return df.select(*[quoted(n).alias(s) for s, n in originals.items()]), originals


def restore_columns(df: DataFrame, originals: Mapping[str, str]) -> DataFrame:
    return df.select(*[quoted(c).alias(originals.get(c, c)) for c in df.columns])
