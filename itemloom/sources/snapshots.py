"""Versioned table states in Parquet.

A commit writes every table to a directory of its own and then, as its last step, one small
manifest that names them. Readers follow the newest manifest, so they see all tables of a commit or none,
and a commit that dies half way leaves nothing visible behind.

A table may be laid out in buckets by a hash of its key: the manifest then names one directory per bucket, with its rows. A change
rewrites the buckets that its keys fall into and takes over the entries of the others; key lookups, counts and differences between
versions open what they need. Indexes of such a table are stored next to it, in buckets of the index's partition key, and follow its
changes in the same version. ``vacuum`` removes what no kept version names.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import TableNotFound, ValidationError
from ..functions.types import spark_type
from ..functions.updates import fitted
from ..table import Catalog, Index, ItemTable, quoted


State = DataFrame | ItemTable


def _writer(state: State) -> DataFrameWriter:
    """Parquet writer of a state. The files of a table are sorted by its key and carry a Bloom filter on the
    partition key, so that a keyed read skips most row groups; rows stay in the partitions they are in."""
    if isinstance(state, DataFrame):
        return state.write
    sorted_rows = state.df.sortWithinPartitions(*[quoted(k) for k in state.keys])
    return sorted_rows.write.option(f"parquet.bloom.filter.enabled#{state.partition_key}", "true")


def write_snapshot(state: State, path: str) -> None:
    """State under a path that must not exist yet."""
    _writer(state).mode("errorifexists").parquet(path)


#: column of a bucketed write that names the bucket; never part of an item
BUCKET = "_bucket"
#: column of a sorted write that names the range
RANGE = "_range"


@dataclass
class SnapshotStore:
    """Table states below ``root``, a folder every executor can reach. One writer at a time."""

    spark: SparkSession
    root: str
    _fs: Any = field(init=False, repr=False)

    def __post_init__(self) -> None:
        self._path = self.spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration())

    # -- manifests ----------------------------------------------------------------------------

    def _names(self, folder: str) -> list[str]:
        path = self._path(f"{self.root}/{folder}")
        return sorted(s.getPath().getName() for s in self._fs.listStatus(path)) if self._fs.exists(path) else []

    def versions(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in self._names("_manifests") if n.endswith(".json"))

    def manifest(self, version: int | None = None) -> dict[str, Any]:
        known = self.versions()
        if not known:
            return {"version": 0, "tables": {}, "notes": {}}
        version = known[-1] if version is None else version
        stream = self._fs.open(self._path(f"{self.root}/_manifests/{version:09d}.json"))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)

    def _publish(self, manifest: dict[str, Any]) -> None:
        version = manifest["version"]
        final = self._path(f"{self.root}/_manifests/{version:09d}.json")
        draft = self._path(f"{self.root}/_manifests/.{version:09d}.draft")
        out = self._fs.create(draft, True)
        out.write(bytearray(json.dumps(manifest | {"time": int(time.time() * 1000)}).encode()))
        out.close()
        if self._fs.exists(final) or not self._fs.rename(draft, final):
            raise ValidationError(f"version {version} of {self.root} was committed by another writer")

    def _commit(self, tables: Mapping[str, Any], notes: Mapping[str, Any] | None) -> int:
        current = self.manifest()
        version = current["version"] + 1
        merged = {**current["notes"], **(notes or {})}
        every = {n: e for n, e in {**current["tables"], **tables}.items() if e is not None}
        self._publish({"version": version, "tables": every, "notes": merged})
        return version

    def note(self, notes: Mapping[str, Any]) -> int:
        """A version with other notes and the same tables."""
        return self._commit({}, notes)

    def _entry(self, table: str, version: int | None = None) -> str | dict[str, Any]:
        tables = self.manifest(version)["tables"]
        if table not in tables:
            raise TableNotFound(table)
        return tables[table]

    def _bucketed(self, table: str, version: int | None = None) -> dict[str, Any]:
        entry = self._entry(table, version)
        if isinstance(entry, str) or "buckets" not in entry:
            raise ValidationError(f"table {table!r} is not stored in buckets")
        return entry

    # -- states -------------------------------------------------------------------------------

    def commit(self, states: Mapping[str, State], notes: Mapping[str, Any] | None = None, buckets: int | None = None) -> int:
        """Write the new states of some tables together; the other tables keep theirs.

        With ``buckets``, and where the stored table has buckets already, an ``ItemTable`` is laid out by a hash of its key.
        """
        current = self.manifest()
        version = current["version"] + 1
        tables = {}
        for name, state in states.items():
            old = current["tables"].get(name)
            count = buckets or (old.get("buckets") if isinstance(old, dict) else None)
            # indexes that the new state does not bring along are gone
            tables |= {f"{name}.{index}": None for index in _stored_indexes(current["tables"], name)}
            if count and isinstance(state, ItemTable):
                tables[name] = self._laid_out(name, state.df, state.keys, state.keys, count, version)
                for index, how in self._indexes(state, current["tables"]).items():
                    rows = state.with_indexes({index: how}).index(index).df.where(quoted(how.partition_key).isNotNull())
                    entry = self._laid_out(f"{name}.{index}", rows, [how.partition_key], _order(how, state.keys), count, version)
                    tables[f"{name}.{index}"] = entry | {"index_of": name, "index": [how.partition_key, how.sort_key, how.include]}
                continue
            path = f"{name}/v={version:09d}"
            # what an earlier attempt at this version left behind was never visible
            _writer(state).mode("overwrite").parquet(f"{self.root}/{path}")
            tables[name] = path
        return self._commit(tables, notes)

    def read(self, table: str, version: int | None = None) -> DataFrame:
        entry = self._entry(table, version)
        if isinstance(entry, str):
            return self.spark.read.parquet(f"{self.root}/{entry}")
        return self._opened(entry, entry["parts"])

    # -- buckets ------------------------------------------------------------------------------

    def _opened(self, entry: Mapping[str, Any], buckets: Iterable[str | int]) -> DataFrame:
        schema, physical = T.StructType.fromJson(entry["schema"]), entry["physical"]
        paths = [f"{self.root}/{entry['parts'][str(b)]['path']}" for b in buckets if str(b) in entry["parts"]]
        if not paths:
            return self.spark.createDataFrame([], schema)
        stored = T.StructType([T.StructField(physical.get(f.name, f.name), f.dataType) for f in schema.fields])
        rows = self.spark.read.schema(stored).parquet(*paths)
        return rows if not physical else rows.select(*[quoted(physical.get(f.name, f.name)).alias(f.name) for f in schema.fields])

    def _laid_out(
        self,
        name: str,
        df: DataFrame,
        hashed: Sequence[str],
        order: Sequence[str],
        count: int,
        version: int,
        names: Mapping[str, Any] | None = None,
    ) -> dict[str, Any]:
        """Writes rows in buckets by a hash of some columns, sorted in each file, and gives the manifest entry of these buckets.

        Rows with a null in one of the columns are in the first bucket. A bucket that is large for one task is written by several.
        """
        path = f"{name}/v={version:09d}"
        bucket = F.coalesce(bucket_of([quoted(k) for k in hashed], count), F.lit(0))
        rows = df.withColumn(BUCKET, bucket).hint("rebalance", BUCKET)
        rows = rows.sortWithinPartitions(BUCKET, *[quoted(k) for k in order])
        # attributes go by the names that they have in files; a new one must not take the name of one that was dropped
        names = {k: (names or {}).get(k, []) for k in ("physical", "retired")}
        physical = dict(names["physical"] or {})
        for column in df.columns:
            if column in names["retired"] and column not in physical:
                physical[column] = _unused(column, names)
        rows = rows.withColumnsRenamed({c: p for c, p in physical.items() if c in df.columns})
        writer = rows.write.option(f"parquet.bloom.filter.enabled#{hashed[0]}", "true").partitionBy(BUCKET)
        writer.mode("overwrite").parquet(f"{self.root}/{path}")
        found: dict[str, Any] = {}
        if any(n.startswith(f"{BUCKET}=") for n in self._names(path)):
            # footers only: no column is read
            counts = self.spark.read.parquet(f"{self.root}/{path}").groupBy(BUCKET).agg(F.count(F.lit(1)).alias("n")).collect()
            found = {str(r[BUCKET]): {"path": f"{path}/{BUCKET}={r[BUCKET]}", "rows": r["n"]} for r in counts}
        entry = {"keys": list(order), "hashed": list(hashed), "order": list(order), "buckets": count}
        return entry | {"schema": df.schema.jsonValue(), "parts": found, "physical": physical, "retired": list(names["retired"])}

    def _indexes(self, state: ItemTable, tables: Mapping[str, Any]) -> dict[str, Index]:
        """The indexes to store with a table: its own, or those that are stored already."""
        return state.indexes or _stored_indexes(tables, state.name)

    def touched(self, table: str, keys: DataFrame, version: int | None = None) -> list[int]:
        """Buckets that the keys fall into: at most as many numbers as the table has buckets."""
        entry = self._bucketed(table, version)
        kinds = {f.name: f.dataType for f in T.StructType.fromJson(entry["schema"]).fields}
        typed = [fitted(quoted(k), keys.schema[k].dataType, kinds[k])[0] for k in entry["hashed"]]
        found = keys.select(bucket_of(typed, entry["buckets"]).alias(BUCKET)).where(F.col(BUCKET).isNotNull()).distinct()
        return sorted(r[BUCKET] for r in found.collect())

    def item_table(self, table: str, version: int | None = None, buckets: Iterable[int] | None = None) -> ItemTable:
        """A bucketed table, or those of its buckets."""
        entry = self._bucketed(table, version)
        keys = entry["keys"]
        df = self._opened(entry, entry["parts"] if buckets is None else buckets)
        return ItemTable(table, df, keys[0], keys[1] if len(keys) > 1 else None)

    def lookup(self, table: str, keys: DataFrame, version: int | None = None) -> ItemTable:
        """The buckets that may hold the keys, as a table for point reads and batch gets."""
        return self.item_table(table, version, self.touched(table, keys, version))

    def change(
        self, table: str, keys: DataFrame, change: Callable[[ItemTable], DataFrame], notes: Mapping[str, Any] | None = None
    ) -> int:
        """Commit a change of the items with these keys, and rewrite no bucket without one of them.

        ``change`` gets the table with the buckets of the keys and gives its new state; it may put, update or delete items of the keys
        and adds attributes only if it carries them for all of its items. Keys that no item of the table could have change nothing.
        """
        entry = self._bucketed(table)
        buckets = self.touched(table, keys)
        if not buckets:
            return self._commit({}, notes)
        manifest = self.manifest()
        version = manifest["version"] + 1
        part = self.item_table(table, buckets=buckets)
        state = part.with_df(change(part))
        new = self._replaced(table, entry, state.df, buckets, version)
        tables = {table: new}
        # of the rest the change is the items with these keys: they leave the index and come in again
        kinds = {f.name: f.dataType for f in part.df.schema.fields}
        asked = keys.select(*[fitted(quoted(k), keys.schema[k].dataType, kinds[k])[0].alias(k) for k in part.keys]).distinct()
        after = part.with_df(self._opened(new, buckets))
        for index, how in _stored_indexes(manifest["tables"], table).items():
            name = f"{table}.{index}"
            gone, come = (
                t.with_indexes({index: how}).index(index).df.join(asked, part.keys, "left_semi").where(quoted(how.partition_key).isNotNull())
                for t in (part, after)
            )
            met = gone.select(quoted(how.partition_key)).unionByName(come.select(quoted(how.partition_key)))
            places = self.touched(name, met)
            if places:
                old = manifest["tables"][name]
                rows = self._opened(old, places).join(asked, part.keys, "left_anti").unionByName(come, allowMissingColumns=True)
                tables[name] = self._replaced(name, old, rows, places, version) | {k: old[k] for k in ("index_of", "index")}
        return self._commit(tables, notes)

    def _replaced(self, name: str, entry: Mapping[str, Any], df: DataFrame, buckets: Sequence[int], version: int) -> dict[str, Any]:
        """The entry with some buckets written anew. Files without an attribute read it as null."""
        new = self._laid_out(name, df, entry["hashed"], entry["order"], entry["buckets"], version, entry)
        if any(int(b) not in buckets for b in new["parts"]):
            raise ValidationError(f"the change of {name!r} reaches items of other keys")
        kept = {b: p for b, p in entry["parts"].items() if int(b) not in buckets}
        return new | {"parts": kept | new["parts"]}

    def index_table(self, table: str, index: str, keys: DataFrame | None = None, version: int | None = None) -> ItemTable:
        """The items as a stored index has them, addressed by its key pair; with ``keys`` (its partition keys) only their buckets."""
        name = f"{table}.{index}"
        entry = self._bucketed(name, version)
        partition_key, sort_key, _ = entry["index"]
        buckets = entry["parts"] if keys is None else self.touched(name, keys, version)
        return ItemTable(table, self._opened(entry, buckets), partition_key, sort_key, base_keys=tuple(self._bucketed(table, version)["keys"]))

    def count(self, table: str, version: int | None = None) -> int:
        """Items of a table; of a bucketed one the manifest knows it."""
        entry = self._entry(table, version)
        return self.read(table, version).count() if isinstance(entry, str) else sum(p["rows"] for p in entry["parts"].values())

    def changed_buckets(self, table: str, old: int, new: int) -> list[int]:
        """Buckets that are not the same files in two versions of a table with one layout."""
        before, after = self._bucketed(table, old), self._bucketed(table, new)
        if before["buckets"] != after["buckets"] or before["keys"] != after["keys"]:
            raise ValidationError(f"table {table!r} was laid out anew between versions {old} and {new}")
        either = before["parts"].keys() | after["parts"].keys()
        return sorted(int(b) for b in either if before["parts"].get(b, {}).get("path") != after["parts"].get(b, {}).get("path"))

    # -- order --------------------------------------------------------------------------------

    def commit_sorted(self, state: ItemTable, order: Sequence[str], ranges: int, name: str | None = None) -> int:
        """Write a table's items ranged by some columns, then by their key, with the number of rows of each range in the manifest.

        Nulls come first. Pages of it are cut out by their numbers (``sorted_page``). A later commit of the name replaces it whole.
        """
        name, version = name or state.name, self.manifest()["version"] + 1
        path, by = f"{name}/v={version:09d}", list(dict.fromkeys([*order, *state.keys]))
        rows = state.df.repartitionByRange(ranges, *[quoted(c) for c in by]).sortWithinPartitions(*[quoted(c) for c in by])
        rows.withColumn(RANGE, F.spark_partition_id()).write.partitionBy(RANGE).mode("overwrite").parquet(f"{self.root}/{path}")
        parts = []
        if any(n.startswith(f"{RANGE}=") for n in self._names(path)):
            counts = self.spark.read.parquet(f"{self.root}/{path}").groupBy(RANGE).agg(F.count(F.lit(1)).alias("n")).collect()
            parts = [{"path": f"{path}/{RANGE}={r[RANGE]}", "rows": r["n"]} for r in sorted(counts, key=lambda r: r[RANGE])]
        entry = {"keys": state.keys, "order": by, "schema": state.df.schema.jsonValue(), "physical": {}}
        return self._commit({name: entry | {"parts": {str(k): p for k, p in enumerate(parts)}}}, None)

    def sorted_page(self, table: str, offset: int, limit: int, ascending: bool = True, version: int | None = None) -> DataFrame:
        """Rows ``offset`` to ``offset + limit`` of a table written by ``commit_sorted``, in its order; only ranges with some of them are opened."""
        entry = self._entry(table, version)
        if isinstance(entry, str) or "buckets" in entry:
            raise ValidationError(f"table {table!r} is not stored in an order")
        if offset < 0 or limit < 0:
            raise ValidationError("offset and limit are not negative")
        total = sum(p["rows"] for p in entry["parts"].values())
        low, high = offset, min(offset + limit, total)
        if not ascending:
            low, high = max(total - offset - limit, 0), max(total - offset, 0)
        chosen, before, skip = [], 0, 0
        for k in range(len(entry["parts"])):
            rows = entry["parts"][str(k)]["rows"]
            if before < high and before + rows > low:
                skip = before if not chosen else skip
                chosen.append(k)
            before += rows
        inside = self._opened(entry, chosen)
        cut = inside.orderBy(*[quoted(c) for c in entry["order"]]).offset(max(low - skip, 0)).limit(max(high - low, 0))
        return cut if ascending else cut.orderBy(*[quoted(c).desc() for c in entry["order"]])

    # -- schemas ------------------------------------------------------------------------------

    def evolve(self, table: str, diff: DataFrame, notes: Mapping[str, Any] | None = None) -> int:
        """Apply a schema diff to a bucketed table: a new manifest entry, and no file is written.

        Added attributes are null for the items there are. A dropped one is gone also when another of its name is added later: that
        one has a name of its own in files.
        """
        changes = sorted((r["change"], r["attribute"], r["descriptor"]) for r in diff.collect())
        tables = self.manifest()["tables"]
        found = {table: _evolved(self._bucketed(table), changes)}
        for index in _stored_indexes(tables, table):
            name = f"{table}.{index}"
            narrow = [c for c in changes if c[0] == "drop" or tables[name]["index"][2] is None]
            found[name] = _evolved(tables[name], narrow)
        return self._commit(found, notes)

    # -- versions -----------------------------------------------------------------------------

    def version_at(self, millis: int) -> int:
        """The newest version that was committed at or before a time in milliseconds."""
        found = [v for v in self.versions() if self.manifest(v).get("time", 0) <= millis]
        if not found:
            raise ValidationError(f"{self.root} has no version as old as {millis}")
        return found[-1]

    def catalog(self, version: int | None = None, keys: Mapping[str, Sequence[str]] | None = None) -> Catalog:
        """All tables of one version, whatever is committed later. ``keys`` names those of tables that are not stored in buckets."""
        manifest = self.manifest(version)
        found = Catalog(self.spark)
        for name, entry in manifest["tables"].items():
            own = (keys or {}).get(name) if isinstance(entry, str) else entry["keys"]
            if own and "index_of" not in entry:
                indexes = _stored_indexes(manifest["tables"], name)
                found.register_table(name, self.read(name, manifest["version"]), own[0], own[1] if len(own) > 1 else None, indexes)
        return found

    # -- room ---------------------------------------------------------------------------------

    def vacuum(self, keep: int = 1) -> list[str]:
        """Remove the data of tables that none of the last ``keep`` versions names, and the manifests before those.

        Readers of older versions have to be done. Gives the removed directories.
        """
        if keep < 1:
            raise ValidationError("at least the newest version is kept")
        known = self.versions()
        named: dict[str, set[str]] = {}
        for version in known[-keep:]:
            for name, entry in self.manifest(version)["tables"].items():
                paths = [entry] if isinstance(entry, str) else [p["path"] for p in entry["parts"].values()]
                named.setdefault(name, set()).update(paths)
        removed = []
        for name, paths in named.items():
            for found in self._names(name):
                if not found.startswith("v=") or f"{name}/{found}" in paths:
                    continue
                inside = [f"{name}/{found}/{n}" for n in self._names(f"{name}/{found}") if n.startswith((f"{BUCKET}=", f"{RANGE}="))]
                gone = [p for p in inside if p not in paths]
                removed += [f"{name}/{found}"] if len(gone) == len(inside) else gone
        for path in removed:
            self._remove(path)
        for version in known[:-keep]:
            self._remove(f"_manifests/{version:09d}.json")
        return removed

    def _remove(self, path: str) -> None:
        self._fs.delete(self._path(f"{self.root}/{path}"), True)


def _order(index: Index, keys: Sequence[str]) -> list[str]:
    """Columns that an index is sorted by."""
    return list(dict.fromkeys(k for k in (index.partition_key, index.sort_key, *keys) if k))


def _stored_indexes(tables: Mapping[str, Any], table: str) -> dict[str, Index]:
    found = {}
    for name, entry in tables.items():
        if isinstance(entry, dict) and entry.get("index_of") == table:
            partition_key, sort_key, include = entry["index"]
            found[name.removeprefix(f"{table}.")] = Index(partition_key, sort_key, None if include is None else tuple(include))
    return found


def _evolved(entry: Mapping[str, Any], changes: Sequence[tuple[str, str, str]]) -> dict[str, Any]:
    """A manifest entry after attributes were dropped and added."""
    fields = list(T.StructType.fromJson(entry["schema"]).fields)
    names = {"physical": dict(entry["physical"]), "retired": list(entry["retired"])}
    for change, name, _ in changes:
        if change == "drop" and name in [f.name for f in fields]:
            if name in (*entry["hashed"], *entry["order"]):
                raise ValidationError(f"key attribute {name!r} cannot be dropped")
            fields = [f for f in fields if f.name != name]
            names["retired"].append(names["physical"].pop(name, name))
    for change, name, descriptor in changes:
        if change == "add" and name not in [f.name for f in fields]:
            fields.append(T.StructField(name, spark_type(descriptor)))
            if name in names["retired"]:
                names["physical"][name] = _unused(name, names)
    return {**entry, **names, "schema": T.StructType(fields).jsonValue()}


def _unused(name: str, names: Mapping[str, Any]) -> str:
    """A name for files that no attribute has or had."""
    taken = {*names["retired"], *names["physical"].values()}
    return next(n for k in range(2, len(taken) + 3) if (n := f"{name}__{k}") not in taken)


def bucket_of(keys: Iterable[Column], count: int) -> Column:
    """Bucket of a key in its stored types; null for a key with a null in it."""
    keys = list(keys)
    whole = keys[0].isNotNull()
    for k in keys[1:]:
        whole = whole & k.isNotNull()
    return F.when(whole, F.pmod(F.xxhash64(*keys), F.lit(count))).cast("int")
