"""Write requests that arrive as a stream.

Every micro-batch is folded to one row per key and kept as a change set named by the run of the stream and
its batch id, so its cost follows the size of the batch and not that of the table, and a re-delivered batch
replaces its own change set. A stream that starts anew, with a new checkpoint, is a new run. The current state is the last compacted one with the later change sets folded in.

Change sets are merged in levels: as many as ``fan`` of one level become one of the next, without a look at the table. So a row is
merged once a level, and a read opens fewer than ``fan`` sets a level and run. Compaction folds all of them into the table, of a
bucketed one into the buckets they touch.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..errors import VALIDATION, ValidationError
from ..functions.codec import PRESENT
from ..operators.write import BAD, PUTS, RESET, apply_requests, as_requests, fold_requests, typed_requests
from ..sources.snapshots import SnapshotStore
from ..table import ItemTable, quoted


#: run of change sets that are appended by hand
DIRECT = "direct"


@dataclass
class MutationLog:
    """A stored table plus the change sets that came after its last compaction.

    A change set belongs to a run (one checkpoint of a stream) and to a batch of it. Runs are numbered in the order in which they
    first append something; all change sets together are ordered by run and then by batch.
    """

    store: SnapshotStore
    table: str
    keys: Sequence[str]
    #: change sets of a level that become one of the next
    fan: int = 8

    @property
    def _changes(self) -> str:
        return f"{self.table}/changes"

    @property
    def _note(self) -> str:
        return f"{self.table}.batches"

    @property
    def _merged_note(self) -> str:
        return f"{self.table}.merged"

    @property
    def _stale_note(self) -> str:
        return f"{self.table}.stale"

    def _notes(self) -> dict:
        return self.store.manifest()["notes"]

    def _compacted(self) -> dict[str, int]:
        return dict(self._notes().get(self._note, {}))

    def _runs(self) -> list[str]:
        """Numbered names of the runs, oldest first. A run keeps its folder, also without change sets."""
        return [n.removeprefix("run=") for n in self.store._names(self._changes) if n.startswith("run=")]

    def _numbered(self, run: str) -> str:
        known = self._runs()
        return next((n for n in known if n.split("-", 1)[1] == run), f"{len(known):06d}-{run}")

    def sets(self) -> dict[str, list[dict]]:
        """Change sets that a read opens, by run and in order: ``level``, the batches ``first`` to ``last``, and ``path``."""
        notes = self._notes()
        done, merged = notes.get(self._note, {}), notes.get(self._merged_note, {})
        found = {}
        for run in self._runs():
            own = [m for m in merged.get(run, []) if m["last"] > done.get(run, -1)]
            last = max([m["last"] for m in own], default=done.get(run, -1))
            batches = sorted(int(n.removeprefix("batch=")) for n in self.store._names(f"{self._changes}/run={run}") if n.startswith("batch="))
            later = [{"level": 0, "first": b, "last": b, "path": f"{self._changes}/run={run}/batch={b}"} for b in batches if b > last]
            # one that was given up half way has no mark of its end
            found[run] = own + [m for m in later if "_SUCCESS" in self.store._names(m["path"])]
        return found

    def compacted_batch(self, run: str = DIRECT) -> int:
        """Id of the last batch of a run that the compacted state holds."""
        return int(self._compacted().get(self._numbered(run), -1))

    def base(self) -> ItemTable:
        keys = list(self.keys)
        return ItemTable(self.table, self.store.read(self.table), keys[0], keys[1] if len(keys) > 1 else None)

    @property
    def bucketed(self) -> bool:
        entry = self.store._entry(self.table)
        return isinstance(entry, dict) and "buckets" in entry

    def _wide(self, table: ItemTable, pending: DataFrame | None) -> ItemTable:
        """A table with the attributes that change sets have added since."""
        df = table.df
        for field in pending.schema.fields if pending is not None else ():
            if field.name not in (*df.columns, *_MARKS):
                df = df.withColumn(field.name, F.lit(None).cast(field.dataType))
        return table.with_df(df)

    def _widened(self) -> ItemTable:
        return self._wide(self.base(), self._pending())

    def append(self, batch: DataFrame, batch_id: int, op: str = "op", seq: str = "seq", run: str = DIRECT) -> None:
        """Fold one batch and keep it. Requests that fit nothing go to ``unprocessed`` of the batch.

        An attribute that the table does not have yet becomes one of its attributes, as in a put.
        """
        name = self._numbered(run)
        if batch_id <= self._compacted().get(name, -1):
            return
        for entry in self._notes().get(self._merged_note, {}).get(name, []):
            if batch_id in entry["left_out"]:
                raise ValidationError(f"batch {batch_id} comes after batch {entry['last']} was merged")
            if entry["first"] <= batch_id <= entry["last"]:
                return
        table = self._widened()
        attributes = [c for c in batch.columns if c not in (*self.keys, op, seq, PRESENT)]
        typed = typed_requests(table, batch, [*self.keys, *attributes])
        fit = table.has_key & F.coalesce(F.lower(quoted(op)).isin("put", "delete"), F.lit(False)) & ~F.col(BAD)
        rows = as_requests(typed.where(fit), list(self.keys), op, seq, attributes)
        folded = fold_requests(rows, list(self.keys), attributes)
        bad = typed.where(~fit).select(*[quoted(k) for k in self.keys], quoted(op), F.lit(VALIDATION).alias("code"))
        # the change set comes last: a batch that has one is complete
        bad.write.mode("overwrite").parquet(f"{self.store.root}/{self.table}/unprocessed/run={name}/batch={batch_id}")
        self._kept(folded, name, batch_id, f"{self._changes}/run={name}/batch={batch_id}")
        self._merge(name)

    def _kept(self, folded: DataFrame, run: str, batch: int, path: str) -> None:
        rows = folded.drop("_at").withColumn("run", F.lit(run)).withColumn("batch", F.lit(batch).cast("long"))
        rows.write.mode("overwrite").parquet(f"{self.store.root}/{path}")

    def _opened(self, paths: Sequence[str]) -> DataFrame:
        """Change sets by their paths; one of other columns carries nothing of the rest."""
        rows = self.store.spark.read.option("mergeSchema", True).parquet(*[f"{self.store.root}/{p}" for p in paths])
        return rows.withColumn(PRESENT, F.coalesce(F.col(PRESENT), F.array().cast("array<string>")))

    def _merge(self, run: str) -> None:
        """Merges change sets of a run while a level has ``fan`` of them.

        Each merge is one version of the manifest. What it replaces is removed at the next one, so that readers that have planned
        before can finish.
        """
        while True:
            own = self.sets()[run]
            level = next((x for x in range(1 + max((m["level"] for m in own), default=0)) if sum(m["level"] == x for m in own) >= self.fan), None)
            if level is None:
                return
            # neighbours: sets of a level stand together, the higher ones first
            at = next(k for k, m in enumerate(own) if m["level"] == level)
            part = own[at : at + self.fan]
            rows = self._opened([m["path"] for m in part])
            attributes = [c for c in rows.columns if c not in (*self.keys, *_MARKS)]
            folded = fold_requests(rows.withColumnRenamed("batch", "_at").drop("run"), list(self.keys), attributes)
            first, last = (own[at - 1]["last"] + 1 if at else self._compacted().get(run, -1) + 1), part[-1]["last"]
            held = {m["first"] for m in part if not m["level"]}
            left_out = sum((m["left_out"] for m in part if m["level"]), []) if level else [b for b in range(first, last) if b not in held]
            path = f"{self._changes}/run={run}/merged={level + 1}-{first}-{last}"
            self._kept(folded, run, last, path)
            notes = self._notes()
            merged = {**notes.get(self._merged_note, {})}
            entry = {"level": level + 1, "first": first, "last": last, "left_out": left_out, "path": path}
            kept = [m for m in own[:at] if m["level"]] + [entry] + [m for m in own[at + self.fan :] if m["level"]]
            merged[run] = kept
            self._swept({self._merged_note: merged}, [m["path"] for m in part])

    def _swept(self, notes: dict, stale: list[str]) -> None:
        """A version with these notes; sets that were stale before are removed, ``stale`` ones will be next time."""
        before = self._stale()
        self.store.note(notes | {self._stale_note: stale})
        self._drop(before)

    def _stale(self) -> list[str]:
        return self._notes().get(self._stale_note, [])

    def _drop(self, paths: list[str]) -> None:
        for path in paths:
            self.store._remove(path)

    def _pending(self) -> DataFrame | None:
        paths = [m["path"] for own in self.sets().values() for m in own]
        return self._opened(paths) if paths else None

    def _folded(self) -> DataFrame:
        """All change sets as one row per key; a folded row stands for its batch, so across sets run and batch are the order."""
        pending = self._pending()
        order = F.struct(F.col("run").cast("string").alias("run"), F.col("batch").cast("long").alias("batch"))
        attributes = [c for c in pending.columns if c not in (*self.keys, *_MARKS)]
        return fold_requests(pending.withColumn("_at", order), list(self.keys), attributes)

    def state(self) -> DataFrame:
        """Current items. Buckets that no change set touches are read as they are."""
        if not any(self.sets().values()):
            return self.base().df
        folded = self._folded()
        if not self.bucketed:
            return apply_requests(self._wide(self.base(), folded), folded)
        entry = self.store._bucketed(self.table)
        touched = self.store.touched(self.table, folded)
        others = [b for b in map(int, entry["parts"]) if b not in touched]
        changed = apply_requests(self._wide(self.store.item_table(self.table, buckets=touched), folded), folded)
        if not others:
            return changed
        rest = self._wide(self.store.item_table(self.table, buckets=others), folded).df
        return rest.select(*changed.columns).unionByName(changed)

    def unprocessed(self) -> DataFrame | None:
        path = f"{self.store.root}/{self.table}/unprocessed"
        if not self.store._fs.exists(self.store._path(path)):
            return None
        return self.store.spark.read.option("basePath", path).option("mergeSchema", True).parquet(path)

    def compact(self) -> int:
        """Fold the change sets so far into the stored table; of a bucketed one only the buckets they touch are written."""
        sets = self.sets()
        last = {run: own[-1]["last"] for run, own in sets.items() if own}
        if not last:
            return self.store.manifest()["version"]
        gone, before = [m["path"] for own in sets.values() for m in own], self._stale()
        notes = {self._note: self._compacted() | last, self._merged_note: {}, self._stale_note: gone}
        if self.bucketed:
            pending = self._folded()
            version = self.store.change(self.table, pending, lambda part: apply_requests(self._wide(part, pending), pending), notes)
        else:
            version = self.store.commit({self.table: self.base().with_df(self.state())}, notes=notes)
        self._drop(before)
        return version


#: columns of a change set that are not attributes
_MARKS = ("run", "batch", "_at", PRESENT, RESET, PUTS)


def _run_of(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark keeps in a checkpoint: the same as long as the checkpoint lives, another for every new one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint.rstrip('/')}/metadata")
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).open(path)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))["id"]
    finally:
        stream.close()


def apply_mutation_stream(
    stream: DataFrame,
    log: MutationLog,
    checkpoint: str,
    op: str = "op",
    seq: str = "seq",
    compact_every: int | None = None,
) -> DataStreamWriter:
    """Writer of a stream of put / delete requests into ``log``; the caller sets the trigger and starts it.

    A column ``_present`` names the attributes a put carries (all, without it); ``seq`` orders the requests
    of one key. ``compact_every`` batches the change sets are merged into a new snapshot.
    """

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            log.append(batch, batch_id, op, seq, run=_run_of(log.store.spark, checkpoint))
        finally:
            batch.unpersist()
        if compact_every and (batch_id + 1) % compact_every == 0:
            log.compact()

    return stream.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint)
