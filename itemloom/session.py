"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from .errors import ItemTableError

CHECKPOINT_DIR = "spark.checkpoint.dir"

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a page far into a table is sorted by the cluster, not held by one task
    "spark.sql.execution.topKSortFallbackThreshold": "100000",
}


#: folders of the scopes that are open, innermost last
_scopes: list[str] = []


def build_session(master: str | None = None, app_name: str = "itemloom", scratch: str | None = None, **conf: str) -> SparkSession:
    """Session with the defaults above; cluster sizing stays with the caller's own settings. ``scratch`` is the shared folder."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if scratch:
        conf = {CHECKPOINT_DIR: scratch, **conf}
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str, root: str | None = None) -> str:
    """A new path below ``root``, or else below the shared folder named by ``spark.checkpoint.dir``.

    A machine-local folder is taken only by a local master with the setting unset, which then names it.
    """
    root = root or (_scopes[-1] if _scopes else _shared(spark))
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def _shared(spark: SparkSession) -> str:
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ItemTableError(f"{CHECKPOINT_DIR} must name a folder that every executor can reach")
    root = tempfile.mkdtemp(prefix="itemloom-")
    spark.conf.set(CHECKPOINT_DIR, root)
    return root


@contextmanager
def scratch(spark: SparkSession, root: str | None = None) -> Iterator[str]:
    """A folder for the scratch data of all work inside; it is removed at the end. Results that are needed later are written elsewhere."""
    folder = scratch_dir(spark, "scope", root)
    _scopes.append(folder)
    try:
        yield folder
    finally:
        _scopes.remove(folder)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
