"""Size checks that pick the shape of a plan."""

from __future__ import annotations

from pyspark.sql import DataFrame


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark's own size estimate lets it broadcast ``df``; no hint is given to Spark.

    Only the shape of the plan hangs on this, never its result: past the limit the same
    join runs shuffled.
    """
    try:
        size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
        return int(str(size)) <= int(limit)
    except AttributeError:  # a remote session shows no plan
        return False


def single_source(df: DataFrame) -> bool:
    """Whether ``df`` reads one source only, so that reading it twice costs two scans and no more."""
    try:
        return df._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 1
    except AttributeError:
        return False


def requests_travel(items: DataFrame, requests: DataFrame) -> bool:
    """Whether a few requests are sent to many items, rather than both being shuffled by key."""
    return fits_broadcast(requests) and not fits_broadcast(items) and single_source(items)
