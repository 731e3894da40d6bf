"""What several operators share: batchwise columns, written intermediate tables, numbering without one big sort."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from ..session import scratch_dir

#: rows that one window of a numbering is meant to hold
ROWS_PER_BIN = 20_000
#: rows of a batch that Python holds as objects at once
SLICE = 256


def tables(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str | Column) -> Column:
    """The text, a null as the empty one."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def written(df: DataFrame, label: str = "llm") -> DataFrame:
    """The rows, written to the shared folder and read back: the lineage ends here and outlives lost executors."""
    path = scratch_dir(df.sparkSession, f"{label}-{uuid.uuid4().hex[:8]}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: the caller's columns, all of them, next to columns of an operator's own
ROW = "_row"


def carried(df: DataFrame, **own: Column) -> DataFrame:
    """The rows as one struct, so that no column of theirs can clash with an operator's own ones, which are given."""
    return df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias(ROW), *(c.alias(n) for n, c in own.items()))


def field(name: str) -> Column:
    """A column of carried rows."""
    return F.col(ROW).getField(name)


def restored(df: DataFrame, columns: Sequence[str], **changed: Column) -> DataFrame:
    """Carried rows with their columns as they were, but for the changed ones."""
    return df.select(*((changed[c] if c in changed else field(c)).alias(c) for c in columns))


def without(df: DataFrame, names: Sequence[str]) -> list[str]:
    """The columns of ``df`` that clash with none of ``names`` (letter case does not count, as in Spark)."""
    taken = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in taken]


def batchwise(
    df: DataFrame,
    inputs: Sequence[str],
    outputs: str,
    make: Callable[[], Callable[..., Sequence]],
    keep: Sequence[str] | None = None,
    only: str | None = None,
) -> DataFrame:
    """``keep`` (all columns by default) and the columns ``outputs``, computed from lists of ``inputs`` a slice at a time.

    ``make`` is called once per task and returns the function; it gives one list per output column. Columns of the
    same name are replaced. With ``only``, rows where that output is not true are left out, and so is that output.
    """
    made = T._parse_datatype_string(outputs)
    kept = [c for c in (without(df, made.names) if keep is None else keep) if c.lower() not in {n.lower() for n in made.names}]
    rest = [c for c in inputs if c not in kept]
    source = df.select(*(F.col(f"`{c}`") for c in [*kept, *rest]))
    shown = [f for f in made.fields if f.name != only]
    schema = T.StructType([*(source.schema[c] for c in kept), *shown])
    arrow = to_arrow_schema(schema)
    at, n_kept, names = [source.columns.index(c) for c in inputs], len(kept), made.names

    def run(batches):
        function = make()
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                results = dict(zip(names, function(*(part.column(i).to_pylist() for i in at)), strict=True))
                arrays = [part.column(i) for i in range(n_kept)]
                arrays += [pa.array(results[f.name], type=arrow.field(f.name).type, from_pandas=False) for f in shown]
                found = pa.RecordBatch.from_arrays(arrays, schema=_named(arrow, arrays))
                yield found if only is None else found.filter(pa.array(results[only], type=pa.bool_()))

    return source.mapInArrow(run, schema)


def _named(arrow: pa.Schema, arrays: list[pa.Array]) -> pa.Schema:
    return pa.schema([pa.field(f.name, a.type, True) for f, a in zip(arrow, arrays, strict=True)])


def bins_for(rows: int) -> int:
    """So many bins that one holds about as many rows as there are bins, but not fewer than ``ROWS_PER_BIN``."""
    return max(1, -(-rows // max(ROWS_PER_BIN, math.isqrt(rows))))


def bin_sums(df: DataFrame, group: Sequence[str], bin_: str, size: Column) -> DataFrame:
    """``_sum`` of each group and bin, and ``_before``: that of the bins of the group before it."""
    before = Window.partitionBy(*group).orderBy(bin_).rowsBetween(Window.unboundedPreceding, -1)
    sums = df.groupBy(*group, bin_).agg(F.sum(size).alias("_sum"))
    return sums.withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0)))


def running(df: DataFrame, sums: DataFrame, group: Sequence[str], bin_: str, order: Sequence[Column], size: Column, name: str) -> DataFrame:
    """``name``: the sum of ``size`` over the rows of a group up to and with each row, by ``bin_`` first and then by ``order``.

    ``sums`` is what ``bin_sums`` gives for the same columns, which hold no nulls. A group is never one task: only the rows of one
    bin are sorted together, and the sums of the bins before it are added.
    """
    offsets = sums.select(*(F.col(c).alias(f"_o_{c}") for c in [*group, bin_]), "_before")
    within = Window.partitionBy(*group, bin_).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    same = [F.col(c) == F.col(f"_o_{c}") for c in [*group, bin_]]
    joined = df.withColumn("_within", F.sum(size).over(within)).join(offsets, same)
    return joined.withColumn(name, F.col("_before") + F.col("_within")).drop("_before", "_within", *(f"_o_{c}" for c in [*group, bin_]))
