"""Named queries over the driver tables, each with SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..table import Catalog, Index, ItemTable

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def registered(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(query: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # timestamps are compared as UTC on both sides
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return query(spark, sf_dir)

        run.__name__, run.__doc__ = name, query.__doc__
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return query

    return keep


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def orders(spark: SparkSession, sf_dir: str) -> ItemTable:
    by_customer = Index("o_custkey", "o_orderdate")
    return ItemTable("orders", read(spark, sf_dir, "orders"), "o_orderkey", indexes={"by_customer": by_customer})


def customers(spark: SparkSession, sf_dir: str) -> ItemTable:
    return ItemTable("customer", read(spark, sf_dir, "customer"), "c_custkey")


def events(spark: SparkSession, sf_dir: str) -> ItemTable:
    return ItemTable("events", read(spark, sf_dir, "events"), "user_id", "ts")


def conversations(spark: SparkSession, sf_dir: str) -> ItemTable:
    return ItemTable("conversations", read(spark, sf_dir, "conversations"), "conv_id", "turn")


def catalog(spark: SparkSession, sf_dir: str) -> Catalog:
    found = Catalog(spark)
    for table in (orders(spark, sf_dir), customers(spark, sf_dir)):
        found.register_table(table.name, table.df, table.partition_key, table.sort_key, table.indexes)
    return found


def micros(col: str | Column) -> Column:
    """A timestamp as a whole number, the same in every SQL engine."""
    column = F.col(col) if isinstance(col, str) else col
    return F.unix_micros(column.cast("timestamp"))
