"""Registered queries of the forms where values meet the limits of their types, targets lie inside documents, and streams start anew."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import codec
from ..operators import statements as S
from ..operators import transact as X
from ..operators import write as W
from ..session import scratch_dir
from ..sources import files
from ..sources.snapshots import SnapshotStore
from ..streaming.mutations import MutationLog, apply_mutation_stream
from ..table import Catalog, ItemTable
from .registry import SQL, catalog, customers, orders, read, registered


@registered("src4_tsv_texts", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang, source FROM documents")
def src4_texts(spark, sf):
    """Texts with line breaks, blanks and quotes, there and back."""
    path = scratch_dir(spark, "items-tsv")
    files.write_items_tsv(read(spark, sf, "documents").select("doc_id", "text", "lang", "source"), path)
    return files.read_items_tsv(spark, path)


@registered("cod2_deep_round_trip", "SELECT event_id, repeat('[{\"k\":', 8) || event_id || repeat('}]', 8) AS doc FROM events")
def cod2_deep(spark, sf):
    """Documents nested 16 levels deep, tagged and back."""
    text = F.concat(F.repeat(F.lit('[{"k":'), F.lit(8)), F.col("event_id").cast("string"), F.repeat(F.lit("}]"), F.lit(8)))
    df = read(spark, sf, "events").select("event_id", F.parse_json(text).alias("doc"))
    path = scratch_dir(spark, "deep-items")
    files.write_items_json(df, path)
    back = codec.decode_items(spark.read.text(path), "value", {"event_id": T.LongType(), "doc": "L"})
    return back.select("event_id", F.to_json("doc").alias("doc"))


# -- targets inside documents -----------------------------------------------------------------


def _inside(name: str, expression: str, x: str, y: str, items: str) -> None:
    sql = f"""SELECT event_id, CASE WHEN event_type = 'click' THEN {x} ELSE CAST(event_id AS DOUBLE) END AS x,
                     CASE WHEN event_type = 'click' THEN {y} ELSE 'z' END AS y,
                     CASE WHEN event_type = 'click' THEN {items} ELSE '[' || (event_id % 7) || ',2,3]' END AS l FROM events"""

    def run(spark, sf) -> DataFrame:
        events = read(spark, sf, "events")
        number = F.col("event_id").cast("string")
        text = F.concat(F.lit('{"n":{"x":'), number, F.lit(',"y":"z"},"l":['), (F.col("event_id") % 7).cast("string"), F.lit(",2,3]}"))
        table = ItemTable("events", events.select("event_id", F.parse_json(text).alias("doc")), "event_id")
        clicks = events.where("event_type = 'click'").select("event_id")
        state = W.update_items(table, clicks, expression, {"#d": "doc"}, {":v": 5}).state
        part = lambda path, kind: F.try_variant_get("doc", path, kind)
        items_text = F.to_json(part("$.l", "array<bigint>"))
        return state.select("event_id", part("$.n.x", "double").alias("x"), part("$.n.y", "string").alias("y"), items_text.alias("l"))

    registered(name, sql)(run)


_X, _Y, _L = "CAST(event_id AS DOUBLE)", "'z'", "'[' || (event_id % 7) || ',2,3]'"
_inside("upd13_remove_nested", "REMOVE #d.n.y", _X, "NULL", _L)
_inside("upd12_add_nested", "ADD #d.n.x :v", f"{_X} + 5", _Y, _L)
_inside("upd8_list_set_nested", "SET #d.l[1] = :v", _X, _Y, "'[' || (event_id % 7) || ',5,3]'")
_inside("upd14_list_remove_nested", "REMOVE #d.l[0]", _X, _Y, "'[2,3]'")


# -- numbers and keys at the limits of their types --------------------------------------------


def _counters(spark, sf, start) -> tuple[ItemTable, DataFrame]:
    events = read(spark, sf, "events")
    table = ItemTable("events", events.select("event_id", start.alias("n")), "event_id")
    return table, events.where("event_type = 'click'").select("event_id", F.lit("1").alias("v"))


@registered("upd12_exact_text", "SELECT event_id, 9007199254740992 + event_id + CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS n FROM events")
def upd12_exact(spark, sf):
    """An addend given as text, beyond what a double holds."""
    table, asked = _counters(spark, sf, F.lit(2**53) + F.col("event_id"))
    return W.update_items(table, asked, "ADD n :v", values={":v": F.col("v")}).state


def _overflow(spark, sf) -> W.WriteResult:
    table, asked = _counters(spark, sf, F.lit(2**63 - 1) - F.col("event_id") % 2)
    return W.update_items(table, asked, "ADD n :v", values={":v": F.col("v")})


@registered(
    "upd16_whole_overflow",
    "SELECT event_id, 9223372036854775807 - CASE WHEN event_type = 'click' THEN 0 ELSE event_id % 2 END AS n FROM events",
)
def upd16_whole(spark, sf):
    return _overflow(spark, sf).state


@registered(
    "upd16_whole_failures", "SELECT event_id, 'ValidationException' AS code FROM events WHERE event_type = 'click' AND event_id % 2 = 0"
)
def upd16_whole_failures(spark, sf):
    return _overflow(spark, sf).failures


def _misfits(spark, sf) -> W.WriteResult:
    """A third of the keys is no whole number, a third of the values no number."""
    key, third = F.col("c_custkey"), F.col("c_custkey") % 3
    puts = read(spark, sf, "customer").select(
        (key + F.when(third == 0, 0.5).otherwise(0.0)).alias("c_custkey"), F.when(third == 1, F.lit("x")).otherwise(F.lit("7")).alias("c_nationkey")
    )
    return W.put_items(customers(spark, sf), puts)


@registered("mut1_put_refused", "SELECT c_custkey, CASE WHEN c_custkey % 3 = 2 THEN 7 ELSE c_nationkey END AS c_nationkey FROM customer")
def mut1_refused(spark, sf):
    return _misfits(spark, sf).state.select("c_custkey", "c_nationkey")


@registered(
    "mut1_refused_failures",
    "SELECT CASE WHEN c_custkey % 3 = 1 THEN c_custkey END AS c_custkey, 'ValidationException' AS code FROM customer WHERE c_custkey % 3 <> 2",
)
def mut1_failures(spark, sf):
    return _misfits(spark, sf).failures


# -- statements and transactions --------------------------------------------------------------


@registered("stm1_literal_kept", "SELECT 'mail from new-york' AS note, c_custkey FROM customer")
def stm1_literal(spark, sf):
    return S.select(catalog(spark, sf), "SELECT 'mail from new-york' AS note, c_custkey FROM customer")


@registered(
    "stm3_on_conflict",
    """SELECT o_orderkey, o_orderstatus FROM orders
       UNION ALL SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey NOT IN (SELECT o_orderkey FROM orders)""",
)
def stm3_conflict(spark, sf):
    """INSERT … ON CONFLICT DO NOTHING of customers' keys into the orders."""
    rows = read(spark, sf, "customer").select(F.col("c_custkey").alias("o_orderkey"), F.col("c_mktsegment").alias("o_orderstatus"))
    return S.insert_value(orders(spark, sf), rows, on_conflict="nothing").state.select("o_orderkey", "o_orderstatus")


@registered("stm7_limit_zero", "SELECT count(*) AS n FROM (SELECT * FROM orders LIMIT 0)")
def stm7_zero(spark, sf):
    return S.select(catalog(spark, sf), "SELECT * FROM orders", limit=0).agg(F.count(F.lit(1)).alias("n"))


_BUILDERS = "SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'"


def _tagged(spark, sf, expression: str) -> DataFrame:
    found = Catalog(spark)
    df = read(spark, sf, "customer").select("c_custkey", F.array("c_mktsegment", F.lit("x")).alias("tags"))
    found.register_table("tagged", df, "c_custkey")
    asked = read(spark, sf, "customer").where("c_mktsegment = 'BUILDING'").select("c_custkey")
    update = X.Update("tagged", asked, expression, values={":v": {"SS": ["x", "none"]}})
    state = X.transact_write(found, [update]).states["tagged"]
    return state.select("c_custkey", F.array_join("tags", ",").alias("tags"))


@registered(
    "txn5_delete", f"SELECT c_custkey, c_mktsegment || CASE WHEN c_custkey IN ({_BUILDERS}) THEN '' ELSE ',x' END AS tags FROM customer"
)
def txn5_delete(spark, sf):
    return _tagged(spark, sf, "DELETE tags :v")


@registered("txn5_remove", f"SELECT c_custkey, CASE WHEN c_custkey NOT IN ({_BUILDERS}) THEN c_mktsegment || ',x' END AS tags FROM customer")
def txn5_remove(spark, sf):
    found = Catalog(spark)
    df = read(spark, sf, "customer").select("c_custkey", F.array("c_mktsegment", F.lit("x")).alias("tags"))
    found.register_table("tagged", df, "c_custkey")
    asked = read(spark, sf, "customer").where("c_mktsegment = 'BUILDING'").select("c_custkey")
    state = X.transact_write(found, [X.Update("tagged", asked, "REMOVE tags")]).states["tagged"]
    return state.select("c_custkey", F.array_join("tags", ",").alias("tags"))


# -- streams ----------------------------------------------------------------------------------


def _requests(events: DataFrame) -> DataFrame:
    """An error deletes the user's item, everything else puts its kind, a purchase also its value."""
    carried = F.when(F.col("event_type") == "purchase", F.array(F.lit("c_mktsegment"), F.lit("c_acctbal")))
    return events.select(
        F.col("user_id").alias("c_custkey"),
        F.col("event_type").alias("c_mktsegment"),
        F.col("value").alias("c_acctbal"),
        F.when(F.col("event_type") == "error", F.lit("delete")).otherwise(F.lit("put")).alias("op"),
        F.col("event_id").alias("seq"),
        carried.otherwise(F.array(F.lit("c_mktsegment"))).alias("_present"),
    )


@registered("str3_restarted", SQL["str3_mutation_stream"])
def str3_restarted(spark, sf):
    """Two streams, each with a checkpoint of its own, over the two halves of the events; the first is compacted in between."""
    root = scratch_dir(spark, "mutations")
    store = SnapshotStore(spark, root)
    store.commit({"customer": read(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")})
    log = MutationLog(store, "customer", ["c_custkey"])
    events = read(spark, sf, "events")
    middle = events.agg((F.max("event_id") / 2).cast("long")).first()[0] or 0
    for run, half in enumerate((F.col("event_id") <= middle, F.col("event_id") > middle)):
        stream = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(sf).where(half)
        writer = apply_mutation_stream(_requests(stream), log, f"{root}/checkpoint{run}")
        writer.trigger(availableNow=True).start().awaitTermination()
        if run == 0:
            log.compact()
    return log.state()


@registered(
    "str3_mixed_columns",
    """WITH v AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'view'),
            p AS (SELECT user_id, arg_max(value, event_id) AS spent FROM events WHERE event_type = 'purchase' GROUP BY user_id)
       SELECT coalesce(c.c_custkey, v.user_id, p.user_id) AS c_custkey,
              CASE WHEN p.user_id IS NOT NULL THEN 'buyer' WHEN v.user_id IS NOT NULL THEN 'viewer' ELSE c.c_mktsegment END AS c_mktsegment, p.spent
       FROM customer c FULL JOIN v ON c.c_custkey = v.user_id FULL JOIN p ON coalesce(c.c_custkey, v.user_id) = p.user_id""",
)
def str3_mixed(spark, sf):
    """Change sets of different columns; one brings an attribute that the table does not have."""
    root = scratch_dir(spark, "mutations")
    store = SnapshotStore(spark, root)
    store.commit({"customer": read(spark, sf, "customer").select("c_custkey", "c_mktsegment")})
    log = MutationLog(store, "customer", ["c_custkey"])
    events = read(spark, sf, "events").withColumn("op", F.lit("put")).withColumn("seq", F.col("event_id"))
    common = [F.col("user_id").alias("c_custkey"), "op", "seq"]
    log.append(events.where("event_type = 'view'").select(*common, F.lit("viewer").alias("c_mktsegment")), 0)
    bought = events.where("event_type = 'purchase'")
    log.append(bought.select(*common, F.lit("buyer").alias("c_mktsegment"), F.col("value").alias("spent")), 1)
    return log.state()
