"""Puts, deletes, updates, transactions, statements, change records, streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import updates as U
from ..operators import statements as S
from ..operators import transact as X
from ..operators import write as W
from ..session import scratch_dir
from ..sources.snapshots import SnapshotStore
from ..streaming.changes import change_feed, stream_enabled
from ..streaming.mutations import MutationLog, apply_mutation_stream
from ..table import ItemTable
from .registry import catalog, customers, orders, read, registered


def price(df: DataFrame) -> DataFrame:
    """Order rows with the price in cents' precision."""
    return df.select("o_orderkey", "o_orderstatus", F.round("o_totalprice", 2).alias("o_totalprice"))


def urgent(spark, sf, factor: float = 2.0) -> DataFrame:
    """Requests: urgent orders at another price."""
    df = read(spark, sf, "orders").where("o_orderpriority = '1-URGENT'")
    return df.select("o_orderkey", (F.col("o_totalprice") * factor).alias("o_totalprice"))


def new_orders(spark, sf) -> DataFrame:
    """Requests: an order that does not exist yet for every customer."""
    return read(spark, sf, "customer").select(
        (-F.col("c_custkey") - 1).alias("o_orderkey"), F.col("c_acctbal").alias("o_totalprice")
    )


def returned(spark, sf) -> DataFrame:
    """Keys of orders with a returned line, one per line."""
    lines = read(spark, sf, "lineitem").where("l_returnflag = 'R' AND l_discount > 0.05")
    return lines.select(F.col("l_orderkey").alias("o_orderkey"))


_RETURNED = "SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_discount > 0.05"
_PRICE = "o_orderkey, o_orderstatus, round(o_totalprice, 2) AS o_totalprice"

# -- puts -------------------------------------------------------------------------------------

_PUT_SQL = """SELECT o_orderkey, o_orderstatus, round(CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice * 2 ELSE o_totalprice END, 2) AS o_totalprice
    FROM orders UNION ALL SELECT -c_custkey - 1, NULL, round(c_acctbal, 2) FROM customer"""


@registered("mut1_put_merge", _PUT_SQL)
def mut1(spark, sf):
    """Changed and new items; what a put does not carry stays."""
    return price(W.put_items(orders(spark, sf), urgent(spark, sf).union(new_orders(spark, sf))).state)


@registered("mut6_batch_put", _PUT_SQL)
def mut6(spark, sf):
    items = urgent(spark, sf).union(new_orders(spark, sf)).withColumn("at", F.lit(1))
    stale = items.withColumn("o_totalprice", F.lit(0.0)).withColumn("at", F.lit(0))
    return price(W.batch_put(orders(spark, sf), items.union(stale), seq="at").state)


@registered(
    "mut1_put_replace",
    """SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE o_orderstatus END AS o_orderstatus,
       round(CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice * 2 ELSE o_totalprice END, 2) AS o_totalprice FROM orders""",
)
def mut1_replace(spark, sf):
    return price(W.put_items(orders(spark, sf), urgent(spark, sf), mode="replace").state)


def _conditional(spark, sf) -> W.WriteResult:
    items = urgent(spark, sf).union(new_orders(spark, sf))
    return W.put_items(orders(spark, sf), items, "o_orderstatus = :s OR attribute_not_exists(o_custkey)", values={":s": "F"})


@registered(
    "mut2_put_conditional",
    """SELECT o_orderkey, o_orderstatus, round(CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' THEN o_totalprice * 2 ELSE o_totalprice END, 2) AS o_totalprice
       FROM orders UNION ALL SELECT -c_custkey - 1, NULL, round(c_acctbal, 2) FROM customer""",
)
def mut2(spark, sf):
    return price(_conditional(spark, sf).state)


@registered(
    "mut2_put_failures",
    """SELECT o_orderkey, 'ConditionalCheckFailedException' AS code FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus <> 'F'""",
)
def mut2_failures(spark, sf):
    return _conditional(spark, sf).failures


@registered(
    "mut3_put_nested",
    """SELECT event_id, CASE WHEN event_type = 'click' THEN event_id ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k FROM events""",
)
def mut3(spark, sf):
    df = read(spark, sf, "events")
    base = df.select("event_id", F.from_json("props", "map<string,bigint>").alias("props"))
    clicks = df.where("event_type = 'click'").select("event_id", F.col("event_id").alias("fresh"))
    state = W.put_nested(ItemTable("events", base, "event_id"), clicks, "props.k", "fresh").state
    return state.select("event_id", F.col("props")["k"].alias("k"))


@registered("mut4_delete", f"SELECT {_PRICE} FROM orders WHERE o_orderkey NOT IN ({_RETURNED})")
def mut4(spark, sf):
    return price(W.delete_items(orders(spark, sf), returned(spark, sf)).state)


@registered("mut7_batch_delete", f"SELECT {_PRICE} FROM orders WHERE o_orderkey NOT IN ({_RETURNED})")
def mut7(spark, sf):
    return price(W.batch_delete(orders(spark, sf), returned(spark, sf)).state)


@registered(
    "mut5_delete_conditional",
    f"SELECT {_PRICE} FROM orders WHERE NOT (o_orderkey IN ({_RETURNED}) AND o_totalprice < 250000)",
)
def mut5(spark, sf):
    result = W.delete_items(orders(spark, sf), returned(spark, sf), "#p < :v", {"#p": "o_totalprice"}, {":v": 250000})
    return price(result.state)


def _mixed(spark, sf) -> DataFrame:
    puts = urgent(spark, sf, 3.0).union(new_orders(spark, sf)).withColumn("op", F.lit("put"))
    deletes = returned(spark, sf).select("o_orderkey", F.lit(None).cast("double").alias("o_totalprice"), F.lit("delete").alias("op"))
    nowhere = read(spark, sf, "nation").select(
        F.lit(None).cast("bigint").alias("o_orderkey"), F.lit(1.0).alias("o_totalprice"), F.lit("put").alias("op")
    )
    return puts.unionByName(deletes).unionByName(nowhere)


@registered(
    "mut8_batch_write",
    f"""SELECT * FROM (SELECT o_orderkey, o_orderstatus, round(CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice * 3 ELSE o_totalprice END, 2) AS o_totalprice
        FROM orders UNION ALL SELECT -c_custkey - 1, NULL, round(c_acctbal, 2) FROM customer) WHERE o_orderkey NOT IN ({_RETURNED})""",
)
def mut8(spark, sf):
    return price(W.batch_write(orders(spark, sf), _mixed(spark, sf)).state)


@registered("mut8_unprocessed", "SELECT CAST(NULL AS BIGINT) AS o_orderkey, 'put' AS op, 'ValidationException' AS code FROM nation")
def mut8_unprocessed(spark, sf):
    return W.batch_write(orders(spark, sf), _mixed(spark, sf)).unprocessed


@registered(
    "mut9_last_write_wins",
    """SELECT user_id, arg_max(value, event_id) FILTER (event_type = 'purchase') AS value,
              arg_max(props, event_id) FILTER (event_type <> 'purchase') AS props FROM events GROUP BY user_id""",
)
def mut9(spark, sf):
    """Purchases carry a value, everything else carries props."""
    carried = F.when(F.col("event_type") == "purchase", F.array(F.lit("value"))).otherwise(F.array(F.lit("props")))
    puts = read(spark, sf, "events").select("user_id", "event_id", "value", "props", carried.alias("_present"))
    return W.last_write_wins(puts, ["user_id"], "event_id").select("user_id", "value", "props")


_MODES = {
    "NONE": "SELECT 'images' AS what, CAST(0 AS BIGINT) AS n UNION ALL SELECT 'items', count(*) FROM orders",
    "ALL_OLD": f"SELECT {_PRICE} FROM orders WHERE o_orderpriority = '1-URGENT'",
    "ALL_NEW": f"SELECT o_orderkey, o_orderstatus, round(o_totalprice * 2, 2) AS o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT'",
    "UPDATED_OLD": "SELECT o_orderkey, round(o_totalprice, 2) AS o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT'",
    "UPDATED_NEW": "SELECT o_orderkey, round(o_totalprice * 2, 2) AS o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT'",
}


def _register_modes() -> None:
    for mode, sql in _MODES.items():

        def images(spark, sf, mode=mode):
            result = W.put_items(orders(spark, sf), urgent(spark, sf))
            got = result.return_values(mode)
            if mode == "NONE":
                n = F.count(F.lit(1)).alias("n")
                images = got.agg(n).select(F.lit("images").alias("what"), "n")
                return images.union(result.state.agg(n).select(F.lit("items"), "n"))
            names = ["o_orderkey", *(["o_orderstatus"] if mode.startswith("ALL") else [])]
            return got.select(*names, F.round("o_totalprice", 2).alias("o_totalprice"))

        registered(f"mut10_return_{mode.lower()}", sql)(images)


_register_modes()


@registered(
    "mut11_merge_images",
    """SELECT coalesce(o.o_orderkey, n.l_orderkey) AS o_orderkey, o.o_orderstatus, round(coalesce(n.total, o.o_totalprice), 2) AS o_totalprice
       FROM orders o FULL JOIN (SELECT l_orderkey, sum(l_quantity) AS total FROM lineitem GROUP BY l_orderkey) n ON o.o_orderkey = n.l_orderkey""",
)
def mut11(spark, sf):
    totals = read(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_quantity").alias("o_totalprice"))
    return price(W.merge_images(read(spark, sf, "orders"), totals, ["o_orderkey"]))


# -- updates ----------------------------------------------------------------------------------


def deltas(spark, sf) -> DataFrame:
    """One request per order line: what it adds to its order."""
    return read(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_quantity").alias("q"), F.col("l_linenumber").alias("line")
    )


def totals(spark, sf) -> DataFrame:
    """One request per order: its summed quantity."""
    return deltas(spark, sf).groupBy("o_orderkey").agg(F.sum("q").alias("q"))


_JOINED = "orders o LEFT JOIN (SELECT l_orderkey, sum(l_quantity) AS q FROM lineitem GROUP BY l_orderkey) t ON o.o_orderkey = t.l_orderkey"
_OPEN = "CASE WHEN o_orderstatus <> 'O' THEN o_totalprice END"


def open_orders(spark, sf) -> ItemTable:
    """Orders whose price is absent while they are open."""
    df = read(spark, sf, "orders").withColumn("o_totalprice", F.when(F.col("o_orderstatus") != "O", F.col("o_totalprice")))
    return ItemTable("orders", df, "o_orderkey")


def _updated(name: str, expression: str, value: str) -> None:
    """An update of the price of every order that has lines; ``value`` is its SQL."""
    sql = f"""SELECT o_orderkey, o_orderstatus, round(CASE WHEN t.q IS NULL THEN {_OPEN} ELSE {value} END, 2) AS o_totalprice FROM {_JOINED}"""

    def run(spark, sf):
        result = W.update_items(open_orders(spark, sf), totals(spark, sf), expression, {"#p": "o_totalprice"}, {":q": F.col("q")})
        return price(result.state)

    registered(name, sql)(run)


_updated("upd1_set", "SET #p = :q", "t.q")
_updated("upd2_add", "SET #p = #p + :q", f"coalesce({_OPEN}, 0) + t.q")
_updated("upd3_subtract", "SET #p = #p - :q", f"coalesce({_OPEN}, 0) - t.q")
_updated("upd4_if_not_exists", "SET #p = if_not_exists(#p, :q)", f"coalesce({_OPEN}, t.q)")
_updated("upd5_if_exists", "SET #p = if_exists(#p, :q)", f"CASE WHEN {_OPEN} IS NOT NULL THEN t.q END")
_updated("upd13_remove", "REMOVE #p", "NULL")


@registered(
    "upd12_add_number",
    f"""SELECT o_orderkey, o_orderstatus, round(CASE WHEN t.q IS NULL THEN {_OPEN} ELSE coalesce({_OPEN}, 0) + t.q END, 2) AS o_totalprice FROM {_JOINED}""",
)
def upd12(spark, sf):
    """Many additions to one item, summed before the join; numbers may come as text."""
    asked = deltas(spark, sf).withColumn("q", F.col("q").cast("string"))
    return price(W.update_items(open_orders(spark, sf), asked, "ADD o_totalprice :q", values={":q": F.col("q")}, seq="line").state)


def _list_base(spark, sf) -> ItemTable:
    df = read(spark, sf, "customer")
    names = F.when(F.col("c_mktsegment") != "BUILDING", F.array("c_mktsegment", "c_name", F.lit("z")))
    return ItemTable("customer", df.select("c_custkey", names.alias("names")), "c_custkey")


def _buyers(spark, sf) -> DataFrame:
    """One request per customer that has an expensive order."""
    df = read(spark, sf, "orders").where("o_totalprice > 300000")
    return df.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderkey").cast("string").alias("last"))


_LISTS = """customer c LEFT JOIN (SELECT o_custkey, CAST(max(o_orderkey) AS VARCHAR) AS last FROM orders WHERE o_totalprice > 300000 GROUP BY o_custkey) r
            ON c.c_custkey = r.o_custkey"""
_NAMES = "CASE WHEN c_mktsegment <> 'BUILDING' THEN [c_mktsegment, c_name, 'z'] END"


def _list_update(name: str, expression: str, value: str) -> None:
    sql = f"SELECT c_custkey, array_to_string(CASE WHEN r.last IS NULL THEN {_NAMES} ELSE {value} END, ',') AS names FROM {_LISTS}"

    def run(spark, sf):
        result = W.update_items(_list_base(spark, sf), _buyers(spark, sf), expression, values={":v": F.col("last")})
        return result.state.select("c_custkey", F.array_join("names", ",").alias("names"))

    registered(name, sql)(run)


_list_update("upd6_list_append", "SET names = list_append(names, :v)", f"list_concat(coalesce({_NAMES}, []), [r.last])")
_list_update(
    "upd8_list_set", "SET names[1] = :v", "CASE WHEN c_mktsegment <> 'BUILDING' THEN [c_mktsegment, r.last, 'z'] END"
)
_list_update("upd8_list_set_end", "SET names[3] = :v", "CASE WHEN c_mktsegment <> 'BUILDING' THEN [c_mktsegment, c_name, 'z', r.last] END")
_list_update("upd8_list_set_beyond", "SET names[4] = :v", _NAMES)
_list_update("upd14_list_remove", "REMOVE names[0]", "CASE WHEN c_mktsegment <> 'BUILDING' THEN [c_name, 'z'] END")


@registered(
    "upd6_list_append_many",
    """SELECT c_custkey, array_to_string(list_concat(coalesce(CASE WHEN c_mktsegment <> 'BUILDING' THEN [c_mktsegment, c_name, 'z'] END, []), coalesce(r.l, [])), ',') AS names,
       FROM customer c LEFT JOIN (SELECT o_custkey, list(CAST(o_orderkey AS VARCHAR) ORDER BY o_orderkey) AS l FROM orders WHERE o_totalprice > 300000 GROUP BY o_custkey) r
       ON c.c_custkey = r.o_custkey WHERE r.l IS NOT NULL OR c_mktsegment <> 'BUILDING'""",
)
def upd6_many(spark, sf):
    """Several appends to one list, in the order of the requests."""
    asked = read(spark, sf, "orders").where("o_totalprice > 300000").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey", F.col("o_orderkey").cast("string").alias("v")
    )
    result = W.update_items(_list_base(spark, sf), asked, [U.list_append("names", F.col("v"))], seq="o_orderkey")
    state = result.state.where("names IS NOT NULL")
    return state.select("c_custkey", F.array_join("names", ",").alias("names"))


@registered(
    "upd7_set_nested",
    """SELECT event_id, CASE WHEN event_type = 'click' THEN event_id ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k, event_type AS kind,
              CASE WHEN event_type = 'click' THEN '{"a":{"b":' || event_id || ',"c":"x"}}' ELSE '{"a":{"b":0,"c":"x"}}' END AS doc FROM events""",
)
def upd7(spark, sf):
    """A field of a struct, two levels down, and of a document."""
    df = read(spark, sf, "events")
    inner = F.from_json("props", "struct<k:bigint>")
    base = df.select(
        "event_id",
        F.struct(F.struct(inner.getField("k").alias("k")).alias("inner"), F.col("event_type").alias("kind")).alias("m"),
        F.parse_json(F.lit('{"a":{"b":0,"c":"x"}}')).alias("doc"),
    )
    clicks = df.where("event_type = 'click'").select("event_id", F.col("event_id").alias("v"))
    result = W.update_items(
        ItemTable("events", base, "event_id"),
        clicks,
        "SET #m.#i.#k = :v, doc.a.b = :v",
        {"#m": "m", "#i": "inner", "#k": "k"},
        {":v": F.col("v")},
    )
    return result.state.select("event_id", F.col("m.inner.k").alias("k"), F.col("m.kind").alias("kind"), F.to_json("doc").alias("doc"))


def _word_sets(spark, sf) -> ItemTable:
    df = read(spark, sf, "documents")
    return ItemTable("documents", df.select("doc_id", F.array_distinct(F.split("text", " ")).alias("words")), "doc_id")


def _labelled(spark, sf) -> DataFrame:
    docs = read(spark, sf, "documents").select("doc_id", F.array("lang", "source", F.lit("the")).alias("w"))
    return docs.join(read(spark, sf, "labels").where("quality = 1").select("doc_id"), "doc_id", "left_semi")


_WORDS = "list_distinct(string_split(text, ' '))"
_GIVEN = "[lang, source, 'the']"


def _set_update(name: str, expression: str, value: str) -> None:
    sql = f"""SELECT doc_id, len(w) AS members, md5(array_to_string(list_sort(w), ' ')) AS digest FROM
              (SELECT doc_id, CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) THEN {value} ELSE {_WORDS} END AS w FROM documents)"""

    def run(spark, sf):
        asked = _labelled(spark, sf)
        actions = [U.replace_set("words", F.col("w"))] if name == "upd11_set_replace" else expression
        result = W.update_items(_word_sets(spark, sf), asked, actions, values={":w": F.col("w")})
        return result.state.select(
            "doc_id",
            F.size("words").cast("bigint").alias("members"),
            F.md5(F.array_join(F.sort_array("words"), " ").cast("binary")).alias("digest"),
        )

    registered(name, sql)(run)


_set_update("upd9_set_union", "ADD words :w", f"list_distinct(list_concat({_WORDS}, {_GIVEN}))")
_set_update("upd10_set_difference", "DELETE words :w", f"list_filter({_WORDS}, lambda x: NOT list_contains({_GIVEN}, x))")
_set_update("upd11_set_replace", "SET words = :w", f"list_distinct({_GIVEN})")


@registered(
    "upd15_multi",
    f"""SELECT o.o_orderkey, CASE WHEN t.q IS NULL THEN o_orderstatus ELSE 'X' END AS o_orderstatus,
               round(CASE WHEN t.q IS NULL THEN o_totalprice ELSE o_totalprice + t.q END, 2) AS o_totalprice,
               CASE WHEN t.q IS NULL THEN o_orderpriority END AS o_orderpriority,
               CASE WHEN t.q IS NULL THEN o_custkey ELSE o_custkey + CAST(o_totalprice > 1000 AS INTEGER) END AS o_custkey FROM {_JOINED}""",
)
def upd15(spark, sf):
    """Four actions at once; all right sides read the old item."""
    result = W.update_items(
        orders(spark, sf),
        totals(spark, sf),
        "set #s = :x, o_custkey = o_custkey + cast(o_totalprice > 1000 AS int) REMOVE o_orderpriority add o_totalprice :q",
        {"#s": "o_orderstatus"},
        {":x": "X", ":q": F.col("q")},
    )
    return result.state.select("o_orderkey", "o_orderstatus", F.round("o_totalprice", 2).alias("o_totalprice"), "o_orderpriority", "o_custkey")


def _overflow(spark, sf) -> W.WriteResult:
    df = read(spark, sf, "orders").withColumn(
        "o_totalprice", F.when(F.col("o_orderstatus") == "F", F.lit(1.7e308)).otherwise(F.col("o_totalprice"))
    )
    return W.update_items(ItemTable("orders", df, "o_orderkey"), totals(spark, sf), "ADD o_totalprice :v", values={":v": 1.6e308})


@registered(
    "upd16_infinity",
    "SELECT o_orderkey, 'ValidationException' AS code FROM orders WHERE o_orderstatus = 'F' AND o_orderkey IN (SELECT l_orderkey FROM lineitem)",
)
def upd16(spark, sf):
    return _overflow(spark, sf).failures


@registered(
    "upd16_infinity_state",
    """SELECT o_orderkey, o_orderstatus = 'F' OR o_orderkey IN (SELECT l_orderkey FROM lineitem) AS large FROM orders""",
)
def upd16_state(spark, sf):
    """A refused update leaves the item as it was."""
    return _overflow(spark, sf).state.select("o_orderkey", F.col("o_totalprice").between(1e308, 1.75e308).alias("large"))


def _gated(spark, sf) -> W.WriteResult:
    return W.update_items(
        orders(spark, sf),
        totals(spark, sf),
        "SET o_totalprice = :q",
        values={":q": F.col("q"), ":s": "F", ":min": F.col("q")},
        condition="o_orderstatus = :s AND o_totalprice > :min",
    )


@registered(
    "upd17_conditional",
    f"""SELECT o_orderkey, o_orderstatus, round(CASE WHEN t.q IS NOT NULL AND o_orderstatus = 'F' AND o_totalprice > t.q THEN t.q ELSE o_totalprice END, 2) AS o_totalprice FROM {_JOINED}""",
)
def upd17(spark, sf):
    return price(_gated(spark, sf).state)


@registered(
    "upd17_failures",
    f"""SELECT o_orderkey, 'ConditionalCheckFailedException' AS code FROM {_JOINED} WHERE t.q IS NOT NULL AND NOT (o_orderstatus = 'F' AND o_totalprice > t.q)""",
)
def upd17_failures(spark, sf):
    return _gated(spark, sf).failures


@registered(
    "upd18_create",
    f"""SELECT {_PRICE} FROM orders UNION ALL SELECT -c_custkey - 1, 'N', round(c_acctbal, 2) FROM customer""",
)
def upd18(spark, sf):
    result = W.update_items(
        orders(spark, sf), new_orders(spark, sf), "SET o_orderstatus = :n ADD o_totalprice :v", values={":n": "N", ":v": F.col("o_totalprice")}
    )
    return price(result.state)


@registered(
    "upd19_bulk",
    f"""SELECT o_orderkey, o_orderstatus, round(CASE WHEN t.q IS NULL THEN o_totalprice ELSE o_totalprice - t.q END, 2) AS o_totalprice FROM {_JOINED}""",
)
def upd19(spark, sf):
    """A request for every order line, folded to one per order."""
    return price(
        W.update_items(orders(spark, sf), deltas(spark, sf), "SET o_totalprice = o_totalprice - :q", values={":q": F.col("q")}, seq="line").state
    )


# -- transactions -----------------------------------------------------------------------------


def _transaction(spark, sf, least: int) -> X.TransactResult:
    found = catalog(spark, sf)
    rich = read(spark, sf, "orders").where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey")).distinct()
    return X.transact_write(
        found,
        [
            X.Check("customer", read(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_nationkey >= :n", values={":n": least}),
            X.Put("orders", new_orders(spark, sf), "attribute_not_exists(o_totalprice)"),
            X.Update("customer", rich, "SET c_mktsegment = :s ADD c_acctbal :b", values={":s": "RICH", ":b": 100}),
            X.Delete("orders", returned(spark, sf)),
        ],
    )


_COMMITTED_ORDERS = f"SELECT {_PRICE} FROM orders WHERE o_orderkey NOT IN ({_RETURNED}) UNION ALL SELECT -c_custkey - 1, NULL, round(c_acctbal, 2) FROM customer"
_RICH = "SELECT o_custkey FROM orders WHERE o_totalprice > 400000"


@registered("txn1_commit", _COMMITTED_ORDERS)
def txn1(spark, sf):
    return price(_transaction(spark, sf, 0).states["orders"])


@registered(
    "txn5_add",
    f"""SELECT c_custkey, CASE WHEN c_custkey IN ({_RICH}) THEN 'RICH' ELSE c_mktsegment END AS c_mktsegment,
               round(CASE WHEN c_custkey IN ({_RICH}) THEN c_acctbal + 100 ELSE c_acctbal END, 2) AS c_acctbal FROM customer""",
)
def txn5(spark, sf):
    """The other table of the same transaction."""
    state = _transaction(spark, sf, 0).states["customer"]
    return state.select("c_custkey", "c_mktsegment", F.round("c_acctbal", 2).alias("c_acctbal"))


@registered("txn1_abort", f"SELECT {_PRICE} FROM orders")
def txn1_abort(spark, sf):
    """One check that fails leaves every table as it was."""
    return price(_transaction(spark, sf, 5).states["orders"])


@registered(
    "txn1_failures",
    """SELECT CAST(0 AS INTEGER) AS request, 'customer' AS "table", '{"c_custkey":' || c_custkey || '}' AS key, 'ConditionalCheckFailedException' AS code
       FROM customer WHERE c_nationkey < 5 AND c_custkey IN (SELECT o_custkey FROM orders)""",
)
def txn1_failures(spark, sf):
    return _transaction(spark, sf, 5).failures


@registered(
    "txn2_condition_check",
    """SELECT k.user_id AS c_custkey, coalesce(c.c_acctbal > 0 AND c.c_mktsegment <> 'BUILDING', false) AS holds
       FROM (SELECT DISTINCT user_id FROM events) k LEFT JOIN customer c ON c.c_custkey = k.user_id""",
)
def txn2(spark, sf):
    keys = read(spark, sf, "events").select(F.col("user_id").alias("c_custkey"))
    return X.condition_check(customers(spark, sf), keys, "c_acctbal > :z AND c_mktsegment <> :b", values={":z": 0, ":b": "BUILDING"})


@registered("txn3_put", _PUT_SQL)
def txn3(spark, sf):
    puts = X.Put("orders", urgent(spark, sf).union(new_orders(spark, sf)))
    return price(X.transact_write(catalog(spark, sf), [puts]).states["orders"])


@registered("txn4_delete", f"SELECT {_PRICE} FROM orders WHERE o_orderkey NOT IN ({_RETURNED})")
def txn4(spark, sf):
    removal = X.Delete("orders", returned(spark, sf), "o_totalprice > :v", values={":v": 0})
    return price(X.transact_write(catalog(spark, sf), [removal]).states["orders"])


# -- statements -------------------------------------------------------------------------------


@registered("stm1_select", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 200000")
def stm1(spark, sf):
    return S.select(catalog(spark, sf), "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 200000")


@registered(
    "stm2_params",
    "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 123456.5 AND (o_custkey > 10) = true AND list_contains(['1-URGENT', '2-HIGH'], o_orderpriority)",
)
def stm2(spark, sf):
    text = "SELECT o_orderkey FROM orders WHERE o_orderstatus = ? AND o_totalprice > ? AND (o_custkey > 10) = ? AND array_contains(?, o_orderpriority)"
    params = [{"S": "P"}, {"N": "123456.5"}, {"BOOL": True}, {"SS": ["1-URGENT", "2-HIGH"]}]
    return S.select(catalog(spark, sf), text, params)


@registered("stm3_insert_value", f"SELECT {_PRICE} FROM orders UNION ALL SELECT -c_custkey - 1, c_mktsegment, round(c_acctbal, 2) FROM customer")
def stm3(spark, sf):
    """Literals of an INSERT as text, one statement per customer."""
    rows = read(spark, sf, "customer").select(
        (-F.col("c_custkey") - 1).cast("string").alias("o_orderkey"),
        F.concat(F.lit("'"), "c_mktsegment", F.lit("'")).alias("o_orderstatus"),
        F.col("c_acctbal").cast("string").alias("o_totalprice"),
    )
    return price(S.insert_value(orders(spark, sf), rows, literals=True).state)


@registered(
    "stm4_update_where",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' OR o_custkey IN (1, 2, 3) THEN 'DONE' ELSE o_orderstatus END AS o_orderstatus,
              round(CASE WHEN o_orderstatus = 'F' OR o_custkey IN (1, 2, 3) THEN o_totalprice + 5 ELSE o_totalprice END, 2) AS o_totalprice FROM orders""",
)
def stm4(spark, sf):
    result = S.execute_statement(
        catalog(spark, sf),
        "UPDATE orders SET o_orderstatus = 'DONE', o_totalprice = o_totalprice + ? WHERE o_orderstatus = ? OR o_custkey IN (1, 2, 3)",
        [{"N": "5"}, {"S": "F"}],
    )
    return price(result.state)


@registered("stm5_delete_where", f"SELECT {_PRICE} FROM orders WHERE NOT (o_orderstatus = 'F' AND o_totalprice > 100000)")
def stm5(spark, sf):
    result = S.execute_statement(catalog(spark, sf), "DELETE FROM orders WHERE o_orderstatus = ? AND o_totalprice > 100000", ["F"])
    return price(result.state)


@registered(
    "stm6_order_limit",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O' ORDER BY o_totalprice DESC, o_orderkey LIMIT 20 OFFSET 5",
)
def stm6(spark, sf):
    text = "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = ? ORDER BY o_totalprice DESC, o_orderkey LIMIT 20 OFFSET 5"
    return S.select(catalog(spark, sf), text, ["O"])


@registered("stm7_request_limit", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O' ORDER BY o_orderkey LIMIT 7")
def stm7(spark, sf):
    return S.select(catalog(spark, sf), "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O' ORDER BY o_orderkey", limit=7)


# -- change records ---------------------------------------------------------------------------


def _narrow(spark, sf) -> ItemTable:
    return ItemTable("orders", read(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_custkey"), "o_orderkey")


def _changed(spark, sf) -> DataFrame:
    """Orders after a round of updates, deletes and puts."""
    table = _narrow(spark, sf)
    urgent_keys = read(spark, sf, "orders").where("o_orderpriority = '1-URGENT'").select("o_orderkey")
    after = W.update_items(table, urgent_keys, "SET o_orderstatus = :x", values={":x": "F"}).table_after
    after = W.delete_items(after, returned(spark, sf)).table_after
    return W.put_items(after, new_orders(spark, sf).select("o_orderkey", F.lit("N").alias("o_orderstatus"))).state


_IMAGE = """'{"o_orderkey":{"N":"' || %s || '"},"o_orderstatus":{"S":"' || %s || '"}' || CASE WHEN %s IS NULL THEN '' ELSE ',"o_custkey":{"N":"' || %s || '"}' END || '}'"""


def _image(alias: str) -> str:
    key, status, owner = f"{alias}.o_orderkey", f"{alias}.o_orderstatus", f"{alias}.o_custkey"
    text = _IMAGE % (key, status, owner, f"coalesce(CAST({owner} AS VARCHAR), '')")
    return f"CASE WHEN {key} IS NOT NULL THEN {text} END"


_FEED = f"""SELECT 'orders' AS "table", CASE WHEN o.o_orderkey IS NULL THEN 'INSERT' WHEN n.o_orderkey IS NULL THEN 'REMOVE' ELSE 'MODIFY' END AS event_name,
    '{{"o_orderkey":' || coalesce(n.o_orderkey, o.o_orderkey) || '}}' AS keys, {_image("o")} AS old_image, {_image("n")} AS new_image
    FROM orders o FULL JOIN (
      SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'F' ELSE o_orderstatus END AS o_orderstatus, o_custkey FROM orders WHERE o_orderkey NOT IN ({_RETURNED})
      UNION ALL SELECT -c_custkey - 1, 'N', NULL FROM customer) n ON o.o_orderkey = n.o_orderkey
    WHERE o.o_orderkey IS NULL OR n.o_orderkey IS NULL OR o.o_orderstatus <> n.o_orderstatus"""


@registered("str1_change_feed", _FEED)
def str1(spark, sf):
    return change_feed(_narrow(spark, sf), _changed(spark, sf))


@registered("str2_stream_enabled", _FEED)
def str2(spark, sf):
    """Two tables change, one of them has its stream switched on."""
    orders_changes = change_feed(_narrow(spark, sf), _changed(spark, sf))
    table = customers(spark, sf)
    poorer = W.update_items(table, read(spark, sf, "customer"), "ADD c_acctbal :v", values={":v": -1}).state
    config = spark.createDataFrame([("orders", "1"), ("customer", "0")], "tableName string, enabledStream string")
    changes = orders_changes.unionByName(change_feed(table, poorer))
    return stream_enabled(changes, config).select("table", "event_name", "keys", "old_image", "new_image")


@registered(
    "str3_mutation_stream",
    """WITH resets AS (SELECT user_id, max(event_id) AS at FROM events WHERE event_type = 'error' GROUP BY user_id),
            puts AS (SELECT e.* FROM events e LEFT JOIN resets r ON e.user_id = r.user_id WHERE e.event_type <> 'error' AND e.event_id > coalesce(r.at, -1))
       SELECT coalesce(c.c_custkey, p.user_id) AS c_custkey,
              CASE WHEN r.user_id IS NULL THEN coalesce(p.event_type, c.c_mktsegment) ELSE p.event_type END AS c_mktsegment,
              CASE WHEN r.user_id IS NULL THEN coalesce(p.value, c.c_acctbal) ELSE p.value END AS c_acctbal
       FROM customer c
       FULL JOIN (SELECT user_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) FILTER (event_type = 'purchase') AS value FROM puts GROUP BY user_id) p
         ON c.c_custkey = p.user_id
       LEFT JOIN resets r ON r.user_id = c.c_custkey
       WHERE p.user_id IS NOT NULL OR r.user_id IS NULL""",
)
def str3(spark, sf):
    """Events as a stream of writes to the customers: an error deletes the item, everything else puts its kind, a purchase also its value."""
    root = scratch_dir(spark, "mutations")
    store = SnapshotStore(spark, root)
    store.commit({"customer": read(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")})
    log = MutationLog(store, "customer", ["c_custkey"])
    events = read(spark, sf, "events")
    stream = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    bought = F.col("event_type") == "purchase"
    requests = stream.select(
        F.col("user_id").alias("c_custkey"),
        F.col("event_type").alias("c_mktsegment"),
        F.col("value").alias("c_acctbal"),
        F.when(F.col("event_type") == "error", F.lit("delete")).otherwise(F.lit("put")).alias("op"),
        F.col("event_id").alias("seq"),
        F.when(bought, F.array(F.lit("c_mktsegment"), F.lit("c_acctbal"))).otherwise(F.array(F.lit("c_mktsegment"))).alias("_present"),
    )
    writer = apply_mutation_stream(requests, log, f"{root}/checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()
    return log.state()
