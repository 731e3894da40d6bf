"""Queries on stored tables (buckets, levels of change sets, numbered change records) and on values that do not fit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import codec
from ..operators import statements as S
from ..operators import write as W
from ..operators.read import batch_get_many, query, query_index
from ..session import scratch_dir
from ..sources import schema
from ..sources.snapshots import SnapshotStore
from ..streaming.changes import change_feed, changes_between, sequenced
from ..streaming.mutations import MutationLog
from ..table import Catalog, Index, ItemTable
from .registry import SQL, read, registered
from .writes import _FEED, _changed, _narrow

# -- buckets ------------------------------------------------------------------------------------

BUCKETS = 16


def _stored(spark, sf, label: str) -> SnapshotStore:
    """Orders in buckets, version 1; version 2 raises the price of the orders of one customer in a hundred and drops the returned ones of those."""
    store = SnapshotStore(spark, scratch_dir(spark, label))
    table = ItemTable("orders", read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"), "o_orderkey")
    store.commit({"orders": table}, buckets=BUCKETS)
    asked = table.df.where("o_custkey % 100 = 7").select("o_orderkey", "o_orderstatus")

    def change(part: ItemTable) -> DataFrame:
        raised = W.update_items(part, asked.select("o_orderkey"), "SET o_totalprice = o_totalprice + :d", values={":d": 1})
        return W.delete_items(raised.table_after, asked.where("o_orderstatus = 'F'")).state

    store.change("orders", asked, change)
    return store


@registered(
    "sink1_bucketed_commit",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + CASE WHEN o_custkey % 100 = 7 THEN 1 ELSE 0 END AS o_totalprice
       FROM orders WHERE NOT (o_custkey % 100 = 7 AND o_orderstatus = 'F')""",
)
def sink1_bucketed(spark, sf):
    """A change rewrites the buckets of its keys; old versions are vacuumed."""
    store = _stored(spark, sf, "buckets")
    store.vacuum()
    return store.read("orders")


@registered(
    "agg1_stored_count",
    """SELECT version, n FROM (SELECT 1 AS version, count(*) AS n FROM orders
       UNION ALL SELECT 2, count(*) FROM orders WHERE NOT (o_custkey % 100 = 7 AND o_orderstatus = 'F'))""",
)
def agg1_stored(spark, sf):
    """Counts of two versions as their manifests know them."""
    store = _stored(spark, sf, "buckets")
    rows = [(v, store.count("orders", v)) for v in store.versions()]
    return spark.createDataFrame(rows, "version int, n long")


@registered("joi2_stored_lookup", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey IN (SELECT max(o_orderkey) FROM orders)")
def joi2_stored(spark, sf):
    """A batch get that opens the buckets of its keys only, at the first of two versions."""
    store = _stored(spark, sf, "buckets")
    asked = read(spark, sf, "orders").agg(F.max("o_orderkey").cast("string").alias("o_orderkey"))
    part = store.lookup("orders", asked, 1)
    return part.df.join(asked.select(F.col("o_orderkey").cast("long").alias("k")), F.col("o_orderkey") == F.col("k"), "left_semi")


@registered(
    "pag6_stored_index",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM (
         SELECT o_orderkey, CASE WHEN o_custkey % 100 = 7 THEN o_custkey + 1 ELSE o_custkey END AS o_custkey, o_totalprice
         FROM orders WHERE NOT (o_custkey % 100 = 7 AND o_orderstatus = 'F'))
       WHERE o_custkey = (SELECT min(o_custkey) + 1 FROM orders WHERE o_custkey % 100 = 7)
       ORDER BY o_totalprice DESC, o_orderkey DESC LIMIT 20""",
)
def pag6_stored(spark, sf):
    """An index stored with its table: orders of some customers move to the next one or go, and a page of one customer opens one bucket."""
    store = SnapshotStore(spark, scratch_dir(spark, "indexed"))
    df = read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    by_customer = Index("o_custkey", "o_totalprice", include=())
    store.commit({"orders": ItemTable("orders", df, "o_orderkey", indexes={"by_customer": by_customer})}, buckets=BUCKETS)
    asked = df.where("o_custkey % 100 = 7")

    def change(part: ItemTable) -> DataFrame:
        moved = W.update_items(part, asked.select("o_orderkey"), "SET o_custkey = o_custkey + :d", values={":d": 1})
        return W.delete_items(moved.table_after, asked.where("o_orderstatus = 'F'").select("o_orderkey")).state

    store.change("orders", asked, change)
    wanted = asked.agg((F.min("o_custkey") + 1).alias("o_custkey"))
    key = wanted.first()[0]
    return query(store.index_table("orders", "by_customer", wanted), "o_custkey = :c", values={":c": key}, limit=20, project="o_orderkey, o_custkey, o_totalprice")


@registered(
    "joi4_pinned",
    """SELECT o_orderkey, o_totalprice, c_name FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_custkey % 50 = 7""",
)
def joi4_pinned(spark, sf):
    """Two tables of one version, read after a later commit has changed both."""
    store = SnapshotStore(spark, scratch_dir(spark, "pinned"))
    orders = ItemTable("orders", read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), "o_orderkey")
    customer = ItemTable("customer", read(spark, sf, "customer").select("c_custkey", "c_name"), "c_custkey")
    first = store.commit({"orders": orders, "customer": customer}, buckets=4)
    asked = orders.df.where("o_custkey % 50 = 7")
    store.change("orders", asked, lambda part: W.delete_items(part, asked.select("o_orderkey")).state)
    store.commit({"customer": customer.with_df(customer.df.withColumn("c_name", F.lit("gone")))})
    pinned = store.catalog(first)
    keys = asked.select("o_orderkey", "o_custkey")
    found = batch_get_many(pinned, {"orders": keys.select("o_orderkey"), "customer": keys.select(F.col("o_custkey").alias("c_custkey"))})
    return found["orders"].join(found["customer"], F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "o_totalprice", "c_name")


@registered(
    "src8_readded",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 3 THEN 'new' END AS o_orderstatus, o_totalprice FROM orders""",
)
def src8_readded(spark, sf):
    """An attribute dropped from a stored table and added again: old values stay away, and only a later change writes files."""
    store = SnapshotStore(spark, scratch_dir(spark, "evolved"))
    table = ItemTable("orders", read(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), "o_orderkey")
    store.commit({"orders": table}, buckets=4)
    diff = lambda change: spark.createDataFrame([("o_orderstatus", "S", change)], "attribute string, descriptor string, change string")
    store.evolve("orders", diff("drop"))
    store.evolve("orders", diff("add"))
    asked = table.df.where("o_orderkey % 10 = 3").select("o_orderkey")
    store.change("orders", asked, lambda part: W.update_items(part, asked, "SET o_orderstatus = :v", values={":v": "new"}).state)
    return store.read("orders").select("o_orderkey", "o_orderstatus", "o_totalprice")


@registered(
    "pag3_stored_offset",
    """SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey DESC
       LIMIT 50 OFFSET (SELECT count(*) * 2 // 3 FROM orders)""",
)
def pag3_stored(spark, sf):
    """A page deep into a table stored by price: the ranges before it are counted by the manifest, not read."""
    store = SnapshotStore(spark, scratch_dir(spark, "ranged"))
    table = ItemTable("orders", read(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey")
    store.commit_sorted(table, ["o_totalprice"], BUCKETS)
    return store.sorted_page("orders", store.count("orders") * 2 // 3, 50, ascending=False)


# -- change sets --------------------------------------------------------------------------------

BATCHES = 20


@registered("str3_levels", SQL["str3_mutation_stream"])
def str3_levels(spark, sf):
    """The events in twenty change sets over a bucketed table: sets are merged in levels, and compacted into their buckets half way."""
    store = SnapshotStore(spark, scratch_dir(spark, "levels"))
    table = ItemTable("customer", read(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal"), "c_custkey")
    store.commit({"customer": table}, buckets=BUCKETS)
    log = MutationLog(store, "customer", ["c_custkey"], fan=4)
    events = read(spark, sf, "events")
    carried = F.when(F.col("event_type") == "purchase", F.array(F.lit("c_mktsegment"), F.lit("c_acctbal"))).otherwise(F.array(F.lit("c_mktsegment")))
    requests = events.select(
        F.col("user_id").alias("c_custkey"),
        F.col("event_type").alias("c_mktsegment"),
        F.col("value").alias("c_acctbal"),
        F.when(F.col("event_type") == "error", F.lit("delete")).otherwise(F.lit("put")).alias("op"),
        F.col("event_id").alias("seq"),
        carried.alias("_present"),
    )
    low, high = events.agg(F.min("event_id"), F.max("event_id")).first()
    step = -(-(high - low + 1) // BATCHES)
    for k in range(BATCHES):
        log.append(requests.where(F.col("seq").between(low + k * step, low + (k + 1) * step - 1)), k)
        if k == BATCHES // 2:
            log.compact()
    return log.state()


# -- change records -----------------------------------------------------------------------------


@registered(
    "str1_sequence",
    f"""SELECT *, row_number() OVER (ORDER BY md5("table" || chr(31) || keys)) + 100 AS sequence,
               md5("table" || chr(31) || '7' || chr(31) || event_name || chr(31) || keys) AS event_id,
               CAST(7 AS BIGINT) AS version, CAST(1700000000000 AS BIGINT) AS created_at
        FROM ({_FEED})""",
)
def str1_sequence(spark, sf):
    return sequenced(change_feed(_narrow(spark, sf), _changed(spark, sf)), 7, 1_700_000_000_000, first=101)


@registered(
    "str1_between",
    """SELECT row_number() OVER (ORDER BY md5('orders' || chr(31) || '{"o_orderkey":' || o_orderkey || '}')) AS sequence,
              '{"o_orderkey":' || o_orderkey || '}' AS keys, CASE WHEN o_orderstatus = 'F' THEN 'REMOVE' ELSE 'MODIFY' END AS event_name,
              o_orderstatus = 'F' AS gone, CAST(2 AS BIGINT) AS version
       FROM orders WHERE o_custkey % 100 = 7""",
)
def str1_between(spark, sf):
    """Change records of two stored versions, from the buckets that differ."""
    found = changes_between(_stored(spark, sf, "buckets"), "orders", 1, 2)
    return found.select("sequence", "keys", "event_name", F.col("new_image").isNull().alias("gone"), "version")


# -- values that do not fit ---------------------------------------------------------------------


@registered(
    "mut1_key_digits",
    """SELECT c_custkey, c_nationkey, false AS refused FROM customer WHERE c_nationkey >= 5
       UNION ALL SELECT c_custkey, CASE c_nationkey WHEN 3 THEN 99 ELSE c_nationkey END, false FROM customer WHERE c_nationkey < 5
       UNION ALL SELECT CASE c_nationkey WHEN 1 THEN c_custkey END, NULL, true FROM customer WHERE c_nationkey IN (0, 1)""",
)
def mut1_digits(spark, sf):
    """Keys and values as texts: fine digits are refused at any place, zeros after the point are none, exponents count."""
    table = ItemTable("customer", read(spark, sf, "customer").select("c_custkey", "c_nationkey"), "c_custkey")
    kind = F.col("c_nationkey")
    key = F.col("c_custkey").cast("string")
    items = table.df.where("c_nationkey < 5").select(
        F.when(kind == 0, F.concat(key, F.lit(".00000000001"))).when(kind == 2, F.concat(key, F.lit(".000000000000"))).otherwise(key).alias("c_custkey"),
        F.when(kind == 1, F.lit("5.00000000001")).when(kind == 3, F.lit("9.9e1")).otherwise(kind.cast("string")).alias("c_nationkey"),
    )
    result = W.put_items(table, items)
    refused = result.failures.select("c_custkey", F.lit(None).cast(table.df.schema["c_nationkey"].dataType).alias("c_nationkey"), F.lit(True).alias("refused"))
    return result.state.withColumn("refused", F.lit(False)).unionByName(refused)


@registered(
    "upd12_fine_text",
    """SELECT c_custkey, c_nationkey + CASE c_nationkey % 4 WHEN 0 THEN 2 ELSE 0 END AS c_nationkey, c_nationkey % 4 IN (1, 2) AS refused
       FROM customer""",
)
def upd12_fine(spark, sf):
    """ADD on a whole number: addends with digits that it cannot hold are refused, texts and doubles alike."""
    table = ItemTable("customer", read(spark, sf, "customer").select("c_custkey", "c_nationkey"), "c_custkey")
    kind = F.col("c_nationkey") % 4
    text = F.when(kind == 0, "2.000").when(kind == 1, "0.00000000001").when(kind == 2, "1.00000000001").otherwise("0e5")
    result = W.update_items(table, table.df.select("c_custkey", text.alias("d")), "ADD c_nationkey :d", values={":d": F.col("d")}, unique=True)
    failed = result.failures.select(F.col("c_custkey").alias("k"), F.lit(True).alias("refused"))
    rows = result.state.join(failed, F.col("c_custkey") == F.col("k"), "left")
    return rows.select("c_custkey", F.col("c_nationkey").cast("long").alias("c_nationkey"), F.coalesce("refused", F.lit(False)).alias("refused"))


@registered(
    "stm3_fraction_refused",
    """SELECT c_custkey, CAST(c_nationkey AS BIGINT) AS c_nationkey, false AS refused FROM customer
       UNION ALL SELECT CASE c_nationkey % 2 WHEN 1 THEN -c_custkey - 1 END, NULL, true FROM customer WHERE c_nationkey < 2
       UNION ALL SELECT -c_custkey - 1, 4, false FROM customer WHERE c_nationkey = 2""",
)
def stm3_fraction(spark, sf):
    """INSERT … VALUE with literals: a fraction is refused for a whole number, be it a key or not."""
    table = ItemTable("customer", read(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").cast("long").alias("c_nationkey")), "c_custkey")
    kind, key = F.col("c_nationkey"), (-F.col("c_custkey") - 1).cast("string")
    rows = table.df.where("c_nationkey < 3").select(
        F.when(kind == 0, F.concat(key, F.lit(".5"))).otherwise(key).alias("c_custkey"),
        F.when(kind == 1, "3.5").otherwise("4.0").alias("c_nationkey"),
    )
    result = S.insert_value(table, rows, literals=True)
    refused = result.failures.select("c_custkey", F.lit(None).cast("long").alias("c_nationkey"), F.lit(True).alias("refused"))
    return result.state.withColumn("refused", F.lit(False)).unionByName(refused)


@registered(
    "stm4_misfit_refused",
    """SELECT c_custkey, CAST(CASE WHEN c_custkey % 2 = 0 THEN c_custkey / 2 ELSE c_nationkey END AS BIGINT) AS c_nationkey,
              CASE WHEN c_custkey % 2 = 0 THEN 'halved' ELSE c_mktsegment END AS c_mktsegment, c_custkey % 2 = 1 AS refused
       FROM customer""",
)
def stm4_misfit(spark, sf):
    """UPDATE with a value that fits half of the rows: the others are refused whole, and the next statement still works."""
    found = Catalog(spark)
    df = read(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").cast("long").alias("c_nationkey"), "c_mktsegment")
    found.register_table("customer", df, "c_custkey")
    result = S.execute_statement(found, "UPDATE customer SET c_nationkey = c_custkey / 2, c_mktsegment = 'halved'")
    S.execute_statement(found, "DELETE FROM customer WHERE c_custkey < ?", [-5])
    failed = result.failures.select(F.col("c_custkey").alias("k"), F.lit(True).alias("refused"))
    rows = found.table("customer").df.join(failed, F.col("c_custkey") == F.col("k"), "left")
    return rows.select("c_custkey", "c_nationkey", "c_mktsegment", F.coalesce("refused", F.lit(False)).alias("refused"))


@registered(
    "stm1_dashed_names",
    """SELECT n.n_name, count(*) AS n FROM customer c, nation n WHERE c.c_nationkey = n.n_nationkey AND n.n_name <> 'x, "c-d" y' GROUP BY n.n_name""",
)
def stm1_dashed(spark, sf):
    """A comma list of names with dashes."""
    found = Catalog(spark)
    found.register_table("cust-omer", read(spark, sf, "customer"), "c_custkey")
    found.register_table("na-tion", read(spark, sf, "nation"), "n_nationkey")
    text = """SELECT n.n_name, count(*) AS n FROM "cust-omer" c, "na-tion" n
              WHERE c.c_nationkey = n.n_nationkey AND n.n_name <> 'x, "na-tion" y' GROUP BY n.n_name"""
    return S.select(found, text)


@registered(
    "src1_index_from_metadata",
    """SELECT c_custkey, c_nationkey, c_acctbal FROM customer WHERE c_nationkey = 3 AND c_acctbal > 0
       QUALIFY row_number() OVER (ORDER BY c_acctbal DESC, c_custkey DESC) <= 20""",
)
def src1_index(spark, sf):
    """An index given back by metadata rows, and a page of it."""
    df = read(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    found = schema.infer_item_schema(codec.encode_items(df))
    rows = schema.schema_metadata(found, "customer", "c_custkey")
    index = schema.schema_metadata(found.where("attribute <> 'c_mktsegment'"), "by_nation", "c_nationkey", "c_acctbal", index="by_nation", actual_table="customer")
    catalog = Catalog(spark)
    schema.register_from_metadata(catalog, rows.union(index), {"customer": df})
    page = query_index(catalog.table("customer"), "by_nation", key_condition="c_nationkey = :n AND c_acctbal > :z", values={":n": 3, ":z": 0}, limit=20)
    return page.select(F.col("c_custkey").cast("long").alias("c_custkey"), F.col("c_nationkey").cast("long").alias("c_nationkey"), "c_acctbal")
