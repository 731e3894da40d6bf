"""Projections, filters, keyed reads, counts and pages."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions import codec
from ..functions.exprs import condition, predicate
from ..operators import read as R
from ..sources import schema
from ..table import Catalog, ItemTable
from .registry import catalog, conversations, customers, events, micros, orders, read, registered

# -- projection -------------------------------------------------------------------------------


@registered("prj1_project", "SELECT o_orderkey, o_orderstatus FROM orders")
def prj1(spark, sf):
    """Names resolved, unknown ones dropped, repeats collapsed."""
    return R.project(orders(spark, sf), "o_orderkey, #s, nothing, o_orderkey", {"#s": "o_orderstatus"})


@registered("prj2_project_with_keys", "SELECT user_id, epoch_us(ts) AS ts, event_type FROM events")
def prj2(spark, sf):
    df = R.project_with_keys(events(spark, sf), "event_type")
    return df.select("user_id", micros("ts").alias("ts"), "event_type")


@registered("prj3_all_columns", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def prj3(spark, sf):
    table = customers(spark, sf)
    return R.all_columns(table.with_df(table.df.withColumn("commit_timestamp", F.current_timestamp())))


@registered(
    "prj4_bind_names",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority <> '5-LOW'",
)
def prj4(spark, sf):
    return R.scan(
        orders(spark, sf),
        filter="#s = 'F' AND #p <> '5-LOW'",
        project="#t",
        names={"#s": "o_orderstatus", "#p": "o_orderpriority", "#t": "o_totalprice"},
    ).select("o_orderkey", "o_totalprice")


@registered(
    "prj5_bind_values",
    "SELECT o_orderkey FROM orders WHERE o_totalprice > 250000 AND o_totalprice < 300000.5 AND o_orderstatus = 'P'",
)
def prj5(spark, sf):
    values = {":v": 250000, ":v1": {"N": "300000.5"}, ":v10": {"S": "P"}}
    text = "o_totalprice > :v AND o_totalprice < :v1 AND o_orderstatus = :v10"
    return R.scan(orders(spark, sf), filter=text, project="o_orderkey", values=values)


# -- filters ----------------------------------------------------------------------------------


@registered(
    "flt1_key_condition",
    "SELECT user_id, event_id, epoch_us(ts) AS ts FROM events WHERE user_id = 7 AND ts >= TIMESTAMP '2024-01-10'",
)
def flt1(spark, sf):
    df = R.query(
        events(spark, sf),
        "user_id = :u AND ts >= :from",
        values={":u": 7, ":from": dt.datetime(2024, 1, 10)},
        project="event_id",
    )
    return df.select("user_id", "event_id", micros("ts").alias("ts"))


@registered(
    "flt2_filter",
    "SELECT event_id, value FROM events WHERE user_id = 3 AND event_type = 'purchase' AND value > 10",
)
def flt2(spark, sf):
    return R.query(
        events(spark, sf),
        "user_id = :u",
        "#t = :t AND #v > :min",
        names={"#t": "event_type", "#v": "value"},
        values={":u": 3, ":t": "purchase", ":min": 10},
        project="event_id, value",
    ).select("event_id", "value")


@registered(
    "flt3_comparisons",
    """SELECT o_orderkey FROM orders WHERE o_totalprice >= 100000 AND o_totalprice <= 400000 AND o_custkey < 1000
       AND o_orderkey > 10 AND o_orderstatus <> 'O' AND o_orderpriority = '2-HIGH'""",
)
def flt3(spark, sf):
    text = "o_totalprice >= :a AND o_totalprice <= :b AND o_custkey < :c AND o_orderkey > :d AND o_orderstatus <> :e AND o_orderpriority = :f"
    values = {":a": 100000, ":b": 400000, ":c": 1000, ":d": 10, ":e": "O", ":f": "2-HIGH"}
    return R.scan(orders(spark, sf), filter=text, values=values, project="o_orderkey")


@registered("flt4_word_operators", "SELECT o_orderkey FROM orders WHERE o_totalprice > 300000 AND o_custkey <= 700 AND o_orderstatus = 'F'")
def flt4(spark, sf):
    text = "o_totalprice GT :a AND o_custkey LE :b AND o_orderstatus EQ :c"
    return R.scan(orders(spark, sf), filter=text, values={":a": 300000, ":b": 700, ":c": "F"}, project="o_orderkey")


@registered("flt5_begins_with", "SELECT o_orderkey FROM orders WHERE starts_with(o_orderpriority, '1-') AND o_totalprice > 1000")
def flt5(spark, sf):
    text = "begins_with(o_orderpriority, :p) AND o_totalprice GT :v"
    return R.scan(orders(spark, sf), filter=text, values={":p": "1-", ":v": 1000}, project="o_orderkey")


@registered(
    "flt6_between",
    "SELECT o_orderkey FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1996-12-31'",
)
def flt6(spark, sf):
    values = {":a": dt.datetime(1996, 1, 1), ":b": dt.datetime(1996, 12, 31)}
    return R.scan(orders(spark, sf), filter="o_orderdate BETWEEN :a AND :b", values=values, project="o_orderkey")


@registered(
    "flt7_boolean",
    """SELECT o_orderkey FROM orders WHERE (o_orderstatus = 'F' OR o_orderstatus = 'P')
       AND NOT (o_totalprice < 50000 OR o_orderpriority = '5-LOW')""",
)
def flt7(spark, sf):
    text = "(o_orderstatus = :f OR o_orderstatus = :p) AND NOT (o_totalprice < :v OR o_orderpriority = :l)"
    values = {":f": "F", ":p": "P", ":v": 50000, ":l": "5-LOW"}
    return R.scan(orders(spark, sf), filter=text, values=values, project="o_orderkey")


@registered(
    "flt8_in",
    "SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus IN ('F', 'O')",
)
def flt8(spark, sf):
    text = "o_orderpriority IN (:a, :b) AND o_orderstatus IN :list"
    values = {":a": "1-URGENT", ":b": "2-HIGH", ":list": ["F", "O"]}
    return R.scan(orders(spark, sf), filter=text, values=values, project="o_orderkey")


@registered(
    "flt9_json_path",
    """SELECT event_id FROM events
       WHERE CAST(json_extract_string(props, '$.k') AS INTEGER) = 42 OR CAST(json_extract_string(props, '$.k') AS INTEGER) > 90""",
)
def flt9(spark, sf):
    return R.scan(
        events(spark, sf), filter="#p.k = :a OR #p.k > :b", names={"#p": "props"}, values={":a": 42, ":b": 90}, project="event_id"
    ).select("event_id")


@registered("flt10_sort_key_present", "SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P'")
def flt10(spark, sf):
    """Items without the sort key are no part of a query."""
    df = read(spark, sf, "orders").withColumn("shipped", F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")))
    return R.scan(ItemTable("orders", df, "o_orderkey", "shipped"), project="o_orderkey").select("o_orderkey")


@registered(
    "flt11_attribute_exists",
    "SELECT event_id FROM events WHERE event_type = 'purchase' OR event_type = 'error'",
)
def flt11(spark, sf):
    df = read(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_type") == "purchase", F.col("value")).alias("amount"),
        F.when(F.col("event_type") != "error", F.col("props")).alias("props"),
    )
    return df.where(condition("attribute_exists(amount) OR attribute_not_exists(#p)", {"#p": "props"})).select("event_id")


@registered("flt12_size", "SELECT doc_id FROM documents WHERE len(string_split(text, ' ')) > 100")
def flt12(spark, sf):
    df = read(spark, sf, "documents").select("doc_id", F.split("text", " ").alias("words"))
    return df.where(condition("size(words) > :n", values={":n": 100})).select("doc_id")


@registered(
    "flt13_condition",
    """SELECT o_orderkey, coalesce((o_totalprice > 200000 AND o_orderstatus <> 'O') OR
              (CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END) < 100, false) AS holds FROM orders""",
)
def flt13(spark, sf):
    df = read(spark, sf, "orders").withColumn(
        "owner", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey"))
    )
    holds = condition("(o_totalprice > :v and o_orderstatus <> :s) or owner < :c", values={":v": 200000, ":s": "O", ":c": 100})
    return df.select("o_orderkey", holds.alias("holds"))


@registered(
    "flt14_text_operators",
    """SELECT doc_id FROM documents WHERE contains(text, 'the') AND NOT starts_with(text, 'the')
       AND NOT ends_with(text, 'the') AND regexp_matches(lang, '^(en|de)$')""",
)
def flt14(spark, sf):
    text = "text contains :t AND NOT text startsWith :t AND NOT text endsWith :t AND lang matches :l"
    return read(spark, sf, "documents").where(predicate(text, values={":t": "the", ":l": "^(en|de)$"})).select("doc_id")


# -- keyed reads ------------------------------------------------------------------------------


@registered("src5_scan_filter", "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_totalprice > 450000")
def src5(spark, sf):
    return R.scan(
        orders(spark, sf), filter="o_totalprice > :v", values={":v": 450000}, project="o_totalprice, o_orderstatus"
    ).select("o_orderkey", "o_totalprice", "o_orderstatus")


@registered("src1_register_table", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus")
def src1(spark, sf):
    """A table with a dash in its name, read through an alias."""
    found = catalog(spark, sf)
    found.register_table("all-orders", read(spark, sf, "orders"), "o_orderkey")
    found.register_table("orders-by-alias", alias_of="all-orders")
    rows = found.table("orders-by-alias").df
    return rows.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@registered(
    "src1_from_metadata",
    "SELECT c_mktsegment, count(*) AS n, CAST(sum(CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END) AS BIGINT) AS in_credit FROM customer GROUP BY c_mktsegment",
)
def src1_metadata(spark, sf):
    """Customers registered as the metadata rows found in their items say, under an alias."""
    df = read(spark, sf, "customer").withColumnRenamed("c_acctbal", "c_acct.bal")
    rows = schema.schema_metadata(schema.infer_item_schema(codec.encode_items(df)), "cust-omer", "c_custkey")
    alias = rows.withColumn("tableName", F.lit("buyers"))
    found = Catalog(spark)
    schema.register_from_metadata(found, rows.union(alias), {"cust-omer": df})
    rows = found.table("buyers").df
    in_credit = F.sum((F.col("c_acct_bal") > 0).cast("int")).alias("in_credit")
    return rows.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"), in_credit)


@registered("joi1_get_item", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey = 42")
def joi1(spark, sf):
    return R.get_item(orders(spark, sf), {"o_orderkey": {"N": "42"}}, "o_orderkey, o_custkey, o_totalprice")


@registered(
    "joi2_batch_get",
    """SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
       WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')""",
)
def joi2(spark, sf):
    keys = read(spark, sf, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return R.batch_get(orders(spark, sf), keys, "o_orderkey, o_orderstatus, o_totalprice")


@registered(
    "joi3_batch_get_many",
    """SELECT 'orders' AS tab, o_orderkey AS id, o_orderstatus AS what FROM orders
       WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity >= 50)
       UNION ALL SELECT 'customer', c_custkey, c_mktsegment FROM customer
       WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)""",
)
def joi3(spark, sf):
    order_keys = read(spark, sf, "lineitem").where("l_quantity >= 50").select(F.col("l_orderkey").alias("o_orderkey"))
    customer_keys = read(spark, sf, "orders").where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    got = R.batch_get_many(catalog(spark, sf), {"orders": order_keys, "customer": customer_keys})
    first = got["orders"].select(F.lit("orders").alias("tab"), F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("what"))
    return first.union(got["customer"].select(F.lit("customer"), "c_custkey", "c_mktsegment"))


@registered(
    "joi4_transact_get",
    """SELECT 'orders' AS "table", '{"o_orderkey":{"N":"' || o_orderkey || '"},"o_orderstatus":{"S":"' || o_orderstatus || '"}}' AS item
       FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'A' AND l_discount > 0.08)
       UNION ALL
       SELECT 'customer', '{"c_name":{"S":"' || c_name || '"}}' FROM customer
       WHERE c_custkey IN (SELECT user_id FROM events)""",
)
def joi4(spark, sf):
    order_keys = (
        read(spark, sf, "lineitem")
        .where("l_returnflag = 'A' AND l_discount > 0.08")
        .select(F.col("l_orderkey").alias("o_orderkey"))
    )
    customer_keys = read(spark, sf, "events").select(F.col("user_id").alias("c_custkey"))
    return R.transact_get(
        catalog(spark, sf),
        [R.GetRequest("orders", order_keys, "o_orderkey, o_orderstatus"), R.GetRequest("customer", customer_keys, "c_name")],
    )


@registered(
    "joi5_missing_keys",
    "SELECT DISTINCT l_partkey AS s_suppkey FROM lineitem WHERE l_partkey NOT IN (SELECT s_suppkey FROM supplier)",
)
def joi5(spark, sf):
    table = ItemTable("supplier", read(spark, sf, "supplier"), "s_suppkey")
    return R.missing_keys(table, read(spark, sf, "lineitem").select(F.col("l_partkey").alias("s_suppkey")))


# -- counts -----------------------------------------------------------------------------------


@registered("agg1_count", "SELECT count(*) AS count FROM events WHERE event_type = 'purchase' AND value > 5")
def agg1(spark, sf):
    return R.scan(
        events(spark, sf), filter="event_type = :t AND value > :v", values={":t": "purchase", ":v": 5}, count=True, limit=3
    )


@registered("agg2_count_by_partition", "SELECT user_id, count(*) AS count FROM events WHERE event_type <> 'view' GROUP BY user_id")
def agg2(spark, sf):
    return R.count_by_partition(events(spark, sf), "event_type <> :t", values={":t": "view"})


# -- pages ------------------------------------------------------------------------------------


@registered("pag1_order", "SELECT conv_id, turn, role FROM conversations WHERE role = 'user'")
def pag1(spark, sf):
    """Descending by sort key; the order itself is a unit test."""
    return R.query(
        conversations(spark, sf), filter="role = :r", values={":r": "user"}, project="conv_id, turn, role", ordered=True
    )


@registered(
    "pag2_limit",
    """SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase' ORDER BY ts DESC, user_id LIMIT 100""",
)
def pag2(spark, sf):
    return R.query(
        events(spark, sf), filter="event_type = :t", values={":t": "purchase"}, project="event_id, value", limit=100
    ).select("event_id", "user_id", "value")


@registered(
    "pag3_offset",
    """SELECT event_id, user_id FROM events WHERE event_type = 'click' ORDER BY ts, user_id LIMIT 50 OFFSET 120""",
)
def pag3(spark, sf):
    return R.query(
        events(spark, sf),
        filter="event_type = :t",
        values={":t": "click"},
        project="event_id",
        limit=50,
        start={"offset": {"N": "120"}},
        ascending=True,
    ).select("event_id", "user_id")


_USER_PAGE = dict(
    key_condition="user_id = :u", filter="#t <> :t", names={"#t": "event_type"}, values={":u": 8, ":t": "view"}, limit=10, start=5
)


@registered(
    "pag4_query_page",
    "SELECT event_id, event_type FROM events WHERE user_id = 8 AND event_type <> 'view' ORDER BY ts DESC LIMIT 10 OFFSET 5",
)
def pag4(spark, sf):
    return R.query_page(events(spark, sf), **_USER_PAGE).items.select("event_id", "event_type")


@registered(
    "pag4_last_key",
    """SELECT user_id, epoch_us(ts) AS ts, CAST(15 AS BIGINT) AS "offset" FROM
       (SELECT user_id, ts, row_number() OVER (ORDER BY ts DESC) AS rn, count(*) OVER () AS n
        FROM events WHERE user_id = 8 AND event_type <> 'view') WHERE rn = 15 AND n > 15""",
)
def pag4_key(spark, sf):
    last = R.query_page(events(spark, sf), **_USER_PAGE).last_key
    return last.select("user_id", micros("ts").alias("ts"), "offset")


@registered(
    "pag5_query_pages",
    """SELECT user_id, event_id, epoch_us(ts) AS ts, value, CAST(rn AS INTEGER) AS page_rank, n > 10 AS has_more,
              n > 10 AND rn = 10 AS is_last_key
       FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn,
                    count(*) OVER (PARTITION BY user_id) AS n FROM events WHERE event_type = 'purchase')
       WHERE rn <= 10""",
)
def pag5(spark, sf):
    """The ten newest purchases of every user, with the key that the next page of the user starts from."""
    pages = R.query_pages(
        events(spark, sf), 10, filter="#t = :t", names={"#t": "event_type"}, values={":t": "purchase"}, project="event_id, value"
    )
    return pages.select("user_id", "event_id", micros("ts").alias("ts"), "value", "page_rank", "has_more", "is_last_key")


@registered(
    "pag5_query_pages_after",
    """WITH starts AS (SELECT user_id, max(ts) AS after FROM events WHERE event_type = 'error' GROUP BY user_id)
       SELECT user_id, event_id, CAST(rn AS INTEGER) AS page_rank, n > 5 AS has_more FROM
       (SELECT e.*, row_number() OVER (PARTITION BY e.user_id ORDER BY e.ts DESC) AS rn, count(*) OVER (PARTITION BY e.user_id) AS n
        FROM events e JOIN starts s ON e.user_id = s.user_id AND e.ts < s.after) WHERE rn <= 5""",
)
def pag5_after(spark, sf):
    """What came before the newest error of each user."""
    errors = read(spark, sf, "events").where("event_type = 'error'").select("user_id", F.col("ts").alias("after"))
    pages = R.query_pages(events(spark, sf), 5, keys=errors, project="event_id")
    return pages.select("user_id", "event_id", "page_rank", "has_more")


@registered(
    "pag6_query_index",
    """SELECT o_custkey, o_orderkey, epoch_us(o_orderdate) AS o_orderdate, o_totalprice FROM orders
       WHERE o_custkey = 77 AND o_orderdate BETWEEN TIMESTAMP '1995-06-01' AND TIMESTAMP '2000-12-31'""",
)
def pag6(spark, sf):
    df = R.query_index(
        orders(spark, sf),
        "by_customer",
        key_condition="o_custkey = :c AND o_orderdate BETWEEN :a AND :b",
        values={":c": 77, ":a": dt.datetime(1995, 6, 1), ":b": dt.datetime(2000, 12, 31)},
        project="o_totalprice",
    )
    return df.select("o_custkey", "o_orderkey", micros("o_orderdate").alias("o_orderdate"), "o_totalprice")


@registered(
    "pag6_index_pages",
    """SELECT o_custkey, o_orderkey, CAST(rn AS INTEGER) AS page_rank FROM
       (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn FROM orders)
       WHERE rn <= 3""",
)
def pag6_pages(spark, sf):
    """Three newest orders of every customer, through the index."""
    pages = R.query_pages(orders(spark, sf), 3, index="by_customer", project="o_totalprice")
    return pages.select("o_custkey", "o_orderkey", "page_rank")


@registered(
    "pag7_keyset_page",
    """SELECT user_id, event_id, epoch_us(ts) AS ts FROM events
       WHERE ts < TIMESTAMP '2024-01-04 12:00:00' OR (ts = TIMESTAMP '2024-01-04 12:00:00' AND user_id > 3)
       ORDER BY ts DESC, user_id LIMIT 40""",
)
def pag7(spark, sf):
    df = R.keyset_page(events(spark, sf), {"ts": dt.datetime(2024, 1, 4, 12), "user_id": 3}, 40, project="event_id")
    return df.select("user_id", "event_id", micros("ts").alias("ts"))
