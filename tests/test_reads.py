import datetime as dt

import pytest
from pyspark.sql import functions as F

from itemloom import (
    GetRequest,
    ItemTable,
    TableNotFound,
    ValidationError,
    batch_get,
    batch_get_many,
    bind,
    bind_names,
    condition,
    count_items,
    get_item,
    json_path,
    keyset_page,
    missing_keys,
    project,
    project_with_keys,
    query,
    query_index,
    query_page,
    query_pages,
    scan,
    transact_get,
)
from itemloom.operators.read import first_per_partition


def ids(df, name="ship_id"):
    return [r[name] for r in df.collect()]


# -- names and values -------------------------------------------------------------------------


def test_names_and_values_are_whole_tokens():
    text = bind("#a = :v AND #ab = :v1", {"#a": "x", "#ab": "y-z"}, {":v": 1, ":v1": "q"})
    assert text == "`x` = 1L AND `y-z` = 'q'"


def test_unbound_is_an_error():
    with pytest.raises(ValidationError):
        bind("a = :missing")
    with pytest.raises(ValidationError):
        bind_names("#missing = 1")


def test_text_in_quotes_is_left_alone():
    assert bind("a = ':v #n EQ size(x)' AND b EQ 1", {}, {}) == "a = ':v #n EQ size(x)' AND b = 1"


def test_values_cannot_break_out_of_their_literal(spark):
    nasty = "x' OR '1'='1 \\ \" ` ü"
    df = spark.createDataFrame([(nasty,), ("x",)], "s string")
    assert df.where(F.expr(bind("s = :v", values={":v": nasty}))).count() == 1


def test_word_operators_work_next_to_begins_with():
    assert bind("begins_with(name, :p) AND age GE 20", {}, {":p": "a"}) == "startswith(name, 'a') AND age >= 20"


@pytest.mark.parametrize(
    "text, expected",
    [
        ("tonnage > :v", [301.0, 303.0, 306.0]),
        ("tonnage GT :v AND attribute_exists(harbour)", [301.0, 306.0]),
        ("size(callsigns) >= 2", [301.0, 303.0, 306.0]),
        ("title startsWith :s or owner endsWith :e", [301.0, 304.0, 306.0]),
        ("owner matches '^[BD]'", [302.0, 304.0]),
        ("harbour contains 'or'", [304.0, 305.0]),
        ("ship_id in :list", [302.0, 305.0]),
        ("NOT (tonnage <= :v OR title = 'Nordlys')", [301.0, 303.0]),
        ("tonnage <> 640 and tonnage = 640", []),
        ("array_contains(dues, 45)", [302.0]),
    ],
)
def test_conditions(catalog, text, expected):
    values = {":v": {"N": "2300"}, ":s": "A", ":e": "Lines", ":list": [302, 305]}
    df = catalog.table("ship").df.where(condition(text, values=values)).orderBy("ship_id")
    assert ids(df) == expected


def test_unknown_condition_fails(catalog):
    df = catalog.table("harbour").df
    rows = df.select("pier", condition("h_name <> 'x'").alias("ok")).orderBy("pier").collect()
    assert [r["ok"] for r in rows] == [True, False, True]


def test_paths_into_documents(catalog):
    table = catalog.table("depots")
    for text, values in [
        ("layout.gate.lock.brand = :v", {":v": "Abus"}),
        ("layout.gate.lock.pins > :v", {":v": 8}),
        ("#l.#g.side = :v AND layout.open = false", {":v": "north"}),
    ]:
        assert scan(table, filter=text, names={"#l": "layout", "#g": "gate"}, values=values).count() == 2
    assert scan(table, filter="layout.gate.none = :v", values={":v": "x"}).count() == 0
    got = table.df.select(json_path("layout", "gate.lock.pins", "int", variant=True).alias("n")).first()
    assert got["n"] == 9


def test_size_of_a_document_list(catalog):
    table = catalog.table("box")
    got = scan(table, filter="size(goods) > :n", values={":n": 3})
    assert ids(got, "box") == ["b2"]


# -- projections ------------------------------------------------------------------------------


def test_projection(catalog):
    table = catalog.table("ship")
    got = project(table, "ship_id, harbour, callsigns, dues")
    assert got.columns == ["ship_id", "harbour", "callsigns", "dues"]
    assert project(table, "#who, harbour").columns == ["harbour"]
    assert project(table, "#a, #b, harbour", {"#a": "harbour", "#b": "tonnage"}).columns == ["harbour", "tonnage"]
    assert len(project(table).columns) == 8
    assert project_with_keys(table, "tonnage").columns == ["tonnage", "ship_id"]


def test_timestamp_column_of_the_store_is_hidden(spark):
    df = spark.range(1).withColumn("commit_timestamp", F.current_timestamp())
    assert project(ItemTable("t", df, "id")).columns == ["id"]


# -- keyed reads ------------------------------------------------------------------------------


def test_get(catalog):
    table = catalog.table("ship")
    row = get_item(table, {"ship_id": {"N": "304"}}, "ship_id, dues").first()
    assert row.asDict() == {"ship_id": 304.0, "dues": [5.5, 6.5]}
    assert get_item(table, {"ship_id": 99}).count() == 0
    with pytest.raises(ValidationError):
        get_item(table, {})
    assert get_item(catalog.table("harbour"), {"pier": 12}).first()["h_name"] is None


def test_batch_get(spark, catalog):
    table = catalog.table("ship")
    keys = spark.createDataFrame([(306.0,), (302.0,), (302.0,), (77.0,)], "ship_id double")
    assert sorted(ids(batch_get(table, keys))) == [302.0, 306.0]
    assert batch_get(table, keys.limit(0)).count() == 0
    assert ids(missing_keys(table, keys)) == [77.0]
    both = batch_get_many(catalog, {"ship": keys, "harbour": spark.createDataFrame([(13.0,)], "pier double")})
    assert {n: df.count() for n, df in both.items()} == {"ship": 2, "harbour": 1}
    with pytest.raises(TableNotFound):
        batch_get_many(catalog, {"nowhere": keys})


def test_transact_get_keeps_every_key(spark, catalog):
    keys = spark.createDataFrame([(302.0,), (304.0,)], "ship_id double")
    rows = transact_get(
        catalog,
        [
            GetRequest("ship", keys, "ship_id, dues"),
            GetRequest("harbour", spark.createDataFrame([(12.0,), (99.0,)], "pier double"), "pier, h_name"),
        ],
    ).collect()
    assert sorted((r["table"], r["item"]) for r in rows) == [
        ("harbour", '{"pier":{"N":"12"},"h_name":{"NULL":true}}'),
        ("ship", '{"ship_id":{"N":"302"},"dues":{"NS":["45"]}}'),
        ("ship", '{"ship_id":{"N":"304"},"dues":{"NS":["5.5","6.5"]}}'),
    ]


def test_table_names(catalog, spark):
    assert catalog.table("visit_log").name == "visit_log"
    catalog.register_table("old-name", alias_of="ship")
    catalog.register_table("older", alias_of="old-name")
    assert catalog.table("old_name").partition_key == catalog.table("older").partition_key == "ship_id"
    with pytest.raises(TableNotFound):
        catalog.table("unknown")
    with pytest.raises(ValidationError):
        catalog.register_table("bad", spark.range(1), "no_such_key")


# -- query and pages --------------------------------------------------------------------------


def test_query_needs_bound_values(catalog):
    table = catalog.table("ship")
    got = query(table, "ship_id = :id", "owner = :o", values={":id": 303, ":o": "Okeanos"})
    assert got.count() == 1
    with pytest.raises(ValidationError):
        query(table, "ship_id = :id", "owner = :o", values={":id": 303})


def test_count_ignores_limit_and_projection(catalog):
    table = catalog.table("ship")
    assert scan(table, count=True, limit=3, project="tonnage").first()["count"] == 6
    assert count_items(table, filter="tonnage > :v", values={":v": 880}).first()["count"] == 4


def test_newest_first_unless_asked(catalog):
    table = catalog.table("visit-log")
    got = query(table, "uid = :u", values={":u": "u1"}, limit=3)
    assert ids(got, "at") == [9, 8, 7]
    got = query(table, "uid = :u", values={":u": "u1"}, limit=3, ascending=True, start={"offset": 2})
    assert ids(got, "at") == [2, 3, 4]
    assert ids(query(table, ordered=True), "at") == sorted(ids(query(table), "at"), reverse=True)


def test_items_without_sort_key_are_left_out(catalog):
    assert scan(catalog.table("visit-log")).where("uid = 'u3'").count() == 0


def test_scan_pages_of_a_table_without_sort_key(catalog):
    table = catalog.table("ship")
    assert ids(scan(table, limit=4)) == [301.0, 302.0, 303.0, 304.0]
    assert ids(scan(table, limit=4, start=4)) == [305.0, 306.0]


def test_start_is_an_offset_number_only(catalog):
    table = catalog.table("ship")
    every = [301.0, 302.0, 303.0, 304.0, 305.0, 306.0]
    assert ids(scan(table, limit=9, start={"offset": "2"})) == ids(scan(table, limit=9, start={"ship_id": 3})) == every


def test_pages_join_to_the_whole_query(catalog):
    table = catalog.table("visit-log")
    seen, start = [], 0
    while True:
        page = query_page(table, "uid = :u", values={":u": "u1"}, limit=4, start=start)
        seen += ids(page.items, "what")
        last = page.last_key.collect()
        if not last:
            break
        assert (last[0]["uid"], last[0]["at"]) == ("u1", page.items.collect()[-1]["at"])
        start = last[0]["offset"]
    assert seen == [f"e{i}" for i in reversed(range(10))]
    whole = query_page(table, "uid = :u", values={":u": "u1"}, limit=10)
    assert whole.last_key.count() == 0 and whole.count.first()["count"] == 10


def test_keyset_pages_join_to_the_whole_query(catalog):
    table = catalog.table("visit-log")
    for ascending in (False, True):
        seen, after = [], None
        while rows := keyset_page(table, after, 4, ascending).collect():
            seen += [(r["at"], r["uid"]) for r in rows]
            after = rows[-1].asDict()
        whole = query(table, ordered=True, ascending=ascending).collect()
        assert seen == [(r["at"], r["uid"]) for r in whole] and len(seen) == 13


def test_index(catalog):
    table = catalog.table("visit-log")
    got = query_index(table, "by_score", key_condition="score = :s", values={":s": 1}, project="score", limit=2)
    assert got.columns == ["score", "what", "uid", "at"]
    assert ids(got, "what") == ["f2", "f1"]
    assert set(query_index(table, "thin").columns) == {"score", "at", "uid"}
    with pytest.raises(ValidationError):
        query_index(table, "nope")


def test_pages_of_many_partitions(spark, catalog):
    table = catalog.table("visit-log")
    pages = query_pages(table, 3, project="what")
    rows = sorted((r["uid"], r["page_rank"], r["what"], r["has_more"], r["is_last_key"]) for r in pages.collect())
    assert rows == [
        ("u1", 1, "e9", True, False),
        ("u1", 2, "e8", True, False),
        ("u1", 3, "e7", True, True),
        ("u2", 1, "f2", False, False),
        ("u2", 2, "f1", False, False),
        ("u2", 3, "f0", False, False),
    ]
    keys = spark.createDataFrame([("u1",), ("u1",), ("u9",)], "uid string")
    assert {r["uid"] for r in query_pages(table, 3, keys).collect()} == {"u1"}


@pytest.mark.parametrize("ascending", [False, True])
def test_pages_behind_a_start_per_partition(spark, catalog, shuffled, ascending):
    table = catalog.table("visit-log")
    keys = spark.createDataFrame([("u1", 4), ("u2", None)], "uid string, after int")
    got = query_pages(table, 2, keys, ascending=ascending).collect()
    want = {"u1": [5, 6], "u2": [0, 1]} if ascending else {"u1": [3, 2], "u2": [2, 1]}
    for uid, order in want.items():
        assert [r["at"] for r in sorted(got, key=lambda r: r["page_rank"]) if r["uid"] == uid] == order


def test_large_pages_of_a_hot_key(spark):
    """A third of all rows under one key, and pages beyond what Spark cuts by itself."""
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"), F.col("id").alias("v")
    )
    got = first_per_partition(df, "k", [F.col("v").desc()], 1500, "n")
    rows = got.where("k = 'hot'").orderBy("n").collect()
    assert [r["v"] for r in rows] == [8997 - 3 * i for i in range(1500)]
    assert [r["n"] for r in rows] == list(range(1, 1501))
    assert got.where("k <> 'hot'").count() == 6000


def test_many_keys_meet_a_hot_partition_in_slices(spark, shuffled):
    df = spark.range(6000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 40).cast("int").alias("k"), "id")
    table = ItemTable("t", df, "k", "id")
    got = query_pages(table, 5, keys=spark.range(20).select(F.col("id").cast("int").alias("k")))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "__slice" in plan
    assert {r["k"] for r in got.collect()} == set(range(20))
    of_hot_key = [i for i in range(6000) if i % 3 == 0 or i % 40 == 0]
    assert sorted(r["id"] for r in got.where("k = 0").collect()) == of_hot_key[-5:]


def test_timestamps_bind(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2),)], "ts timestamp")
    assert df.where(F.expr(bind("ts = :t", values={":t": dt.datetime(2024, 1, 2)}))).count() == 1


def test_a_page_by_one_sorted_read(spark, catalog):
    table, start, seen = catalog.table("visit-log"), None, []
    while True:
        page = query_page(table, "uid = :u", values={":u": "u1"}, limit=4, start=start, project="what")
        items, start = page.fetch()
        assert [tuple(r) for r in items] == [tuple(r) for r in page.items.collect()]
        assert [start] == [r.asDict() for r in page.last_key.collect()] or (start is None and page.last_key.isEmpty())
        seen += [r["at"] for r in items]
        if start is None:
            break
    assert seen == list(range(9, -1, -1))
    plan = page.top._jdf.queryExecution().executedPlan().toString()
    assert plan.count("TakeOrderedAndProject") + plan.count("Sort ") == 1
