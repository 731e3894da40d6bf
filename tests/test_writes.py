import random
import re

import pytest
from pyspark.sql import functions as F

from itemloom import (
    Check,
    Delete,
    ItemTable,
    Put,
    TableNotFound,
    Update,
    ValidationError,
    batch_put,
    batch_write,
    batch_write_many,
    condition_check,
    delete_items,
    execute_statement,
    insert_value,
    last_write_wins,
    merge_images,
    put_items,
    select,
    transact_write,
    update_where,
)
from itemloom import Catalog
from itemloom.operators import write
from itemloom.operators.transact import transaction_failures
from itemloom.operators.write import apply_requests, as_requests, fold_requests


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(params=[True, False], ids=["requests travel", "both shuffled"])
def both(request, monkeypatch):
    """Either plan shape."""
    monkeypatch.setattr(write, "requests_travel", lambda items, requests: request.param)


@pytest.fixture
def table(spark):
    base = [("a", 1, "x", 1.0), ("a", 2, "y", None), ("b", 1, None, 3.0)]
    return ItemTable("t", spark.createDataFrame(base, "pk string, sk int, s string, n double"), "pk", "sk")


def test_put_merges_and_replaces(spark, table, both):
    items = spark.createDataFrame([("a", 2, 9.0), ("c", 1, 7.0)], "pk string, sk int, n double")
    assert rows(put_items(table, items).state) == [("a", 1, "x", 1.0), ("a", 2, "y", 9.0), ("b", 1, None, 3.0), ("c", 1, None, 7.0)]
    replaced = put_items(table, items, mode="replace").state
    assert rows(replaced) == [("a", 1, "x", 1.0), ("a", 2, None, 9.0), ("b", 1, None, 3.0), ("c", 1, None, 7.0)]


def test_put_of_present_attributes(spark, table, both):
    items = spark.createDataFrame(
        [("a", 1, None, None, ["n"]), ("a", 2, "z", None, ["s"])], "pk string, sk int, s string, n double, _present array<string>"
    )
    got = put_items(table, items).state
    assert rows(got) == [("a", 1, "x", None), ("a", 2, "z", None), ("b", 1, None, 3.0)]


def test_a_chain_of_writes_reads_its_table_once_per_step(spark, tmp_path, request):
    """Few requests against a stored table travel to it; what follows does not read it again and again."""
    spark.range(200000).select("id", (F.col("id") * 1.5).alias("n"), F.sha2(F.col("id").cast("string"), 256).alias("s")).write.parquet(
        str(tmp_path / "t")
    )
    base = spark.read.parquet(str(tmp_path / "t"))
    table = ItemTable("t", base, "id")
    items = spark.range(-1, 3, 2).select("id", F.lit(0.0).alias("n"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1m")
    request.addfinalizer(lambda: spark.conf.unset("spark.sql.autoBroadcastJoinThreshold"))
    first = put_items(table, items)
    plan = first.state._jdf.queryExecution().executedPlan().toString()
    assert "FullOuter" not in plan and "BroadcastHashJoin" in plan
    assert first.state.count() == 200001
    for _ in range(3):
        first = put_items(first.table_after, items)
    leaves = first.state._jdf.queryExecution().optimizedPlan().collectLeaves().size()
    assert leaves <= 20
    assert first.state.count() == 200001


def test_put_is_idempotent(spark, table, both):
    items = spark.createDataFrame([("a", 2, 9.0), ("c", 1, 7.0)], "pk string, sk int, n double")
    once = put_items(table, items)
    assert rows(put_items(once.table_after, items).state) == rows(once.state)


def test_delete_after_put_is_absent(spark, table, both):
    items = spark.createDataFrame([("c", 1, 7.0)], "pk string, sk int, n double")
    after = put_items(table, items).table_after
    assert rows(delete_items(after, items).state) == rows(table.df)
    with pytest.raises(ValidationError):
        delete_items(table, items.drop("sk"))


def test_conditions_and_images(spark, table, both):
    items = spark.createDataFrame([("a", 1, "new"), ("a", 2, "new"), ("c", 1, "new")], "pk string, sk int, s string")
    got = put_items(table, items, "n > :v OR attribute_not_exists(#p)", {"#p": "pk"}, {":v": 0})
    assert rows(got.state) == [("a", 1, "new", 1.0), ("a", 2, "y", None), ("b", 1, None, 3.0), ("c", 1, "new", None)]
    assert rows(got.failures) == [("a", 2, "ConditionalCheckFailedException")]
    assert rows(got.return_values("ALL_OLD")) == [("a", 1, "x", 1.0)]
    assert rows(got.return_values("ALL_NEW")) == [("a", 1, "new", 1.0), ("c", 1, "new", None)]
    assert rows(got.return_values("UPDATED_OLD")) == [("a", 1, "x")]
    assert rows(got.return_values("UPDATED_NEW")) == [("a", 1, "new"), ("c", 1, "new")]
    assert rows(got.return_values("NONE")) == []
    assert rows(got.return_values("whatever")) == rows(got.return_values("ALL_NEW"))


def test_conditional_delete(spark, table, both):
    keys = spark.createDataFrame([("a", 1), ("b", 1), ("z", 1)], "pk string, sk int")
    got = delete_items(table, keys, "n >= :v", values={":v": 3})
    assert rows(got.state) == [("a", 1, "x", 1.0), ("a", 2, "y", None)]
    assert rows(got.failures) == [("a", 1, "ConditionalCheckFailedException"), ("z", 1, "ConditionalCheckFailedException")]
    assert rows(got.return_values("ALL_OLD")) == [("b", 1, None, 3.0)]


def test_put_order(spark, table):
    items = spark.createDataFrame(
        [("a", 1, 1, "p", None, ["s"]), ("a", 1, 2, None, 5.0, ["n"]), ("a", 1, 3, "r", None, ["s"])],
        "pk string, sk int, at int, s string, n double, _present array<string>",
    )
    got = last_write_wins(items, ["pk", "sk"], "at")
    assert rows(got) == [("a", 1, "r", 5.0, ["s", "n"])]
    assert rows(batch_put(table, items, seq="at").state)[0] == ("a", 1, "r", 5.0)


def test_repeated_puts_without_order_are_refused(spark, table):
    items = spark.createDataFrame([("a", 1, "p"), ("a", 1, "q"), ("b", 1, "r"), ("b", None, "s")], "pk string, sk int, s string")
    got = put_items(table, items)
    assert rows(got.state) == [("a", 1, "x", 1.0), ("a", 2, "y", None), ("b", 1, "r", 3.0)]
    assert {r["code"] for r in got.failures.collect()} == {"ValidationException"} and got.failures.count() == 2


def test_merge_images(spark):
    old = spark.createDataFrame([("a", 1, 2)], "k string, x int, y int")
    new = spark.createDataFrame([("a", 9), ("b", 8)], "k string, y int")
    assert rows(merge_images(old, new, ["k"])) == [("a", 1, 9), ("b", None, 8)]


# -- batches ----------------------------------------------------------------------------------


def sequential(base, requests, attributes):
    """The same requests one after the other, in plain Python."""
    state = {k: dict(v) for k, v in base.items()}
    for key, op, values in requests:
        if op == "delete":
            state.pop(key, None)
        else:
            state.setdefault(key, {a: None for a in attributes}).update(values)
    return state


@pytest.mark.parametrize("seed", range(4))
def test_folded_requests_equal_requests_in_order(spark, seed):
    random_ = random.Random(seed)
    base = {k: {"s": f"s{k}", "n": float(k)} for k in range(4)}
    requests = []
    for at in range(60):
        key = 0 if random_.random() < 0.33 else random_.randrange(8)
        if random_.random() < 0.3:
            requests.append((key, "delete", {}))
        else:
            values = {a: v for a, v in (("s", f"t{at}"), ("n", float(at))) if random_.random() < 0.6}
            requests.append((key, "put", values))
    frame = spark.createDataFrame(
        [(k, op, at, v.get("s"), v.get("n"), list(v)) for at, (k, op, v) in enumerate(requests)],
        "k int, op string, at int, s string, n double, _present array<string>",
    )
    table = ItemTable("t", spark.createDataFrame([(k, v["s"], v["n"]) for k, v in base.items()], "k int, s string, n double"), "k")
    want = sorted((k, v["s"], v["n"]) for k, v in sequential(base, requests, ["s", "n"]).items())
    raw = as_requests(frame, ["k"], "op", "at", ["s", "n"])
    assert rows(apply_requests(table, fold_requests(raw, ["k"], ["s", "n"]))) == sorted(want, key=repr)
    # in two batches, each folded first
    halves = [
        fold_requests(raw.where(c), ["k"], ["s", "n"]).withColumn("_at", F.lit(i)) for i, c in enumerate(("_at < 25", "_at >= 25"))
    ]
    twice = fold_requests(halves[0].unionByName(halves[1]), ["k"], ["s", "n"])
    assert rows(apply_requests(table, twice)) == sorted(want, key=repr)


def test_batch_write_puts_before_deletes(spark, table, both):
    requests = spark.createDataFrame(
        [("a", 1, "delete", None), ("a", 1, "put", "n"), ("c", 1, "PUT", "n"), ("b", None, "put", "n"), ("b", 1, "update", "n"), ("q", 1, "delete", None)],
        "pk string, sk int, op string, s string",
    )
    got = batch_write(table, requests)
    assert rows(got.state) == [("a", 2, "y", None), ("b", 1, None, 3.0), ("c", 1, "n", None)]
    assert rows(got.unprocessed) == [("b", 1, "update", "ValidationException"), ("b", None, "put", "ValidationException")]


def test_unknown_table_of_a_batch(catalog, spark):
    with pytest.raises(TableNotFound):
        batch_write_many(catalog, {"nowhere": spark.range(1)})


# -- transactions -----------------------------------------------------------------------------


def fleet_requests(spark, tonnage):
    selkie = spark.createDataFrame([(305.0,)], "ship_id double")
    new = spark.createDataFrame([(310.0, "Petrel", 95.0)], "ship_id double, title string, tonnage double")
    return [
        Check("harbour", spark.createDataFrame([(13.0,)], "pier double"), "trade = :t", values={":t": "butter"}),
        Put("ship", new),
        Update("ship", selkie, "SET tonnage = :new", "#t = :old", {"#t": "tonnage"}, {":new": 655, ":old": tonnage}),
        Delete("ship", spark.createDataFrame([(303.0,)], "ship_id double")),
    ]


def test_transaction_commits(spark, catalog):
    got = transact_write(catalog, fleet_requests(spark, 640))
    assert got.committed
    sizes = {r["ship_id"]: r["tonnage"] for r in got.states["ship"].collect()}
    assert sizes == {301.0: 4100.0, 302.0: 880.0, 304.0: 2300.0, 305.0: 655.0, 306.0: 7700.0, 310.0: 95.0}
    assert [None if r is None else rows(r) for r in got.results] == [None, [(310.0, "Petrel", 95.0)], [(305.0, 655.0)], None]


def test_transaction_aborts_whole(spark, catalog):
    got = transact_write(catalog, fleet_requests(spark, 641))
    assert not got.committed and rows(got.states["ship"]) == rows(catalog.table("ship").df)
    assert rows(got.failures) == [(2, "ship", '{"ship_id":305.0}', "ConditionalCheckFailedException")]


def test_transaction_with_one_item_twice(spark, catalog):
    key = spark.createDataFrame([(305.0, 1.0), (304.0, 2.0)], "ship_id double, t double")
    got = transact_write(catalog, [Delete("ship", key), Update("ship", key.limit(1), "SET tonnage = :v", values={":v": 1})])
    assert not got.committed and [r["code"] for r in got.failures.collect()] == ["ValidationException"]
    # requests over one frame whose values are columns
    twice = [Update("ship", key, "SET tonnage = :v", values={":v": F.col("t")}) for _ in range(2)]
    assert transact_write(catalog, twice).failures.count() == 2
    assert not got.committed and [r["code"] for r in got.failures.collect()] == ["ValidationException"]


def test_condition_check_of_missing_items(spark, catalog):
    keys = spark.createDataFrame([(301.0,), (301.0,), (77.0,), (None,)], "ship_id double")
    assert rows(condition_check(catalog.table("ship"), keys, "attribute_not_exists(tonnage)")) == [(301.0, False), (77.0, True)]
    failed = transact_write(catalog, [Check("ship", keys.where("ship_id is null"), "attribute_exists(tonnage)")]).failures
    assert [r["code"] for r in failed.collect()] == ["ValidationException"]


# -- statements -------------------------------------------------------------------------------


def test_select_with_parameters(catalog):
    text = 'SELECT tonnage, harbour FROM "ship" WHERE tonnage > ? AND harbour <> ? ORDER BY tonnage DESC LIMIT 2 OFFSET 1;'
    assert rows(select(catalog, text.rstrip(";"), [{"N": "640"}, {"S": "abc"}])) == [(2300.0, "Porto"), (4100.0, "Bergen")]
    assert select(catalog, "SELECT * FROM ship", limit=2).count() == 2 and select(catalog, "SELECT * FROM ship", limit=0).count() == 0
    assert rows(select(catalog, "SELECT 'mail from new-york' AS s FROM visit-log WHERE at = 9")) == [("mail from new-york",)]
    assert select(catalog, "SELECT * FROM visit-log WHERE uid = ?", ["u1"]).count() == 10
    assert select(catalog, "SELECT * FROM ship WHERE array_contains(?, title)", [{"SS": ["Aurora", "Selkie"]}]).count() == 2


def test_write_statements(catalog):
    execute_statement(catalog, "INSERT INTO ship VALUE {'ship_id': 401, 'title': 'Gull, A: b', 'tonnage': 10, 'harbour': 'Split'}")
    again = "INSERT INTO ship VALUE {'ship_id': 401, 'title': 'other'} ON CONFLICT DO "
    execute_statement(catalog, again + "NOTHING")
    with pytest.raises(ValidationError):
        execute_statement(catalog, again + "UPDATE")
    execute_statement(
        catalog,
        "INSERT INTO ship VALUE {'ship_id': ?, 'title': ?, 'tonnage': ?};",
        [{"N": "402"}, {"S": "L'Albatros"}, {"N": "32"}],
    )
    got = select(catalog, "SELECT ship_id, title, tonnage, harbour FROM ship WHERE ship_id >= 400")
    assert rows(got) == [(401.0, "Gull, A: b", 10.0, "Split"), (402.0, "L'Albatros", 32.0, None)]
    execute_statement(catalog, "UPDATE ship SET tonnage = 11, harbour = 'New, WHERE' WHERE ship_id = 401")
    execute_statement(catalog, "UPDATE ship SET harbour = ?, tonnage = ? WHERE ship_id = ?", [{"S": "B?"}, {"N": "33"}, {"N": "402"}])
    got = select(catalog, "SELECT ship_id, tonnage, harbour FROM ship WHERE ship_id >= 400")
    assert rows(got) == [(401.0, 11.0, "New, WHERE"), (402.0, 33.0, "B?")]
    execute_statement(catalog, "DELETE FROM ship WHERE ship_id = ? OR ship_id IN (401)", [{"N": "402"}])
    assert select(catalog, "SELECT * FROM ship").count() == 6
    execute_statement(catalog, "UPDATE harbour SET h_name = 'all'")
    assert {r["h_name"] for r in catalog.table("harbour").df.collect()} == {"all"}
    for bad in ("", "MERGE INTO ship", "DELETE ship", "INSERT INTO ship (a) VALUES (1)"):
        with pytest.raises(ValidationError):
            execute_statement(catalog, bad)


def test_parameters_must_match_marks(catalog):
    table = catalog.table("ship")
    for params in ([], [1, 2]):
        with pytest.raises(ValidationError):
            update_where(table, {"tonnage": "?"}, None, params)


def test_insert_literals_that_do_not_fit_fail(spark, catalog):
    literals = spark.createDataFrame([("9", "'Gull'", "x1")], "ship_id string, title string, tonnage string")
    with pytest.raises(Exception, match="literal does not fit"):
        insert_value(catalog.table("ship"), literals, literals=True).state.collect()


def test_three_conditions_in_one_join(spark, catalog, shuffled):
    """Failures of three conditional requests on one table shuffle it once."""
    rows = lambda *ids: spark.createDataFrame([(float(i), 1.0) for i in ids], "ship_id double, tonnage double")
    requests = [
        Put("ship", rows(301), "attribute_exists(title)"),
        Put("ship", rows(302, 999), "tonnage < :t", values={":t": 5000.0}),
        Check("ship", rows(303).select("ship_id"), "harbour = :h", values={":h": "Bergen"}),
        Delete("ship", rows(304).select("ship_id"), "attribute_exists(title)"),
    ]
    found = transaction_failures(catalog, requests)
    assert sorted((r["request"], r["key"]) for r in found.collect()) == [(1, '{"ship_id":999.0}'), (2, '{"ship_id":303.0}')]
    writes = [Put("ship", rows(301)), Update("ship", rows(302).select("ship_id"), "SET tonnage = :v, crew = :c", values={":v": 7.0, ":c": 4}), Delete("ship", rows(303, 998).select("ship_id"))]
    got = transact_write(catalog, writes)
    state = {r["ship_id"]: (r["tonnage"], r["crew"]) for r in got.states["ship"].select("ship_id", "tonnage", "crew").collect()}
    assert got.committed and state == {301.0: (1.0, None), 302.0: (7.0, 4), 304.0: (2300.0, None), 305.0: (640.0, None), 306.0: (7700.0, None)}


def test_transactions_shuffle_the_table_once(spark, sf, shuffled):
    found = Catalog(spark)
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    found.register_table("orders", orders, "o_orderkey")
    part = lambda k: orders.where(F.col("o_orderkey") % 50 == k).select("o_orderkey", "o_totalprice")
    requests = [Put("orders", part(k), "o_totalprice > :p", values={":p": 1.0}) for k in range(3)]
    plan = transaction_failures(found, requests)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 1 and plan.count("RightOuter") == 1
    state = transact_write(found, [Put("orders", part(k)) for k in range(3)]).states["orders"]
    plan = state._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FullOuter") == 1 and plan.count("SortMergeJoin") == 1


def test_literals_are_read_once(spark):
    """Odd literals, and generated code short enough for the JVM to compile: longer methods than 8,000 bytes stay interpreted."""
    table = ItemTable("t", spark.createDataFrame([(1, 1, 1.0)], "k long, n int, d double"), "k")
    texts = ["7", "-007", "+5", "1e3", "12.0", "120", "1.5", "2147483648", "999999999999999999999", "00000000000000000000012", "1e-12", None]
    given = spark.createDataFrame([(str(100 + i), x, x) for i, x in enumerate(texts)], "k string, n string, d string")
    result = insert_value(table, given, literals=True)
    refused = {100 + i for i, x in enumerate(texts) if x in ("1.5", "2147483648", "999999999999999999999", "1e-12")}
    assert {r["k"] for r in result.failures.collect()} == refused
    state = {r["k"]: (r["n"], r["d"]) for r in result.state.collect() if r["k"] >= 100}
    whole = [7, -7, 5, 1000, 12, 120, None, None, None, 12, None, None]
    assert state == {100 + i: (whole[i], None if x is None else float(x)) for i, x in enumerate(texts) if 100 + i not in refused}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        shown = spark._jvm.PythonSQLUtils.explainString(insert_value(table, given, literals=True).state._jdf.queryExecution(), "codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", shown)]
    assert sizes and max(sizes) < 8000
