"""Update actions one by one, as text and in bulk."""

import json

import pytest
from pyspark.sql import functions as F

from itemloom import ItemTable, ValidationError, batch_write, put_items, update_items
from itemloom.functions.updates import actions_from_text, clauses, list_append, set_path

SCHEMA = """id string, n double, s string, tags array<string>, nums array<double>, bins array<binary>,
    list array<string>, m map<string,double>, st struct<a: struct<b: int, c: string>, d: int>"""
ROW = ("1", 5.0, "x", ["old", "new"], [20.0, 10.0], [b"o", b"n"], ["oak", "elm"], {"k": 1.0}, ((1, "c"), 2))
EMPTY = ("1", None, None, None, None, None, None, None, None)


@pytest.fixture(scope="module")
def items(spark):
    """One item with every attribute, one with none."""
    return ItemTable("t", spark.createDataFrame([ROW, ("2", *EMPTY[1:])], SCHEMA), "id")


def after(spark, text, values=None, row=ROW, names=None):
    table = ItemTable("t", spark.createDataFrame([row], SCHEMA), "id")
    asked = spark.createDataFrame([("1",)], "id string")
    got = update_items(table, asked, text, names, values)
    return got.state.first().asDict(recursive=True)


@pytest.mark.parametrize(
    "text, values, column, expected, of_empty",
    [
        ("SET n = :v", {":v": 10}, "n", 10.0, 10.0),
        ("SET n = n + :v", {":v": {"N": "1"}}, "n", 6.0, 1.0),
        ("SET n = n - :v", {":v": 2}, "n", 3.0, -2.0),
        ("SET n = if_not_exists(n, :v)", {":v": 9}, "n", 5.0, 9.0),
        ("SET n = if_exists(n, :v)", {":v": 9}, "n", 9.0, None),
        ("ADD n :v", {":v": 1.5}, "n", 6.5, 1.5),
        ("ADD n :v", {":v": "1.5"}, "n", 6.5, 1.5),
        ("ADD tags :v", {":v": {"SS": ["new", "newer"]}}, "tags", ["old", "new", "newer"], ["new", "newer"]),
        ("DELETE tags :v", {":v": {"SS": ["old"]}}, "tags", ["new"], None),
        ("DELETE tags :v", {":v": {"SS": ["old", "new"]}}, "tags", None, None),
        ("ADD nums :v", {":v": {"NS": ["10", "3"]}}, "nums", [20.0, 10.0, 3.0], [10.0, 3.0]),
        ("DELETE nums :v", {":v": {"NS": ["10"]}}, "nums", [20.0], None),
        ("ADD bins :v", {":v": {"BS": [b"z"]}}, "bins", [b"o", b"n", b"z"], [b"z"]),
        ("DELETE bins :v", {":v": {"BS": [b"o"]}}, "bins", [b"n"], None),
        ("SET tags = :v", {":v": {"SS": ["b", "a", "b"]}}, "tags", ["b", "a"], ["b", "a"]),
        ("SET list = list_append(list, :v)", {":v": ["fir"]}, "list", ["oak", "elm", "fir"], ["fir"]),
        ("SET list = list_append(list, :v)", {":v": "fir"}, "list", ["oak", "elm", "fir"], ["fir"]),
        ("SET list[1] = :v", {":v": "ash"}, "list", ["oak", "ash"], None),
        ("SET list[2] = :v", {":v": "tail"}, "list", ["oak", "elm", "tail"], None),
        ("SET list[3] = :v", {":v": "far"}, "list", ["oak", "elm"], None),
        ("REMOVE list[0]", {}, "list", ["elm"], None),
        ("REMOVE list[7]", {}, "list", ["oak", "elm"], None),
        ("REMOVE n", {}, "n", None, None),
        ("SET m.k = :v", {":v": 7}, "m", {"k": 7.0}, None),
        ("SET m.other = :v", {":v": 7}, "m", {"k": 1.0, "other": 7.0}, None),
        ("SET st.a.b = :v", {":v": 7}, "st", {"a": {"b": 7, "c": "c"}, "d": 2}, None),
        ("SET st.none.b = :v", {":v": 7}, "st", {"a": {"b": 1, "c": "c"}, "d": 2}, None),
        ("SET s = concat(s, '-', :v)", {":v": "y"}, "s", "x-y", None),
        ("SET n = if_not_exists(n, :z) + :v", {":z": 0, ":v": 3}, "n", 8.0, 3.0),
    ],
)
def test_action(spark, items, text, values, column, expected, of_empty):
    asked = spark.createDataFrame([("1",), ("2",)], "id string")
    got = {r["id"]: r for r in (r.asDict(recursive=True) for r in update_items(items, asked, text, None, values).state.collect())}
    assert (got["1"][column], got["2"][column]) == (expected, of_empty)
    before = {r["id"]: r for r in (r.asDict(recursive=True) for r in items.df.collect())}
    for key in ("1", "2"):
        assert {**got[key], column: None} == {**before[key], column: None}


def test_document_attributes(spark, catalog):
    table = catalog.table("depots")
    asked = spark.createDataFrame([("p1", "Yale"), ("p3", "x")], "depot string, v string")
    text = "SET #a.#b.#c.#d = :v"
    names = {"#a": "layout", "#b": "gate", "#c": "lock", "#d": "brand"}
    got = update_items(table, asked, text, names, {":v": F.col("v")}).state
    rows = {r["depot"]: r["j"] for r in got.select("depot", F.to_json("layout").alias("j")).collect()}
    assert '"brand":"Yale"' in rows["p1"] and '"pins":9' in rows["p1"] and '"brand":"Abus"' in rows["p2"]
    assert rows["p3"] is None
    broken = update_items(table, asked, [set_path("layout", "gate.nowhere.x", F.col("v"))]).state
    assert '"brand":"Abus"' in broken.where("depot = 'p1'").select(F.to_json("layout")).first()[0]


def test_targets_inside_documents(spark):
    base = spark.createDataFrame([(1, '{"n":{"x":2,"y":"z"},"l":[1,2,3],"k":5}')], "id int, doc string").withColumn("doc", F.parse_json("doc"))
    table, asked = ItemTable("t", base, "id"), spark.createDataFrame([(1,), (2,)], "id int")

    def doc(text, values=None):
        got = {r["id"]: r["j"] for r in update_items(table, asked, text, None, values).state.select("id", F.to_json("doc").alias("j")).collect()}
        assert got[2] is None
        return json.loads(got[1])

    whole = {"n": {"x": 2, "y": "z"}, "l": [1, 2, 3], "k": 5}
    assert doc("REMOVE doc.k") == {k: v for k, v in whole.items() if k != "k"}
    assert doc("REMOVE doc.n.y") == whole | {"n": {"x": 2}} and doc("REMOVE doc.none.y") == whole
    assert doc("SET doc.l[1] = :v", {":v": 9}) == whole | {"l": [1, 9, 3]}
    assert doc("REMOVE doc.l[0]") == whole | {"l": [2, 3]}
    assert doc("ADD doc.n.x :v", {":v": 3}) == whole | {"n": {"x": 5, "y": "z"}}
    assert doc("ADD doc.n.y :v", {":v": 3}) == whole
    structs = spark.sql("SELECT 1 AS id, named_struct('a', array('p', 'q'), 'b', 4) AS s, map('m', 1.5D) AS m")
    got = update_items(ItemTable("t", structs, "id"), asked, "REMOVE s.b ADD m.m :v", None, {":v": 2}).state.where("id = 1").first()
    assert got["s"]["b"] is None and got["s"]["a"] == ["p", "q"] and got["m"] == {"m": 3.5}
    for text in ("ADD doc.l[0] :v", "SET doc.n.x = doc.n.x + :v"):
        with pytest.raises(ValidationError):
            update_items(table, asked, text, None, {":v": 1})


def test_whole_numbers_stay_exact(spark):
    top = 2**63 - 1
    base = spark.createDataFrame([(1, 2**53 + 1), (2, top), (3, 5), (4, 5), (5, 5)], "id long, n long")
    asked = spark.createDataFrame([(1, "1"), (2, "1"), (3, "0.5"), (4, "x"), (5, "-7")], "id long, d string")
    for options in ({}, {"seq": "id"}):
        got = update_items(ItemTable("t", base, "id"), asked, "ADD n :d", values={":d": F.col("d")}, **options)
        assert dict(map(tuple, got.state.collect())) == {1: 2**53 + 2, 2: top, 3: 5, 4: 5, 5: -2}
        assert sorted(r["id"] for r in got.failures.collect()) == [2, 3, 4]
    got = update_items(ItemTable("t", base, "id"), asked.where("id = 3"), "SET n = :v", values={":v": 1.5})
    assert got.state.where("id = 3").first()["n"] == 5 and got.failures.count() == 1


def test_puts_that_do_not_fit(spark):
    table = ItemTable("t", spark.createDataFrame([(1, 10)], "id long, n long"), "id")
    puts = spark.createDataFrame([(1.7, 1.0), (1.2, 2.0), (2.0, 3.0), (3.0, 1.5), (None, 1.0)], "id double, n double")
    got = put_items(table, puts)
    assert sorted(map(tuple, got.state.collect())) == [(1, 10), (2, 3)]
    assert sorted(got.failures.collect(), key=repr) == [(3, "ValidationException"), *[(None, "ValidationException")] * 3]
    texts = spark.createDataFrame([("abc", "1"), ("7", "x"), ("8", "9")], "id string, n string")
    got = put_items(table, texts)
    assert sorted(map(tuple, got.state.collect())) == [(1, 10), (8, 9)] and got.failures.count() == 2
    mixed = batch_write(table, texts.withColumn("op", F.lit("put")))
    assert sorted(map(tuple, mixed.state.collect())) == [(1, 10), (8, 9)] and mixed.unprocessed.count() == 2
    assert update_items(table, texts.select("id"), "SET n = :v", values={":v": 4}).failures.count() == 1


def test_lists_grow_at_either_end(spark):
    table = ItemTable("t", spark.createDataFrame([(1, ["b"]), (2, None)], "id int, l array<string>"), "id")
    got = update_items(table, spark.createDataFrame([(1,), (2,)], "id int"), "SET l = list_append(:v, l)", values={":v": ["a"]}).state
    assert dict(map(tuple, got.collect())) == {1: ["a", "b"], 2: ["a"]}


def test_first_value_that_is_there_counts(spark):
    table = ItemTable("t", spark.createDataFrame([(1, None)], "id int, s string"), "id")
    asked = spark.createDataFrame([(1, 1, None), (1, 2, "second"), (1, 3, "third")], "id int, at int, v string")
    got = update_items(table, asked, "SET s = if_not_exists(s, :v)", values={":v": F.col("v")}, seq="at").state
    assert got.first()["s"] == "second"


def test_document_lists(spark, catalog):
    table = catalog.table("box")
    asked = spark.createDataFrame([("b1",)], "box string")

    def changed(text, values=None):
        state = update_items(table, asked, text, {"#lt": "goods"}, values).state
        return state.where("box = 'b1'").select(F.to_json("goods")).first()[0]

    assert changed("SET #lt[1] = :v", {":v": "new"}) == '["tea","new",false]'
    assert changed("SET #lt = list_append(#lt, :v)", {":v": ["a", 1]}) == '["tea",840,false,"a",1]'
    assert changed("REMOVE #lt[2]") == '["tea",840]'
    assert changed("SET #lt = :v", {":v": {"L": [{"S": "x"}, {"N": "2"}]}}) == '["x",2]'


def test_all_actions_read_the_old_item(spark):
    text = "set s = :x REMOVE tags add n :n DELETE nums :d"
    got = after(spark, text, {":x": "X", ":n": 1, ":d": {"NS": ["20"]}})
    assert (got["s"], got["tags"], got["n"], got["nums"]) == ("X", None, 6.0, [10.0])
    swapped = after(spark, "SET n = cast(id AS double), s = cast(n AS string)", {})
    assert (swapped["n"], swapped["s"]) == (1.0, "5.0")


def test_clauses_are_cut_outside_quotes():
    assert clauses("set a = 'x REMOVE y', b = :v remove c") == [("SET", "a = 'x REMOVE y', b = :v"), ("REMOVE", "c")]
    assert [a.column for a in actions_from_text("SET #s = :v, b = concat(b, ',', :v)", {"#s": "set-name"}, {":v": 1})] == ["set-name", "b"]
    for bad in ("", "PUT a = :v", "SET a", "ADD a", "REMOVE a b"):
        with pytest.raises(ValidationError):
            actions_from_text(bad, {}, {":v": 1})


def test_refused_expressions(spark, catalog):
    table, asked = catalog.table("ship"), spark.createDataFrame([(301.0,)], "ship_id double")
    for text, values in [("SET title = :t", {}), ("SET ship_id = :v", {":v": 1}), ("SET tonnage = :v ADD tonnage :v", {":v": 1})]:
        with pytest.raises(ValidationError):
            update_items(table, asked, text, values=values)


def test_overflow_and_bad_addends_are_refused(spark):
    base = spark.createDataFrame([("a", 1.7e308), ("b", 1.0), ("c", 2.0)], "id string, n double")
    asked = spark.createDataFrame([("a", "1e308"), ("b", "junk"), ("c", "3")], "id string, d string")
    got = update_items(ItemTable("t", base, "id"), asked, "ADD n :d", values={":d": F.col("d")})
    assert sorted(map(tuple, got.state.collect())) == [("a", 1.7e308), ("b", 1.0), ("c", 5.0)]
    assert sorted(map(tuple, got.failures.collect())) == [("a", "ValidationException"), ("b", "ValidationException")]


def test_condition_gates_the_update(spark, catalog):
    table = catalog.table("ship")
    asked = spark.createDataFrame([(304.0, 2450), (309.0, 70)], "ship_id double, t int")
    got = update_items(table, asked, "SET tonnage = :t", values={":t": F.col("t"), ":min": 2000}, condition="tonnage > :min")
    after = {r["ship_id"]: r["tonnage"] for r in got.state.collect()}
    assert after == {r["ship_id"]: r["tonnage"] for r in table.df.collect()} | {304.0: 2450.0}
    assert [tuple(r) for r in got.failures.collect()] == [(309.0, "ConditionalCheckFailedException")]


def test_missing_item_is_created_and_new_attributes_appear(spark, catalog, shuffled):
    table = catalog.table("harbour")
    asked = spark.createDataFrame([(14.0, "dry dock"), (11.0, "deep")], "pier double, note string")
    got = update_items(table, asked, "SET note = :n", values={":n": F.col("note")}).state
    rows = {r["pier"]: (r["h_name"], r["note"]) for r in got.collect()}
    assert rows == {11.0: ("Bergen", "deep"), 12.0: (None, None), 13.0: ("Cork", None), 14.0: (None, "dry dock")}


# -- several updates of one key ---------------------------------------------------------------


def one_by_one(spark, table, rows, text, names=("v",)):
    """The same requests applied one after the other."""
    for row in rows:
        asked = spark.createDataFrame([row], "id string, at int, v string")
        table = update_items(table, asked, text, values={f":{n}": F.col(n) for n in names}).table_after
    return sorted(map(str, table.df.collect()))


@pytest.mark.parametrize(
    "text",
    [
        "SET s = :v",
        "SET s = if_not_exists(s, :v)",
        "SET s = if_exists(s, :v)",
        "SET list = list_append(list, :v)",
        "SET list[2] = :v",
        "SET list[1] = :v, s = :v",
        "ADD n :v",
        "REMOVE list[0]",
        "REMOVE s",
    ],
)
def test_folded_updates_equal_updates_in_order(spark, text):
    base = spark.createDataFrame([("a", 1.0, "x", ["p", "q"]), ("b", None, None, None)], "id string, n double, s string, list array<string>")
    table = ItemTable("t", base, "id")
    rows = [("a", 3, "30"), ("b", 1, "10"), ("a", 1, "11"), ("b", 2, "20"), ("c", 5, "50"), ("a", 2, "22")]
    asked = spark.createDataFrame(rows, "id string, at int, v string")
    folded = update_items(table, asked, text, values={":v": F.col("v")}, seq="at").state
    want = one_by_one(spark, table, sorted(rows, key=lambda r: r[1]), text)
    assert sorted(map(str, folded.collect())) == want


def test_folded_sets(spark):
    base = spark.createDataFrame([("a", ["x"], ["p", "q"]), ("b", None, None)], "id string, s array<string>, d array<string>")
    asked = spark.createDataFrame([("a", 1, ["y"]), ("a", 2, ["z", "y"]), ("b", 1, ["p"]), ("b", 2, None)], "id string, at int, v array<string>")
    got = update_items(ItemTable("t", base, "id"), asked, "ADD s :v DELETE d :v", values={":v": F.col("v")}, seq="at").state
    rows = {r["id"]: (sorted(r["s"]), r["d"]) for r in got.collect()}
    assert rows == {"a": (["x", "y", "z"], ["p", "q"]), "b": (["p"], None)}


def test_repeated_keys_without_order_are_refused(spark):
    base = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "id string, n double")
    asked = spark.createDataFrame([("a", 5), ("a", 6), ("b", 7), (None, 8)], "id string, v int")
    got = update_items(ItemTable("t", base, "id"), asked, "SET n = :v", values={":v": F.col("v")})
    assert sorted(map(tuple, got.state.collect())) == [("a", 1.0), ("b", 7.0)]
    assert sorted(map(str, got.failures.collect())) == ["Row(id='a', code='ValidationException')", "Row(id=None, code='ValidationException')"]


def test_a_hot_key_among_updates(spark):
    """A third of all requests aim at one item."""
    asked = spark.range(9000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), "id", F.lit(1.0).alias("d"))
    base = spark.range(10).select(F.col("id").alias("k"), F.lit(0.5).alias("n"))
    got = update_items(ItemTable("t", base, "k"), asked, "ADD n :d", values={":d": F.col("d")}, seq="id").state
    assert got.where("k = 0").first()["n"] == 3000.5
    assert got.count() == 6001 + 3


def test_order_of_a_list_needs_seq(spark):
    base = spark.createDataFrame([("a", ["x"])], "id string, l array<string>")
    asked = spark.createDataFrame([("a", 2, "2"), ("a", 1, "1")], "id string, at int, v string")
    got = update_items(ItemTable("t", base, "id"), asked, [list_append("l", F.col("v"))], seq="at").state
    assert got.first()["l"] == ["x", "1", "2"]


@pytest.mark.parametrize("kind", ["decimal(38,18)", "decimal(38,10)", "decimal(38,2)", "decimal(30,18)", "decimal(20,12)"])
def test_sums_on_decimals_are_exact(spark, kind):
    from decimal import Context, Decimal

    digits, scale = (int(x) for x in kind[8:-1].split(","))
    exact, unit = Context(prec=80), Decimal(1).scaleb(-scale)
    largest = exact.subtract(Decimal(1).scaleb(digits - scale), unit)
    pairs = [(a, b) for a in (unit, -unit, largest, exact.minus(largest), None) for b in (unit, -unit, largest, exact.minus(largest), 3 * unit, Decimal(1) - unit, Decimal(-1))]
    rows = [(i, a, b) for i, (a, b) in enumerate(pairs)]
    items = spark.createDataFrame([r[:2] for r in rows], f"id int, total {kind}")
    table = ItemTable("sums", items, "id")
    for given in (kind, "string"):
        requests = spark.createDataFrame([(r[0], str(r[2]) if given == "string" else r[2]) for r in rows], f"id int, d {given}")
        for sign, text in ((1, "SET total = total + :d"), (-1, "SET total = total - :d")):
            result = update_items(table, requests, text, {}, {":d": F.col("d")})
            got = {r["id"]: r["total"] for r in result.state.collect()}
            refused = {r["id"] for r in result.failures.collect()}
            for i, a, b in rows:
                want = exact.add(a or Decimal(0), b if sign > 0 else exact.minus(b))
                assert (i in refused) == (want.copy_abs() > largest)
                assert got[i] == (a if i in refused else want)
    finer = spark.createDataFrame([(0, "1" + "0" * 3 + "e-" + str(scale + 4)), (1, "10e-" + str(scale + 1)), (2, "0." + "0" * scale + "1")], "id int, d string")
    result = update_items(table, finer, "SET total = total + :d", {}, {":d": F.col("d")})
    assert {r["id"] for r in result.failures.collect()} == {0, 2}
