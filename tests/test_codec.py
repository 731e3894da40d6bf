import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from itemloom import ValidationError, decode_columns, decode_items, encode_items, read_row_types, validate_nested_sets
from itemloom.functions import documents, values, walks
from itemloom.functions.codec import nested_set_attributes, tagged_column
from itemloom.functions.tagged import untag
from itemloom.functions.types import descriptor_of, spark_type, stored_type


def column(spark, items, kind, use):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {kind}")
    return [r["o"] for r in df.select("i", use(F.col("v")).alias("o")).orderBy("i").collect()]


def test_numbers(spark):
    texts = ["1", "-1.5", "+.5", "1e3", "1E400", "inf", "-Infinity", "NaN", "nan", "", " 1", "1d", "0x10", "abc", None]
    got = column(spark, texts, "string", values.parse_number)
    assert got == [1.0, -1.5, 0.5, 1000.0] + [None] * 11
    assert column(spark, ["9007199254740993"], "string", lambda c: values.parse_number(c, "decimal(38,0)").cast("string")) == ["9007199254740993"]


@pytest.mark.parametrize(
    "number, text",
    [
        (3000.0, "3000"),
        (1000.5, "1000.5"),
        (0.0, "0"),
        (-12.0, "-12"),
        (9035599089.0, "9035599089"),
        (12345678.25, "12345678.25"),
        (1e22, "1" + "0" * 22),
        (1.5e-7, "0.00000015"),
        (-2e-10, "-0.0000000002"),
        (0.30000000000000004, "0.30000000000000004"),
        (1.25e300, "125" + "0" * 298),
    ],
)
def test_number_texts(spark, number, text):
    assert column(spark, [number], "double", values.format_number) == [text]


def test_negative_zero_keeps_its_sign(spark):
    """As the SQL of cod2_encode_items writes it; in a set of numbers both zeros are one member."""
    df = spark.createDataFrame([(-0.0, [-0.0, 0.0, -1.0])], "n double, s array<double>")
    df = df.withColumn("d", F.to_variant_object(F.array("n")))
    want = '{"n":{"N":"-0"},"s":{"NS":["0","-1"]},"d":{"L":[{"N":"-0"}]}}'
    assert [r["item"] for depth in (None, 8) for r in encode_items(df, descriptors={"s": "NS"}, depth=depth).collect()] == [want, want]


def test_sets_lose_repeats_in_order(spark):
    assert column(spark, [["b", "a", "b"], [], None], "array<string>", values.dedupe_set) == [["b", "a"], [], None]


def test_literals(spark):
    convert = lambda d: lambda c: values.convert_literal(c, d)
    assert column(spark, ["'a b'", "a", "'", "''"], "string", convert("S")) == ["a b", "a", "'", ""]
    assert column(spark, ["10", "x"], "string", convert("N")) == [10.0, None]
    assert column(spark, ["true", "T", "0", "yes"], "string", convert("BOOL")) == [True, True, False, None]
    assert column(spark, ["[1]", "{}"], "string", lambda c: F.to_json(values.convert_literal(c, "L"))) == ["[1]", None]
    assert column(spark, ["1", "x", None], "string", lambda c: values.literal_error(c, "N")) == [False, True, False]
    with pytest.raises(ValidationError):
        values.convert_literal(F.lit("x"), "M")


def test_json_objects(spark):
    texts = ['{"a":1}', "{}", "[1]", '{"a":1}}', '{"a":1},{"b":2}', '{"a"', "", "1", None]
    assert column(spark, texts, "string", values.is_json_object) == [True, True] + [False] * 7


def test_binary(spark):
    raw = [b"plain", b'{"a":"eyJ4IjoxfQ==","b":"abcd","c":[1]}', b'"eyJ4IjoxfQ=="', b'"text"', b"12", b"", None]
    got = column(spark, raw, "binary", lambda c: F.to_json(documents.decode_binary(c)))
    assert got == ['"plain"', '{"a":{"x":1},"b":"abcd","c":[1]}', '{"x":1}', '"text"', "12", None, None]


def test_strings(spark):
    texts = ["aGVsbG8=", "abcd", "x=", None]
    assert column(spark, texts, "string", lambda c: values.decode_string(c, base64=True)) == ["hello", "abcd", "x=", None]
    assert column(spark, texts, "string", values.decode_string) == texts


def test_lists_and_maps(spark):
    texts = ['["fig","0071",false,[4,5]]', '[{"S":"a"},{"N":"5.50"},{"L":[{"M":{"k":{"NULL":true}}}]}]', "{}", "x", None]
    got = column(spark, texts, "string", lambda c: F.to_json(documents.decode_list(c)))
    assert got == ['["fig","0071",false,[4,5]]', '["a",5.5,[{"k":null}]]', None, None, None]
    maps = ['{"a":{"b":"aGVsbG8="},"c":[1,"dGVzdA=="],"d":"abcd"}', "[1]", None]
    got = column(spark, maps, "string", lambda c: F.to_json(documents.decode_map(c, base64=True)))
    assert got == ['{"a":{"b":"hello"},"c":[1,"test"],"d":"abcd"}', None, None]
    assert column(spark, maps, "string", lambda c: F.to_json(documents.decode_map(c)))[0] == maps[0]


def test_depth_is_checked(spark):
    deep = '{"a":' * 12 + "1" + "}" * 12
    with pytest.raises(Exception, match="nested deeper"):
        column(spark, [deep], "string", lambda c: documents.tag_text(F.parse_json(c)))
    got = column(spark, [deep], "string", lambda c: documents.tag_text(F.parse_json(c), depth=14))
    assert got[0].count('"M"') == 12


def test_nulls(spark):
    assert column(spark, [None, "x"], "string", values.encode_null) == ['{"NULL":true}', None]
    got = column(spark, ['{"NULL":true}', '{"S":"x"}'], "string", lambda c: values.decode_null(c, lambda t: F.get_json_object(t, "$.S")))
    assert got == [None, "x"]


def test_ships_round_trip(catalog):
    df = catalog.table("ship").df
    schema = {"ship_id": "N", "harbour": "S", "tonnage": "N", "title": "S", "owner": "S", "callsigns": "SS", "papers": "BS", "dues": "NS"}
    back = decode_items(encode_items(df), "item", schema)
    assert back.drop("_present", "_errors").orderBy("ship_id").collect() == df.orderBy("ship_id").collect()
    first = json.loads(encode_items(df.where("ship_id = 303")).first()["item"])
    assert first["dues"] == {"NS": ["310.75"]} and first["papers"] == {"BS": ["dGFuaw=="]} and first["tonnage"] == {"N": "15250"}


def test_nested_round_trip(spark):
    df = spark.sql(
        """SELECT named_struct('a', 1, 'l', array('x', NULL)) AS st, map('k', 1.5D, 'n', CAST(NULL AS DOUBLE)) AS m, array(named_struct('q', true)) AS l,
                  parse_json('{"x":[1,{"y":"z"}],"n":null}') AS doc, CAST(NULL AS STRING) AS s, CAST(X'00ff' AS BINARY) AS b"""
    )
    text = encode_items(df).first()["item"]
    assert json.loads(text) == {
        "st": {"M": {"a": {"N": "1"}, "l": {"L": [{"S": "x"}, {"NULL": True}]}}},
        "m": {"M": {"k": {"N": "1.5"}, "n": {"NULL": True}}},
        "l": {"L": [{"M": {"q": {"BOOL": True}}}]},
        "doc": {"M": {"x": {"L": [{"N": "1"}, {"M": {"y": {"S": "z"}}}]}, "n": {"NULL": True}}},
        "s": {"NULL": True},
        "b": {"B": "AP8="},
    }
    schema = {"m": "map<string,double>", "l": "array<struct<q boolean>>", "doc": "M", "s": "S", "b": "B"}
    back = decode_items(encode_items(df), "item", schema).select("m", "l", F.to_json("doc").alias("doc"), "s", "b").first()
    want = df.select("m", "l", F.to_json("doc").alias("doc"), "s", "b").first()
    assert {**back.asDict(True), "doc": json.loads(back["doc"])} == {**want.asDict(True), "doc": json.loads(want["doc"])}


def test_absent_null_and_empty(spark):
    df = spark.createDataFrame([(1, None, [])], "id int, s string, tags array<string>")
    assert encode_items(df).first()["item"] == '{"id":{"N":"1"},"s":{"NULL":true}}'
    assert encode_items(df, nulls="absent").first()["item"] == '{"id":{"N":"1"}}'
    carried = df.withColumn("_present", F.array(F.lit("s")))
    assert encode_items(carried).first()["item"] == '{"s":{"NULL":true}}'


def test_decoding_reports_what_does_not_fit(spark):
    texts = [
        '{"id":{"N":"1"},"s":{"S":"x"},"tags":{"SS":["a","b","a"]},"more":{"S":"?"}}',
        '{"id":{"N":"NaN"},"s":{"N":"5"},"nums":{"NS":["1","x"]}}',
        '{"id":{"N":"3"},"s":{"NULL":true}}',
        "not json",
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, item string")
    got = decode_items(df, "item", {"id": "N", "s": "S", "tags": "SS", "nums": "NS"}, keep=["i"]).orderBy("i").collect()
    assert [r["id"] for r in got] == [1.0, None, 3.0, None]
    assert got[0]["tags"] == ["a", "b"] and got[0]["_present"] == ["id", "s", "tags", "more"]
    assert [r["_errors"] for r in got] == [[], ["id", "s", "nums"], [], ["*"]]
    exact = decode_items(df.where("i = 0"), "item", {"id": "N"}, number_type="decimal(38,0)").first()
    assert str(exact["id"]) == "1"


def test_columns_of_tagged_texts(spark):
    df = spark.createDataFrame([('{"N":"1"}', '{"SS":["x","x"]}', "plain")], "a string, b string, c string")
    assert tuple(decode_columns(df, {"a": "N", "b": "SS"}).first()) == (1.0, ["x"], "plain")


def test_sets_belong_at_the_top(spark):
    good = '{"a":{"SS":["x"]},"m":{"M":{"SS":{"S":"a name"}}},"l":{"L":[{"L":[{"S":"x"}]}]}}'
    bad = ['{"a":{"M":{"b":{"M":{"c":{"BS":["eA=="]}}}}}}', '{"b":{"L":[{"NS":["1"]}]},"c":{"SS":["x"]}}']
    df = spark.createDataFrame([(t,) for t in [good, *bad]], "item string")
    got = {r["item"]: r["bad_attributes"] for r in validate_nested_sets(df, "item").collect()}
    assert got == {bad[0]: ["a"], bad[1]: ["b"]}


def test_rows_by_descriptor(spark):
    df = spark.createDataFrame([("5", "x", [1.0, None], [], "[1]")], "n string, s string, nums array<double>, tags array<string>, l string")
    schema = {"n": "N", "s": "S", "nums": "NS", "tags": "SS", "l": "L"}
    row = read_row_types(df.withColumn("commit_timestamp", F.current_timestamp()), schema).withColumn("l", F.to_json("l")).first()
    assert tuple(row) == (5.0, "x", [1.0], None, "[1]")
    with pytest.raises(ValidationError):
        read_row_types(df, {"n": "N"})


def test_parameters_untag():
    assert untag({"M": {"a": {"L": [{"N": "1"}, {"NULL": True}]}}}) == {"a": [1, None]}
    assert untag({"NS": ["1", "1", "2.5"]}) == [1, 2.5] and untag({"B": "aGk="}) == b"hi" and untag({"x": 1}) == {"x": 1}
    with pytest.raises(ValidationError):
        untag({"N": "Infinity"})


def test_type_map():
    kinds = ["STRING(MAX)", "FLOAT64", "BOOL", "BYTES(MAX)", "ARRAY<STRING(MAX)>", "ARRAY<FLOAT64>", "ARRAY<BYTES(MAX)>", "JSON", "JSON", "STRING(MAX)"]
    assert [stored_type(d) for d in ["S", "N", "BOOL", "B", "SS", "NS", "BS", "L", "M", "??"]] == kinds
    assert all(descriptor_of(spark_type(d)) == d for d in ["S", "N", "BOOL", "B", "SS", "NS", "BS", "M"])


# -- documents of any depth ---------------------------------------------------------------------


def nest(levels):
    text = "7"
    for k in range(levels):
        text = f'{{"k":{text},"n":null}}' if k % 2 else f"[{text},true]"
    return text


def test_depth_64_round_trip(spark):
    texts = [nest(k) for k in (1, 8, 9, 64, 200)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(F.parse_json("t").alias("doc"))
    items = encode_items(df)
    back = decode_items(items, "item", {"doc": "L"}).select(F.to_json("doc").alias("doc"), "_errors").collect()
    maps = decode_items(items, "item", {"doc": "M"}).select(F.to_json("doc").alias("doc")).collect()
    assert [r["doc"] or m["doc"] for r, m in zip(back, maps, strict=True)] == texts
    lists = [t if t.startswith("[") else f"[{t}]" for t in texts]
    assert column(spark, lists, "string", lambda c: F.to_json(documents.decode_list(c))) == lists
    assert column(spark, lists, "string", lambda c: F.to_json(F.try_parse_json(c))) == lists


def test_nested_sets_at_any_depth(spark):
    deep = '{"SS":["a"]}'
    for _ in range(64):
        deep = f'{{"M":{{"k":{{"L":[{{"N":"1"}},{deep}]}}}}}}'
    items = [f'{{"fine":{{"SS":["x"]}},"bad":{deep}}}', '{"fine":{"L":[{"M":{"SS":{"S":"a"}}}]}}', "[]", None]
    got = column(spark, items, "string", lambda c: F.array_join(nested_set_attributes(c), ","))
    assert got[:2] == ["bad", ""] and got[3] is None


def test_walks_agree_with_expressions(spark):
    """Whole walks give what the expressions of a stated depth give."""
    texts = [
        '[{"S":"a"},{"N":"1.50"},{"N":".5"},{"N":"1e400"},{"N":"x"},{"N":7},{"S":5},{"BOOL":true},{"NULL":true},{"NULL":false}]',
        '[{"B":"aGk="},{"M":{"S":{"S":"deep"},"M":{"M":{}}}},{"L":[{"L":[]},1,null]},{"M":5},{"x":{"S":"kept"}},{"S":null,"N":"3"}]',
        '[1.0,0.1,-0.0,1e22,12345678.9,3000.0,123456789012345678901234567890,"q\\"uote\\n",true,null,{},[]]',
        '[{"N":"12345678.5e0"},{"N":"+5"},{"N":"5."},{"N":"0.0001"},{"N":"00012"},{"S":{"a":[1]}},{"S":"\\u00e9 \\u0001"}]',
        '{"S":"no list"}',
        "not json",
        None,
    ]
    whole = column(spark, texts, "string", lambda c: F.to_json(documents.decode_list(c)))
    assert whole == column(spark, texts, "string", lambda c: F.to_json(documents.decode_list(c, depth=8)))
    maps = ['{"a":"aGk=","b":["aGk","w7w=",{"c":"/w=="}],"n":1.50,"t":null}', "[]", None]
    whole = column(spark, maps, "string", lambda c: F.to_json(documents.decode_map(c, base64=True)))
    assert whole == column(spark, maps, "string", lambda c: F.to_json(documents.decode_map(c, base64=True, depth=8)))
    docs = [t for t in texts[:4]]
    tag = lambda depth: column(spark, docs, "string", lambda c: F.to_json(tagged_column(F.parse_json(c), T.VariantType(), depth=depth)))
    assert tag(None) == tag(8)


def test_walks_make_no_readers_by_the_value(monkeypatch):
    """Readers and writers of JSON are made once; a document is walked alike by calls and, where it is deeper, by a list."""
    made = []
    for kind in (json.JSONDecoder, json.JSONEncoder):
        before = kind.__init__
        monkeypatch.setattr(kind, "__init__", lambda self, *a, _before=before, **k: (made.append(1), _before(self, *a, **k))[1])
    for levels in (0, 1, 8, 31, 32, 33, 500):
        text = '[{"k\\"é":' * levels + '[1.50,"x\\n",null,true,{},[],{"M":3},{"L":[]},-0.0]' + "}]" * levels
        tagged = walks.rebuilt(walks._load(text), walks.tagged)
        assert tagged == walks.rebuilt_deep(walks._load(text), walks.tagged)
        plain = walks.rebuilt(walks._load(tagged), walks.untagged)
        assert plain == walks.rebuilt_deep(walks._load(tagged), walks.untagged)
        assert plain == text.replace("1.50", "1.5").replace("-0.0", "-0")
    for odd in ('{"M":3}', '{"L":{}}', '{"M":[1]}', '{"M":{"S":"a"},"L":[1]}', '{"S":"a","M":{}}', '{"L":[{"M":{"k":{"N":"1"}}}]}', "{}"):
        assert walks.rebuilt(walks._load(odd), walks.untagged) == walks.rebuilt_deep(walks._load(odd), walks.untagged)
    assert walks.rebuilt(walks._load('{"M":{"S":"a"},"L":[1]}'), walks.untagged) == '{"S":"a"}'
    assert not made
