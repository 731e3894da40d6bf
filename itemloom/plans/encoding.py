"""Codec, schemas, files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import codec, documents, values
from ..session import scratch_dir
from ..sources import files, schema
from ..sources.snapshots import SnapshotStore
from .registry import micros, read, registered

EVENT_SCHEMA = {
    "event_id": "bigint",
    "ts": "S",
    "user_id": "bigint",
    "event_type": "S",
    "value": "N",
    "props": "S",
}


def event_items(spark, sf) -> DataFrame:
    """Events as tagged items; errors carry no value, clicks have it as text."""
    df = read(spark, sf, "events")
    plain = codec.encode_items(df.where("event_type NOT IN ('error', 'click')"))
    errors = codec.encode_items(df.where("event_type = 'error'").drop("value"))
    clicks = codec.encode_items(df.where("event_type = 'click'").withColumn("value", F.col("value").cast("string")))
    return reduce(DataFrame.union, [plain, errors, clicks])


# -- schemas ----------------------------------------------------------------------------------


@registered(
    "src2_infer_schema",
    """SELECT 'event_id' AS attribute, 'N' AS descriptor, '' AS conflicts, count(*) AS items FROM events
       UNION ALL SELECT 'ts', 'S', '', count(*) FROM events
       UNION ALL SELECT 'user_id', 'N', '', count(*) FROM events
       UNION ALL SELECT 'event_type', 'S', '', count(*) FROM events
       UNION ALL SELECT 'value', 'N', 'S', count(*) FROM events WHERE event_type <> 'error'
       UNION ALL SELECT 'props', 'S', '', count(*) FROM events""",
)
def src2(spark, sf):
    found = schema.infer_item_schema(event_items(spark, sf))
    return found.select("attribute", "descriptor", F.array_join("conflicts", ",").alias("conflicts"), "items")


@registered(
    "src6_schema_metadata",
    """WITH items AS (SELECT to_json({'c_custkey': c_custkey, 'c_name': c_name, 'c_nationkey': c_nationkey, 'c_acct.bal': c_acctbal,
                                      'c_mktsegment': c_mktsegment}) AS j FROM customer),
            seen AS (SELECT o, CASE json_type(j, '$."' || o || '"') WHEN 'VARCHAR' THEN 'S' WHEN 'NULL' THEN 'NULL' ELSE 'N' END AS d
                     FROM (SELECT j, unnest(json_keys(j)) AS o FROM items)),
            best AS (SELECT o, d FROM (SELECT o, d, count(*) AS n FROM seen GROUP BY o, d)
                     QUALIFY row_number() OVER (PARTITION BY o ORDER BY d = 'NULL', n DESC, d DESC) = 1)
       SELECT replace(o, '.', '_') AS "column", 'customer' AS "tableName", d AS "dataType", o AS "originalColumn", 'c_custkey' AS "partitionKey",
              '' AS "sortKey", '' AS "indexName", 'customer' AS "actualTable", CASE d WHEN 'N' THEN 'FLOAT64' ELSE 'STRING(MAX)' END AS "storedType"
       FROM best""",
)
def src6(spark, sf):
    """Metadata rows of the schema found in the customer items."""
    items = codec.encode_items(read(spark, sf, "customer").withColumnRenamed("c_acctbal", "c_acct.bal"))
    return schema.schema_metadata(schema.infer_item_schema(items), "customer", "c_custkey")


def _newer_customers(spark, sf) -> DataFrame:
    """Items that have gained a tier and lost the balance."""
    df = read(spark, sf, "customer").drop("c_acctbal")
    return codec.encode_items(df.withColumn("c_tier", F.concat(F.lit("tier-"), F.col("c_nationkey").cast("string"))))


@registered(
    "src7_schema_diff",
    """WITH names AS (SELECT json_type(j, '$."' || o || '"') = 'VARCHAR' AS text, o, now
              FROM (SELECT j, unnest(json_keys(j)) AS o, now FROM (
                SELECT to_json({'c_custkey': c_custkey, 'c_name': c_name, 'c_nationkey': c_nationkey, 'c_mktsegment': c_mktsegment,
                                'c_tier': 'tier-' || c_nationkey}) AS j, true AS now FROM customer
                UNION ALL SELECT to_json(c), false FROM customer c))),
            kinds AS (SELECT o, now, CASE WHEN bool_or(text) THEN 'S' ELSE 'N' END AS d FROM names GROUP BY o, now)
       SELECT o AS attribute, d AS descriptor, CASE WHEN now THEN 'add' ELSE 'drop' END AS change FROM kinds k
       WHERE NOT EXISTS (SELECT 1 FROM kinds x WHERE x.o = k.o AND x.now <> k.now)""",
)
def src7(spark, sf):
    declared = schema.declared_schema(read(spark, sf, "customer"))
    return schema.schema_diff(declared, schema.infer_item_schema(_newer_customers(spark, sf)))


@registered(
    "src8_evolve_schema",
    "SELECT c_custkey, c_name, c_nationkey, c_mktsegment, CAST(NULL AS VARCHAR) AS c_tier FROM customer",
)
def src8(spark, sf):
    df = read(spark, sf, "customer")
    diff = schema.schema_diff(schema.declared_schema(df), schema.infer_item_schema(_newer_customers(spark, sf)))
    return schema.evolve_schema(df, diff)


@registered("src9_sanitize_columns", 'SELECT c_custkey, c_name AS "c_name_x", c_mktsegment AS "seg[1]" FROM customer')
def src9(spark, sf):
    """Stored under clean names; one column is then given its own name back."""
    df = read(spark, sf, "customer").select(
        "c_custkey", F.col("c_name").alias("c.name-x"), F.col("c_mktsegment").alias("seg[1]")
    )
    stored, originals = schema.sanitize_columns(df)
    return schema.restore_columns(stored, {"seg_1_": originals["seg_1_"]})


# -- files ------------------------------------------------------------------------------------


@registered("src3_read_items_json", "SELECT event_id, user_id, event_type, value, props, CAST(6 AS INTEGER) AS carried FROM events")
def src3(spark, sf):
    path = scratch_dir(spark, "items-json")
    files.write_items_json(read(spark, sf, "events"), path)
    df = files.read_items_json(spark, path, EVENT_SCHEMA)
    return df.select("event_id", "user_id", "event_type", "value", "props", F.size("_present").alias("carried"))


@registered(
    "src4_read_items_tsv",
    "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_acctbal, c_mktsegment FROM customer",
)
def src4(spark, sf):
    path = scratch_dir(spark, "items-tsv")
    files.write_items_tsv(read(spark, sf, "customer"), path)
    return files.read_items_tsv(spark, path, numbers=["c_acctbal"])


@registered("sink1_write_snapshot", "SELECT o_orderkey, o_orderstatus, o_totalprice + 1 AS o_totalprice FROM orders WHERE o_orderstatus <> 'P'")
def sink1(spark, sf):
    """Two versions of a table; readers see the second."""
    store = SnapshotStore(spark, scratch_dir(spark, "snapshots"))
    df = read(spark, sf, "orders")
    store.commit({"orders": df})
    changed = store.read("orders").where("o_orderstatus <> 'P'").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    store.commit({"orders": changed})
    return store.read("orders").select("o_orderkey", "o_orderstatus", "o_totalprice")


@registered(
    "sink2_write_items_json",
    """SELECT '{"c_custkey":{"N":"' || c_custkey || '"},"c_name":{"S":"' || c_name || '"},"c_mktsegment":{"S":"' || c_mktsegment || '"}}' AS item
       FROM customer""",
)
def sink2(spark, sf):
    path = scratch_dir(spark, "items-out")
    files.write_items_json(read(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment"), path)
    return files.read_items_json(spark, path)


# -- items ------------------------------------------------------------------------------------


@registered(
    "cod1_decode_items",
    """SELECT event_id, epoch_us(ts) AS ts, user_id, event_type, CASE WHEN event_type IN ('error', 'click') THEN NULL ELSE value END AS value, props,
              'event_id,ts,user_id,event_type,' || CASE WHEN event_type = 'error' THEN '' ELSE 'value,' END || 'props' AS present,
              CASE WHEN event_type = 'click' THEN 'value' ELSE '' END AS errors FROM events""",
)
def cod1(spark, sf):
    """Absent attributes are null and not present; a value under the wrong tag is an error."""
    df = codec.decode_items(event_items(spark, sf), "item", {**EVENT_SCHEMA, "ts": "timestamp"})
    return df.select(
        "event_id",
        micros("ts").alias("ts"),
        "user_id",
        "event_type",
        "value",
        "props",
        F.array_join("_present", ",").alias("present"),
        F.array_join("_errors", ",").alias("errors"),
    )


@registered(
    "cod2_encode_items",
    """SELECT c_custkey, '{"c_name":{"S":"' || c_name || '"},"c_nationkey":{"N":"' || c_nationkey || '"},"c_acctbal":{"N":"' ||
              regexp_replace(CAST(c_acctbal AS VARCHAR), '\\.0$', '') || '"},"tags":{"SS":["' || c_mktsegment || '","x"]},"home":{"M":{"nation":{"N":"' ||
              c_nationkey || '"},"known":{"BOOL":' || CAST(c_nationkey > 10 AS VARCHAR) || '},"list":{"L":[{"S":"' || c_name || '"},{"NULL":true}]}}}' ||
              CASE WHEN c_acctbal < 0 THEN ',"rating":{"NULL":true}' ELSE ',"rating":{"S":"good"}' END || '}' AS item FROM customer""",
)
def cod2(spark, sf):
    df = read(spark, sf, "customer").select(
        "c_custkey",
        "c_name",
        "c_nationkey",
        "c_acctbal",
        F.array("c_mktsegment", F.lit("x"), "c_mktsegment").alias("tags"),
        F.struct(
            F.col("c_nationkey").alias("nation"),
            (F.col("c_nationkey") > 10).alias("known"),
            F.array("c_name", F.lit(None).cast("string")).alias("list"),
        ).alias("home"),
        F.when(F.col("c_acctbal") >= 0, F.lit("good")).alias("rating"),
    )
    columns = ["c_name", "c_nationkey", "c_acctbal", "tags", "home", "rating"]
    return codec.encode_items(df, columns, keep=["c_custkey"])


@registered(
    "cod3_parse_number",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice WHEN o_orderstatus = 'O' AND o_orderpriority = '5-LOW' THEN 1500 END AS number
       FROM orders""",
)
def cod3(spark, sf):
    text = (
        F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice").cast("string"))
        .when(F.col("o_orderstatus") == "P", F.col("o_orderpriority"))
        .when(F.col("o_orderpriority") == "5-LOW", F.lit("1.5e3"))
        .when(F.col("o_orderpriority") == "2-HIGH", F.lit("Infinity"))
        .otherwise(F.lit("NaN"))
    )
    return read(spark, sf, "orders").select("o_orderkey", values.parse_number(text).alias("number"))


@registered(
    "cod4_format_number",
    """SELECT l_orderkey, l_linenumber, regexp_replace(CAST(l_quantity AS VARCHAR), '\\.0$', '') AS quantity,
              regexp_replace(CAST(l_extendedprice AS VARCHAR), '\\.0$', '') AS price FROM lineitem""",
)
def cod4(spark, sf):
    return read(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        values.format_number(F.col("l_quantity")).alias("quantity"),
        values.format_number(F.col("l_extendedprice")).alias("price"),
    )


@registered(
    "cod4_format_extremes",
    """SELECT l_orderkey, l_linenumber, CAST(CAST(l_quantity AS BIGINT) * 1000000000 AS VARCHAR) AS large,
              '0.0000' || CAST(CAST(l_quantity AS BIGINT) + 100 AS VARCHAR) || '5' AS small FROM lineitem""",
)
def cod4_extremes(spark, sf):
    """Numbers that Spark itself would write with an exponent."""
    whole = F.col("l_quantity").cast("bigint")
    df = read(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_quantity") * 1e9).alias("large"),
        F.concat(F.lit("0.0000"), (whole + 100).cast("string"), F.lit("5")).cast("double").alias("small"),
    )
    return df.select(
        "l_orderkey",
        "l_linenumber",
        values.format_number(F.col("large")).alias("large"),
        values.format_number(F.col("small")).alias("small"),
    )


@registered(
    "cod5_dedupe_set",
    """SELECT doc_id, len(list_distinct(string_split(text, ' '))) AS members,
              md5(array_to_string(list_sort(list_distinct(string_split(text, ' '))), ' ')) AS digest FROM documents""",
)
def cod5(spark, sf):
    """Distinct words of every whole text."""
    words = values.dedupe_set(F.split("text", " "))
    df = read(spark, sf, "documents").select("doc_id", words.alias("words"))
    return df.select(
        "doc_id",
        F.size("words").cast("bigint").alias("members"),
        F.md5(F.array_join(F.sort_array("words"), " ").cast("binary")).alias("digest"),
    )


@registered("cod6_validate_nested_sets", "SELECT event_id, 'detail' AS bad FROM events WHERE event_type = 'error'")
def cod6(spark, sf):
    """A set in a map breaks the rule; a set at the top and a list in a map do not."""
    inner = F.when(F.col("event_type") == "error", F.lit('{"SS":["a"]}')).otherwise(F.lit('{"L":[{"S":"a"}]}'))
    item = F.concat(F.lit('{"top":{"SS":["x"]},"detail":{"M":{"deep":{"M":{"tags":'), inner, F.lit("}}}}}"))
    df = read(spark, sf, "events").select("event_id", item.alias("item"))
    bad = codec.validate_nested_sets(df, "item")
    return bad.select("event_id", F.array_join("bad_attributes", ",").alias("bad"))


@registered(
    "cod7_null_marker",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN '{"NULL":true}' ELSE '{"S":"' || o_orderpriority || '"}' END AS tagged,
              CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderpriority END AS back FROM orders""",
)
def cod7(spark, sf):
    text = F.when(F.col("o_orderstatus") != "O", F.col("o_orderpriority"))
    tagged = F.coalesce(values.encode_null(text), F.concat(F.lit('{"S":"'), text, F.lit('"}')))
    df = read(spark, sf, "orders").select("o_orderkey", tagged.alias("tagged"))
    return df.withColumn("back", values.decode_null(F.col("tagged"), lambda c: F.get_json_object(c, "$.S")))


@registered(
    "cod8_decode_list",
    """SELECT event_id, CAST(3 AS INTEGER) AS n, event_type AS first, value AS second,
              CASE WHEN event_type = 'click' THEN 'true' ELSE '{"k":' || json_extract_string(props, '$.k') || '}' END AS third FROM events""",
)
def cod8(spark, sf):
    """Tagged, nested and plain list elements come out alike."""
    number = values.format_number(F.col("value"))
    third = F.when(F.col("event_type") == "click", F.lit('{"BOOL":true}')).otherwise(
        F.concat(F.lit('{"M":{"k":{"N":"'), F.get_json_object("props", "$.k"), F.lit('"}}}'))
    )
    tagged = F.concat(F.lit('[{"S":"'), F.col("event_type"), F.lit('"},{"N":"'), number, F.lit('"},'), third, F.lit("]"))
    plain = F.concat(F.lit('["'), F.col("event_type"), F.lit('",'), number, F.lit(","), F.col("props"), F.lit("]"))
    text = F.when(F.col("event_type") == "view", plain).otherwise(tagged)
    texts = read(spark, sf, "events").select("event_id", text.alias("text"))
    df = texts.select("event_id", documents.decode_list(F.col("text")).alias("list"))
    return df.select(
        "event_id",
        F.size("list").alias("n"),
        F.variant_get(F.col("list")[0], "$", "string").alias("first"),
        F.variant_get(F.col("list")[1], "$", "double").alias("second"),
        F.to_json(F.col("list")[2]).alias("third"),
    )


@registered(
    "cod9_decode_map",
    """SELECT event_id, event_type || '!' AS note, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, value FROM events""",
)
def cod9(spark, sf):
    """Base64 text two levels down is decoded, the rest stays."""
    note = F.base64(F.concat(F.col("event_type"), F.lit("!")).cast("binary"))
    padded = F.when(note.endswith("="), note).otherwise(F.concat(F.col("event_type"), F.lit("!")))
    text = F.concat(
        F.lit('{"value":'), values.format_number(F.col("value")), F.lit(',"deep":{"note":"'), padded,
        F.lit('","props":'), F.col("props"), F.lit("}}"),
    )
    texts = read(spark, sf, "events").select("event_id", text.alias("text"))
    df = texts.select("event_id", documents.decode_map(F.col("text"), base64=True).alias("m"))
    return df.select(
        "event_id",
        F.variant_get("m", "$.deep.note", "string").alias("note"),
        F.variant_get("m", "$.deep.props.k", "int").alias("k"),
        F.variant_get("m", "$.value", "double").alias("value"),
    )


@registered(
    "cod10_decode_binary",
    """SELECT event_id, CASE WHEN event_type = 'view' THEN event_type WHEN event_type = 'click' THEN '{"k":' || json_extract_string(props, '$.k') || '}'
              ELSE '{"inner":{"k":' || json_extract_string(props, '$.k') || '},"kind":"' || event_type || '"}' END AS decoded FROM events""",
)
def cod10(spark, sf):
    """Raw text, JSON, and base64 of JSON inside JSON."""
    inner = F.base64(F.col("props").cast("binary"))
    kind = F.col("event_type")
    text = (
        F.when(kind == "view", kind)
        .when(kind == "click", F.concat(F.lit('"'), inner, F.lit('"')))
        .otherwise(F.concat(F.lit('{"inner":"'), inner, F.lit('","kind":"'), kind, F.lit('"}')))
    )
    df = read(spark, sf, "events").select("event_id", "event_type", documents.decode_binary(text.cast("binary")).alias("v"))
    whole = F.when(F.col("event_type") == "view", F.variant_get("v", "$", "string")).otherwise(F.to_json("v"))
    return df.select("event_id", whole.alias("decoded"))


@registered(
    "cod11_decode_string",
    """SELECT doc_id, md5(text) AS decoded, md5(CASE WHEN ends_with(b, '=') THEN text ELSE b END) AS opted
       FROM (SELECT doc_id, text, to_base64(encode(text)) AS b FROM documents)""",
)
def cod11(spark, sf):
    """Whole texts in base64: only padded base64 is taken for such."""
    encoded = F.regexp_replace(F.base64(F.col("text").cast("binary")), "\r\n", "")
    df = read(spark, sf, "documents").select("doc_id", "text", encoded.alias("b"))
    return df.select(
        "doc_id",
        F.md5(F.decode(F.unbase64("b"), "UTF-8").cast("binary")).alias("decoded"),
        F.md5(values.decode_string(F.col("b"), base64=True).cast("binary")).alias("opted"),
    )


@registered(
    "cod12_read_row_types",
    """SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS price, o_orderstatus = 'F' AS done,
              CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END AS tags, o_totalprice || ',' || 1.0 AS nums FROM orders""",
)
def cod12(spark, sf):
    text = F.when(F.col("o_orderstatus") == "P", F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string"))
    df = read(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"),
        text.alias("price"),
        (F.col("o_orderstatus") == "F").cast("string").alias("done"),
        F.filter(F.array("o_orderpriority"), lambda x: x != "5-LOW").alias("tags"),
        F.array("o_totalprice", F.lit(None).cast("double"), F.lit(1.0)).alias("nums"),
    )
    typed = codec.read_row_types(df, {"id": "N", "price": "N", "done": "BOOL", "tags": "SS", "nums": "NS"})
    return typed.select(
        F.col("id").cast("bigint").alias("id"),
        "price",
        "done",
        F.array_join("tags", ",").alias("tags"),
        F.array_join(F.transform("nums", lambda x: x.cast("string")), ",").alias("nums"),
    )


@registered(
    "cod13_convert_literal",
    """SELECT o_orderkey, o_orderstatus AS s, o_totalprice AS n, o_orderstatus = 'F' AS b, o_orderpriority = '1-URGENT' AS bad FROM orders""",
)
def cod13(spark, sf):
    quoted_status = F.concat(F.lit("'"), F.col("o_orderstatus"), F.lit("'"))
    truth = F.when(F.col("o_orderstatus") == "F", F.lit("T")).otherwise(F.lit("false"))
    maybe = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("abc")).otherwise(F.lit("12"))
    return read(spark, sf, "orders").select(
        "o_orderkey",
        values.convert_literal(quoted_status, "S").alias("s"),
        values.convert_literal(F.col("o_totalprice").cast("string"), "N").alias("n"),
        values.convert_literal(truth, "BOOL").alias("b"),
        values.literal_error(maybe, "N").alias("bad"),
    )


@registered(
    "cod14_is_json_object",
    "SELECT event_id, event_type IN ('click', 'view') AS ok FROM events",
)
def cod14(spark, sf):
    kind = F.col("event_type")
    text = (
        F.when(kind.isin("click", "view"), F.col("props"))
        .when(kind == "error", F.concat(F.lit("["), F.col("props"), F.lit("]")))
        .when(kind == "signup", F.concat(F.col("props"), F.lit("}")))
        .otherwise(kind)
    )
    return read(spark, sf, "events").select("event_id", values.is_json_object(text).alias("ok"))
