import pytest
from pyspark.sql import functions as F

from itemloom import (
    Catalog,
    ItemTable,
    MutationLog,
    SnapshotStore,
    TableNotFound,
    ValidationError,
    apply_mutation_stream,
    batch_get,
    change_feed,
    encode_items,
    evolve_schema,
    infer_item_schema,
    put_items,
    register_from_metadata,
    read_items_json,
    read_items_tsv,
    write_items_tsv,
    restore_columns,
    sanitize_columns,
    schema_diff,
    schema_metadata,
    scratch_dir,
    stream_enabled,
    struct_from_metadata,
    table_metadata,
    write_items_json,
    write_snapshot,
)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# -- schemas ----------------------------------------------------------------------------------


def test_inferred_schema(spark, catalog):
    items = encode_items(catalog.table("ship").df)
    other = spark.createDataFrame([('{"ship_id":{"S":"x"},"extra":{"NULL":true},"map":{"M":{"a":{"S":"x"}}}}',)], "item string")
    got = {r["attribute"]: (r["descriptor"], r["conflicts"], r["items"]) for r in infer_item_schema(items.union(other)).collect()}
    assert got["ship_id"] == ("N", ["S"], 7) and got["extra"] == ("NULL", [], 1) and got["map"] == ("M", [], 1)
    assert (got["callsigns"][0], got["papers"][0], got["dues"][0]) == ("SS", "BS", "NS")
    assert infer_item_schema(items, sample_n=1).count() == 8


def test_metadata(catalog):
    table = catalog.table("ship")
    found = {r["column"]: r.asDict() for r in table_metadata(table).collect()}
    assert found["dues"]["storedType"] == "ARRAY<FLOAT64>" and found["tonnage"]["partitionKey"] == "ship_id"
    assert {f.name: f.dataType for f in struct_from_metadata(table_metadata(table))} == {f.name: f.dataType for f in table.df.schema}


def test_tables_from_metadata(spark):
    df = spark.createDataFrame([(1, "2", ["a"])], "id int, `n-x` string, tags array<string>")
    declared = spark.createDataFrame([("id", "N"), ("n-x", "N"), ("tags", "SS")], "attribute string, descriptor string")
    metadata = schema_metadata(declared, "my-table", "id").union(schema_metadata(declared, "other", "id", actual_table="my-table"))
    found = Catalog(spark)
    assert register_from_metadata(found, metadata, {"my-table": df}) == ["my-table", "other"]
    assert tuple(found.table("other").df.first()) == (1.0, 2.0, ["a"]) and found.table("my-table").columns == ["id", "n_x", "tags"]
    theirs = {"dataType": "kind", "indexName": "idx"}
    renamed = schema_metadata(declared, "my-table", "id", columns=theirs)
    assert "kind" in renamed.columns and register_from_metadata(Catalog(spark), renamed, {"my-table": df}, theirs) == ["my-table"]
    with pytest.raises(TableNotFound):
        register_from_metadata(Catalog(spark), metadata, {})
    with pytest.raises(ValidationError):
        register_from_metadata(Catalog(spark), metadata, {"my-table": df.withColumn("more", F.lit(1))})


def test_schema_diff_and_evolution(spark):
    df = spark.createDataFrame([(1, "x", 2.0)], "id int, gone string, n double")
    items = spark.createDataFrame([('{"id":{"N":"1"},"n":{"N":"2"},"tags":{"SS":["a"]}}',)], "item string")
    declared = spark.createDataFrame([("id", "N"), ("gone", "S"), ("n", "N")], "attribute string, descriptor string")
    diff = schema_diff(declared, infer_item_schema(items))
    assert rows(diff) == [("gone", "S", "drop"), ("tags", "SS", "add")]
    evolved = evolve_schema(df, diff)
    assert evolved.columns == ["id", "n", "tags"] and evolved.schema["tags"].dataType.simpleString() == "array<string>"
    assert evolve_schema(evolved, diff).columns == evolved.columns


def test_stored_names(spark):
    df = spark.range(1).select(F.lit(1).alias("a.b-c"), F.lit(2).alias("x(y)"), F.lit(3).alias("plain"))
    stored, originals = sanitize_columns(df)
    assert stored.columns == ["a_b_c", "x_y_", "plain"]
    assert restore_columns(stored, originals).columns == df.columns
    with pytest.raises(ValidationError):
        sanitize_columns(df.withColumn("a_b.c", F.lit(1)))


# -- files ------------------------------------------------------------------------------------


def test_item_lines(spark, catalog, tmp_path):
    df = catalog.table("harbour").df
    write_items_json(df, str(tmp_path / "items"))
    got = read_items_json(spark, str(tmp_path / "items"), {"pier": "N", "h_name": "S", "trade": "S"})
    assert rows(got.select("pier", "h_name", "trade")) == rows(df)
    assert read_items_json(spark, str(tmp_path / "items")).columns == ["item"]


def test_tab_separated_items(spark, tmp_path):
    (tmp_path / "p.tsv").write_text("pk\tsk\tprice\tnote\nCUST#1\tEMAIL#a\t12.50\tx y\nCUST#2\tEMAIL#b\t\t\n")
    got = read_items_tsv(spark, str(tmp_path / "p.tsv"), numbers=["price"])
    assert rows(got) == [("CUST#1", "EMAIL#a", 12.5, "x y"), ("CUST#2", "EMAIL#b", None, None)]


def test_scratch_folder_is_the_shared_one(spark):
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")


def test_snapshots(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "store"))
    with pytest.raises(TableNotFound):
        store.read("a")
    assert store.commit({"a": spark.range(3), "b": spark.range(5)}) == 1
    assert store.commit({"a": store.read("a").where("id > 0")}, notes={"who": "me"}) == 2
    assert (store.read("a").count(), store.read("b").count(), store.read("a", version=1).count()) == (2, 5, 3)
    assert store.versions() == [1, 2] and store.manifest()["notes"] == {"who": "me"}
    with pytest.raises(Exception, match="already exists"):
        write_snapshot(spark.range(1), str(tmp_path / "store/a/v=000000001"))


def test_a_commit_that_dies_shows_nothing(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "store"))
    store.commit({"a": spark.range(3), "b": spark.range(3)})
    broken = spark.range(3).select(F.raise_error(F.lit("lost")).cast("long").alias("id"))
    with pytest.raises(Exception, match="lost"):
        store.commit({"a": spark.range(9), "b": broken})
    assert (store.read("a").count(), store.read("b").count(), store.versions()) == (3, 3, [1])
    assert store.commit({"a": spark.range(9)}) == 2 and store.read("a").count() == 9


def test_two_writers_of_one_version(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "store"))
    store.commit({"a": spark.range(1)})
    with pytest.raises(ValidationError):
        store._publish(store.manifest())


def test_sorted_snapshots_are_skipped_by_key(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "store"))
    shuffled = spark.range(1000).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("s")).orderBy("s")
    store.commit({"t": ItemTable("t", shuffled.coalesce(1), "k")})
    table = ItemTable("t", store.read("t"), "k")
    assert [r["k"] for r in table.df.collect()] == list(range(1000))
    keys = spark.range(3).select((F.col("id") * 400).alias("k"))
    got = batch_get(table, keys, push_keys=5)
    assert "In(k, [0,400,800])" in got._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["k"] for r in got.collect()) == [0, 400, 800]
    got = batch_get(table, keys, push_keys=2)
    assert "In(k" not in got._jdf.queryExecution().executedPlan().toString() and got.count() == 3


# -- change records ---------------------------------------------------------------------------


def test_change_feed(spark):
    schema = "id int, s string, tags array<string>, doc string"
    old = spark.createDataFrame([(1, "a", ["x"], "{}"), (2, "b", None, None), (3, None, None, None), (4, "d", [], '{"k":1}')], schema)
    new = spark.createDataFrame([(1, "a", ["x", "y"], "{}"), (2, "b", None, None), (4, "d", [], '{"k":2}'), (5, "e", None, None)], schema)
    typed = [d.withColumn("doc", F.parse_json("doc")) for d in (old, new)]
    got = {r["keys"]: (r["event_name"], r["old_image"], r["new_image"]) for r in change_feed(ItemTable("t", typed[0], "id"), typed[1]).collect()}
    assert got == {
        '{"id":1}': ("MODIFY", '{"id":{"N":"1"},"s":{"S":"a"},"tags":{"SS":["x"]},"doc":{"M":{}}}', '{"id":{"N":"1"},"s":{"S":"a"},"tags":{"SS":["x","y"]},"doc":{"M":{}}}'),
        '{"id":3}': ("REMOVE", '{"id":{"N":"3"}}', None),
        '{"id":4}': ("MODIFY", '{"id":{"N":"4"},"s":{"S":"d"},"doc":{"M":{"k":{"N":"1"}}}}', '{"id":{"N":"4"},"s":{"S":"d"},"doc":{"M":{"k":{"N":"2"}}}}'),
        '{"id":5}': ("INSERT", None, '{"id":{"N":"5"},"s":{"S":"e"}}'),
    }


def test_streams_switched_on(spark):
    changes = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "table string, n int")
    config = spark.createDataFrame([("a", "1"), ("a", "1"), ("b", "0")], "tableName string, enabledStream string")
    assert rows(stream_enabled(changes, config)) == [("a", 1)]


# -- mutation stream --------------------------------------------------------------------------

REQUESTS = "k int, op string, seq long, s string, n double, _present array<string>"


def stream_of(spark, folder, batches):
    for i, batch in enumerate(batches):
        spark.createDataFrame(batch, REQUESTS).coalesce(1).write.mode("append").parquet(f"{folder}/part{i}")
    return spark.readStream.schema(REQUESTS).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(folder)


BATCHES = [
    [(1, "put", 1, "a", None, ["s"]), (2, "put", 2, "b", 2.0, ["s", "n"]), (1, "put", 3, None, 9.0, ["n"])],
    [(1, "delete", 4, None, None, []), (2, "put", 5, "c", None, ["s"]), (3, "delete", 6, None, None, []), (None, "put", 7, "x", None, ["s"])],
    [(1, "put", 8, None, 1.0, ["n"]), (4, "delete", 9, None, None, []), (4, "put", 10, "d", None, ["s"])],
]
FINAL = [(0, "zero", 0.0), (1, None, 1.0), (2, "c", 2.0), (4, "d", None)]


@pytest.mark.parametrize("compact_every", [None, 2])
def test_stream_of_mutations(spark, tmp_path, compact_every):
    store = SnapshotStore(spark, str(tmp_path / "store"))
    store.commit({"t": spark.createDataFrame([(0, "zero", 0.0), (3, "gone", 3.0)], "k int, s string, n double")})
    log = MutationLog(store, "t", ["k"])
    # three files, one per batch, oldest first
    stream = stream_of(spark, str(tmp_path / "in"), BATCHES)
    writer = apply_mutation_stream(stream, log, str(tmp_path / "cp"), compact_every=compact_every)
    writer.trigger(availableNow=True).start().awaitTermination()
    assert rows(log.state()) == sorted(FINAL, key=repr)
    assert [r["code"] for r in log.unprocessed().collect()] == ["ValidationException"]
    # a batch that is delivered again changes nothing
    again = spark.createDataFrame(BATCHES[2], REQUESTS)
    log.append(again, 2)
    assert rows(log.state()) == sorted(FINAL, key=repr)
    log.compact()
    assert log.compacted_batch() == 2 and rows(store.read("t")) == sorted(FINAL, key=repr)
    log.append(again, 2)
    assert rows(log.state()) == sorted(FINAL, key=repr)


def test_a_stream_that_starts_anew_loses_nothing(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "store"))
    store.commit({"t": spark.createDataFrame([(0, "zero", 0.0)], "k int, s string, n double")})
    log = MutationLog(store, "t", ["k"])
    for run, key in enumerate((1, 2, 3)):
        stream = stream_of(spark, str(tmp_path / f"in{run}"), [[(key, "put", key, f"s{key}", None, ["s"])]])
        writer = apply_mutation_stream(stream, log, str(tmp_path / f"cp{run}"))
        writer.trigger(availableNow=True).start().awaitTermination()
        if run == 1:
            log.compact()
    assert rows(log.state()) == [(0, "zero", 0.0), (1, "s1", None), (2, "s2", None), (3, "s3", None)]


def test_change_sets_of_different_columns(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "store"))
    store.commit({"t": spark.createDataFrame([(0, "zero")], "k int, x string")})
    log = MutationLog(store, "t", ["k"])
    log.append(spark.createDataFrame([(1, "put", 1, "a")], "k int, op string, seq long, x string"), 0)
    log.append(spark.createDataFrame([(1, "put", 2, "b", 5), (2, "put", 3, "c", 6)], "k int, op string, seq long, x string, y int"), 1)
    log.append(spark.createDataFrame([("no", "put", 4, "c", "7"), ("3", "put", 5, "d", "8")], "k string, op string, seq long, x string, y string"), 2)
    assert rows(log.state().select("k", "x", "y")) == [(0, "zero", None), (1, "b", 5), (2, "c", 6), (3, "d", 8)]
    assert log.unprocessed().count() == 1
    log.compact()
    assert rows(store.read("t").select("k", "x", "y")) == [(0, "zero", None), (1, "b", 5), (2, "c", 6), (3, "d", 8)]


def test_changes_of_nested_values(spark):
    kinds = "named_struct('m', map('b', 1, 'a', {})) AS st, array(parse_json('{{\"p\":{}}}')) AS docs"
    old = spark.sql("SELECT 1 AS id, " + kinds.format(2, 3) + " UNION ALL SELECT 2, " + kinds.format(2, 3))
    new = spark.sql("SELECT 1 AS id, " + kinds.format(2, 3) + " UNION ALL SELECT 2, " + kinds.format(2, 4))
    assert [(r["event_name"], r["keys"]) for r in change_feed(ItemTable("t", old, "id"), new).collect()] == [("MODIFY", '{"id":2}')]


def test_tab_separated_round_trip(spark, tmp_path):
    texts = [None, "", " edge ", "a\nb\tc", "\\n", "\\", '"q"', "\\e", "\0x", "ü\r\n"]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "k string, v string")
    write_items_tsv(df, str(tmp_path / "t"))
    assert rows(read_items_tsv(spark, str(tmp_path / "t"))) == rows(df)


def test_lost_manifest_draft_is_no_version(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "store"))
    store.commit({"a": spark.range(1)})
    (tmp_path / "store/_manifests/.000000002.draft").write_text("{")
    assert store.versions() == [1]
    table = ItemTable("a", store.read("a").withColumn("v", F.lit(1)), "id")
    assert store.commit({"a": put_items(table, spark.range(5).withColumn("v", F.lit(2))).state}) == 2
    assert store.read("a").count() == 5
