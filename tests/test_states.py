"""Stored tables in buckets, levels of change sets, numbered change records, and values that do not fit."""

import random

import pytest
from pyspark.sql import functions as F

from itemloom import (
    Catalog,
    Index,
    ItemTable,
    MutationLog,
    SnapshotStore,
    batch_get,
    change_feed,
    changes_between,
    delete_items,
    execute_statement,
    index_metadata,
    insert_value,
    put_items,
    query,
    register_from_metadata,
    scratch,
    scratch_dir,
    sequenced,
    table_metadata,
    update_items,
)
from itemloom.errors import ValidationError


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def store(spark, tmp_path):
    return SnapshotStore(spark, str(tmp_path / "store"))


@pytest.fixture
def table(spark):
    df = spark.range(200).select(F.col("id").alias("k"), (F.col("id") % 3).alias("s"), (F.col("id") * 2).alias("v"))
    return ItemTable("t", df.unionByName(spark.createDataFrame([(None, 1, 5)], "k long, s long, v long")), "k", "s")


# -- buckets ------------------------------------------------------------------------------------


def folders(tmp_path, version):
    return sorted(p.name for p in (tmp_path / f"store/t/v={version:09d}").glob("_bucket=*"))


def test_a_change_writes_the_buckets_of_its_keys(spark, store, table, tmp_path):
    store.commit({"t": table}, buckets=16)
    assert len(folders(tmp_path, 1)) == 16 and rows(store.read("t")) == rows(table.df) and store.count("t") == 201
    asked = spark.createDataFrame([("7", "1"), (" no", "0"), (None, "1")], "k string, s string").where("k is not null")
    version = store.change("t", asked, lambda part: update_items(part, asked, "ADD v :d", values={":d": 100}).state)
    assert version == 2 and len(folders(tmp_path, 2)) == 1
    after = update_items(table, asked, "ADD v :d", values={":d": 100}).state
    assert rows(store.read("t")) == rows(after) and rows(store.read("t", 1)) == rows(table.df)
    # an update of a key without an item makes one, in its own bucket
    fresh = spark.createDataFrame([(1000, 0)], "k long, s long")
    store.change("t", fresh, lambda part: put_items(part, fresh.withColumn("v", F.lit(1))).state)
    assert store.count("t") == 202 == store.read("t").count()
    keys = spark.range(200).select(F.col("id").alias("k"), (F.col("id") % 3).alias("s"))
    store.change("t", keys.union(fresh), lambda part: delete_items(part, keys.union(fresh)).state)
    assert rows(store.read("t")) == [(None, 1, 5)] and store.count("t") == 1
    assert store.change("t", keys.limit(0), lambda part: part.df.where("false")) == 5 and store.count("t") == 1


def test_point_reads_open_one_bucket(spark, store, table):
    store.commit({"t": table}, buckets=16)
    asked = spark.createDataFrame([(7, 1)], "k int, s int")
    part = store.lookup("t", asked)
    assert len(part.df.inputFiles()) == 1 and rows(part.df.where("k = 7")) == [(7, 1, 14)]
    assert store.lookup("t", asked.limit(0)).df.count() == 0


def test_a_change_cannot_reach_other_items(spark, store, table):
    store.commit({"t": table}, buckets=16)
    asked = spark.createDataFrame([(7, 1)], "k long, s long")
    with pytest.raises(ValidationError):
        store.change("t", asked, lambda part: put_items(part, spark.range(500).select(F.col("id").alias("k"), F.lit(9).alias("s"), F.lit(1).alias("v"))).state)
    assert rows(store.read("t")) == rows(table.df) and store.versions() == [1]
    with pytest.raises(ValidationError):
        SnapshotStore(spark, store.root).change("t2", asked, lambda part: part.df) if store.commit({"t2": table.df}) else None


def test_an_attribute_added_by_a_change(spark, store, table):
    store.commit({"t": table}, buckets=4)
    asked = spark.createDataFrame([(7, 1, "new")], "k long, s long, note string")
    store.change("t", asked, lambda part: put_items(part, asked).state)
    assert [tuple(r) for r in store.read("t").where("note is not null").collect()] == [(7, 1, 14, "new")]
    assert store.read("t").count() == 201


def test_vacuum_keeps_what_versions_name(spark, store, table, tmp_path):
    store.commit({"t": table, "flat": table.df}, buckets=16)
    for k in range(3):
        asked = spark.createDataFrame([(k, k % 3)], "k long, s long")
        store.change("t", asked, lambda part, a=asked: update_items(part, a, "ADD v :d", values={":d": 1}).state)
    store.commit({"flat": table.df.limit(3)})
    want, before = rows(store.read("t")), rows(store.read("t", 4))
    removed = store.vacuum(keep=2)
    assert rows(store.read("t")) == want and rows(store.read("t", 4)) == before and store.versions() == [4, 5]
    assert all(p.startswith("t/v=000000001/_bucket=") for p in removed)
    assert store.vacuum() == ["flat/v=000000001"] and rows(store.read("flat")) == rows(store.read("flat", 5))
    assert rows(store.read("t")) == want and store.vacuum() == []
    with pytest.raises(ValidationError):
        store.vacuum(0)


def test_dropped_attributes_stay_gone(spark, store, table, tmp_path):
    store.commit({"t": table}, buckets=4)
    diff = lambda *rows: spark.createDataFrame(list(rows), "attribute string, descriptor string, change string")
    store.evolve("t", diff(("v", "N", "drop")))
    assert store.read("t").columns == ["k", "s"] and not (tmp_path / "store/t/v=000000002").exists()
    store.evolve("t", diff(("v", "N", "add"), ("tags", "SS", "add")))
    assert rows(store.read("t").select("v", "tags").distinct()) == [(None, None)] and store.read("t").count() == 201
    asked = spark.createDataFrame([(7, 1, 5.0, ["x"])], "k long, s long, v double, tags array<string>")
    store.change("t", asked, lambda part: put_items(part, asked).state)
    assert rows(store.read("t").where("v is not null").select("k", "s", "v", "tags")) == [(7, 1, 5.0, ["x"])]
    # dropped and added once more: neither the first values nor the second ones come back
    store.evolve("t", diff(("v", "N", "drop"), ("nothing", "S", "drop")))
    store.evolve("t", diff(("v", "S", "add")))
    assert rows(store.read("t").select("v").distinct()) == [(None,)] and store.read("t", 2).columns == ["k", "s"]
    third = spark.createDataFrame([(8, 2, "third")], "k long, s long, v string")
    store.change("t", third, lambda part: put_items(part, third).state)
    assert rows(store.read("t").where("v is not null").select("k", "v")) == [(8, "third")]
    assert rows(store.read("t", 1)) == rows(table.df) and rows(store.read("t", 4).where("v is not null").select("k", "v")) == [(7, 5.0)]
    with pytest.raises(ValidationError):
        store.evolve("t", diff(("k", "N", "drop")))
    # an attribute that a put brings back after a drop starts anew too
    store.evolve("t", diff(("tags", "SS", "drop")))
    again = spark.createDataFrame([(9, 0, "plain")], "k long, s long, tags string")
    store.change("t", again, lambda part: put_items(part, again).state)
    assert rows(store.read("t").where("tags is not null").select("k", "tags")) == [(9, "plain")]


def test_versions_by_time_and_pinned_catalogs(spark, store, table):
    store.commit({"t": table, "flat": table.df}, buckets=4)
    store.commit({"flat": table.df.limit(0)})
    times = [store.manifest(v)["time"] for v in store.versions()]
    assert times[0] <= times[1] and store.version_at(times[1] + 1) == 2
    assert store.version_at(times[0]) in (1, 2)
    with pytest.raises(ValidationError):
        store.version_at(times[0] - 1)
    pinned = store.catalog(1, keys={"flat": ["k", "s"]})
    store.commit({"t": table.with_df(table.df.limit(0))})
    assert pinned.table("t").df.count() == 201 == pinned.table("flat").df.count() and pinned.table("t").keys == ["k", "s"]
    assert store.catalog().names() == ["t"] and store.read("t").count() == 0


def test_a_stored_index_follows_its_table(spark, store, tmp_path):
    rng = random.Random(8)
    df = spark.createDataFrame([(k, rng.choice([None, 1, 2, 3, 4, 5]), rng.random(), f"n{k}") for k in range(300)], "k long, g int, w double, note string")
    indexes = {"by_g": Index("g", "w"), "thin": Index("g", include=())}
    table = ItemTable("t", df, "k", indexes=indexes)
    store.commit({"t": table}, buckets=32)
    same = lambda: [rows(store.index_table("t", n).df) == rows(ItemTable("t", store.read("t"), "k", indexes=indexes).index(n).df.where("g is not null")) for n in indexes]
    assert same() == [True, True]
    moved = spark.createDataFrame([(1, 9), (2, None), (3, 4), (999, 4)], "k int, g int")
    store.change("t", moved, lambda part: put_items(part, moved).state)
    assert same() == [True, True] and rows(store.index_table("t", "by_g").df.where("g = 9").select("k")) == [(1,)]
    gone = spark.createDataFrame([("3",), ("999",), ("4",)], "k string")
    store.change("t", gone, lambda part: delete_items(part, gone).state)
    assert same() == [True, True] and store.count("t") == 298
    # a page of one partition key opens its bucket, and a change the buckets of the keys it moves
    asked = spark.createDataFrame([(5,)], "g int")
    view = store.index_table("t", "by_g", asked)
    assert len(view.df.inputFiles()) == 1 and view.keys == ["g", "w"] and view.base_keys == ("k",)
    page = query(view, "g = :g", values={":g": 5}, limit=3)
    assert [r["w"] for r in page.collect()] == sorted((r["w"] for r in store.read("t").where("g = 5").collect()), reverse=True)[:3]
    one = spark.createDataFrame([(7, 5, "x")], "k int, g int, note string")
    store.change("t", one, lambda part: put_items(part, one).state)
    assert len(list((tmp_path / f"store/t.by_g/v={store.versions()[-1]:09d}").glob("_bucket=*"))) <= 2 and same() == [True, True]
    assert store.catalog().table("t").indexes == indexes and store.catalog().names() == ["t"]
    diff = spark.createDataFrame([("note", "S", "drop")], "attribute string, descriptor string, change string")
    store.evolve("t", diff)
    assert store.index_table("t", "by_g").df.columns == ["k", "g", "w"] and same() == [True, True]
    with pytest.raises(ValidationError):
        store.evolve("t", spark.createDataFrame([("g", "N", "drop")], "attribute string, descriptor string, change string"))
    before = rows(store.index_table("t", "by_g").df)
    assert store.vacuum() and rows(store.index_table("t", "by_g").df) == before


def test_a_deep_offset_opens_one_range(spark, store):
    rng = random.Random(3)
    items = [(k, rng.choice([None, 1.5, 2.5, rng.random()])) for k in range(997)]
    table = ItemTable("t", spark.createDataFrame(items, "k long, w double").repartition(3), "k")
    store.commit_sorted(table, ["w"], 20)
    order = sorted(items, key=lambda r: (r[1] is not None, r[1] or 0.0, r[0]))
    for offset, limit in ((0, 10), (500, 7), (990, 50), (997, 5), (2000, 1), (40, 0), (0, 997)):
        assert [tuple(r) for r in store.sorted_page("t", offset, limit).collect()] == order[offset : offset + limit]
        assert [tuple(r) for r in store.sorted_page("t", offset, limit, ascending=False).collect()] == order[::-1][offset : offset + limit]
    assert len(store.sorted_page("t", 700, 3).inputFiles()) <= 2 and store.count("t") == 997 and store.read("t").count() == 997
    store.commit_sorted(table.with_df(table.df.limit(0)), ["w"], 4)
    assert store.sorted_page("t", 0, 5).collect() == [] and store.vacuum() and store.read("t").count() == 0
    store.commit({"t": table.df})
    for wrong in (lambda: store.sorted_page("t", 0, 5), lambda: store.change("t", table.df, lambda part: part.df)):
        with pytest.raises(ValidationError):
            wrong()


def test_batch_gets_leave_stored_items_in_place(spark, store, table, tmp_path):
    store.commit({"t": table}, buckets=16)
    spark.createDataFrame([(7, 1), (8, 2), (4000, 1)], "k long, s long").write.parquet(str(tmp_path / "asked"))
    asked = spark.read.parquet(str(tmp_path / "asked"))
    found = batch_get(store.lookup("t", asked), asked)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert rows(found) == [(7, 1, 14), (8, 2, 16)] and "BroadcastHashJoin" in plan and "Exchange hashpartitioning(k" not in plan.split("BroadcastExchange")[0]


# -- change sets --------------------------------------------------------------------------------

REQUEST = "k int, op string, seq long, s string, n double, _present array<string>"


@pytest.mark.parametrize(("buckets", "batches"), [(None, 50), (4, 20)])
def test_levels_stay_bounded(spark, store, buckets, batches):
    rng = random.Random(4)
    base = ItemTable("t", spark.createDataFrame([(k, f"s{k}", float(k)) for k in range(30)], "k int, s string, n double"), "k")
    store.commit({"t": base}, buckets=buckets)
    log, want = MutationLog(store, "t", ["k"], fan=3), {r["k"]: r.asDict() for r in base.df.collect()}
    opened = []
    for batch in range(batches):
        requests = []
        for seq in range(rng.randint(1, 5)):
            k, kind, part = rng.randint(0, 40), rng.choice(["put", "put", "delete"]), rng.choice([["s"], ["n"], ["s", "n"]])
            requests.append((k, kind, batch * 10 + seq, f"b{batch}", float(seq), part))
            if kind == "delete":
                want.pop(k, None)
            else:
                item = want.setdefault(k, {"k": k, "s": None, "n": None})
                item.update({c: {"s": f"b{batch}", "n": float(seq)}[c] for c in part})
        df = spark.createDataFrame(requests, REQUEST)
        log.append(df, batch)
        if batch % 16 == 7:
            log.append(df, batch)  # delivered again, merged or not
        opened.append(sum(len(s) for s in log.sets().values()))
        if batch == batches * 3 // 5:
            log.compact()
    assert max(opened) <= 2 * 4
    assert rows(log.state()) == sorted(((i["k"], i["s"], i["n"]) for i in want.values()), key=repr)
    # what was merged is gone but for the last round
    left = [n for n in store._names("t/changes/run=000000-direct")]
    assert len(left) <= opened[-1] + 3
    log.compact()
    assert rows(store.read("t")) == rows(log.state()) and not any(log.sets().values())


def test_a_batch_that_comes_too_late(spark, store):
    store.commit({"t": ItemTable("t", spark.createDataFrame([(0, "a")], "k int, s string"), "k")})
    log = MutationLog(store, "t", ["k"], fan=2)
    put = lambda k, b: log.append(spark.createDataFrame([(k, "put", 1, f"s{b}")], "k int, op string, seq long, s string"), b)
    put(1, 0)
    put(2, 2)
    with pytest.raises(ValidationError, match="batch 1 comes after"):
        put(3, 1)
    put(2, 2)
    assert rows(log.state()) == [(0, "a"), (1, "s0"), (2, "s2")]


def test_compaction_writes_touched_buckets(spark, store, tmp_path):
    store.commit({"t": ItemTable("t", spark.range(100).select(F.col("id").cast("int").alias("k"), F.lit("a").alias("s")), "k")}, buckets=16)
    log = MutationLog(store, "t", ["k"])
    log.append(spark.createDataFrame([(5, "put", 1, "b")], "k int, op string, seq long, s string"), 0)
    version = log.compact()
    assert len(folders(tmp_path, version)) == 1 and rows(log.state().where("s = 'b'")) == [(5, "b")] and log.state().count() == 100


# -- change records -----------------------------------------------------------------------------


def test_sequence_has_no_gap(spark):
    old = ItemTable("t", spark.range(500).withColumn("v", F.lit(1)), "id")
    feed = change_feed(old, spark.range(250, 700).withColumn("v", (F.col("id") % 2).cast("int")))
    got = sequenced(feed, 3, 99, first=11, ranges=8).collect()
    assert sorted(r["sequence"] for r in got) == list(range(11, 11 + len(got))) and len({r["event_id"] for r in got}) == len(got)
    again = sequenced(feed.repartition(7), 3, 99, first=11).collect()
    assert {(r["keys"], r["sequence"], r["event_id"]) for r in got} == {(r["keys"], r["sequence"], r["event_id"]) for r in again}
    assert {(r["version"], r["created_at"]) for r in got} == {(3, 99)} and sequenced(feed.limit(0), 3, 99).collect() == []
    both = feed.unionByName(feed.withColumn("table", F.lit("u")))
    assert sorted(r["sequence"] for r in sequenced(both, 3, 99).collect()) == list(range(1, 2 * len(got) + 1))


def test_changes_between_versions(spark, store, table):
    store.commit({"t": table}, buckets=16)
    asked = spark.createDataFrame([(7, 1), (900, 2)], "k long, s long")
    store.change("t", asked, lambda part: put_items(part, asked.withColumn("v", F.lit(0))).state)
    found = changes_between(store, "t", 1, 2)
    got = {(r["keys"], r["event_name"]) for r in found.collect()}
    assert got == {('{"k":7,"s":1}', "MODIFY"), ('{"k":900,"s":2}', "INSERT")}
    assert len(store.changed_buckets("t", 1, 2)) <= 2 and changes_between(store, "t", 2, 2).collect() == []
    assert found.first()["created_at"] == store.manifest(2)["time"] > 0
    store.commit({"t": table}, buckets=8)
    with pytest.raises(ValidationError):
        changes_between(store, "t", 2, 3)


# -- values that do not fit ---------------------------------------------------------------------


@pytest.fixture
def numbers(spark):
    schema = "id bigint, n bigint, st struct<a: int, m: map<string, int>>, l array<int>, d decimal(9,2)"
    return ItemTable("t", spark.createDataFrame([(1, 1, (1, {"x": 1}), [1, 2], None), (2, 2, (2, {"x": 2}), [3], None)], schema), "id")


@pytest.mark.parametrize("key", ["1.00000000001", "1.5", "1e-12", "x", "1" + "0" * 30, "0.99999999999999999999"])
def test_a_key_that_does_not_fit_meets_no_item(spark, numbers, key):
    result = put_items(numbers, spark.createDataFrame([(key, 9)], "id string, n int"))
    assert rows(result.state) == rows(numbers.df) and [r["code"] for r in result.failures.collect()] == ["ValidationException"]


@pytest.mark.parametrize("value", [1.00000000001, 1e-11, 0.5, float("nan"), float("inf"), 1e19])
def test_doubles_that_do_not_fit(spark, numbers, value):
    asked = spark.createDataFrame([(1, value)], "id long, x double")
    for text in ("SET n = :x", "ADD n :x", "SET n = n - :x"):
        result = update_items(numbers, asked, text, values={":x": F.col("x")})
        assert rows(result.state) == rows(numbers.df) and result.failures.count() == 1
    assert put_items(numbers, asked.select("id", F.col("x").alias("n"))).failures.count() == 1


@pytest.mark.parametrize(
    ("text", "value", "good"),
    [("SET st.a = :v", 1.5, 4.0), ("SET st.m.x = :v", "2.00000000001", "3"), ("SET l[0] = :v", 0.5, 7.0), ("SET l = list_append(l, :v)", [1.5], [5.0]), ("ADD l :v", [2.5], [9.0])],
)
def test_members_that_do_not_fit(spark, numbers, text, value, good):
    asked = spark.createDataFrame([(1,)], "id long")
    bad = update_items(numbers, asked, text, values={":v": value})
    assert rows(bad.state) == rows(numbers.df) and bad.failures.count() == 1
    fine = update_items(numbers, asked, text, values={":v": good})
    assert rows(fine.state) != rows(numbers.df) and fine.failures.count() == 0


def statements(spark):
    found = Catalog(spark)
    found.register_table("t", spark.createDataFrame([(1, 5, "a"), (2, 6, "b")], "k long, n long, s string"), "k")
    return found


@pytest.mark.parametrize(
    "text", ["INSERT INTO t VALUE {'k': 1.5, 'n': 3}", "INSERT INTO t VALUE {'k': 3, 'n': 1.5}", "INSERT INTO t VALUE {'k': 3, 'n': 'abc'}", "UPDATE t SET n = 1.5", "UPDATE t SET n = 'abc'"]
)
def test_statements_refuse_and_spoil_nothing(spark, text):
    found = statements(spark)
    result = execute_statement(found, text)
    assert {r["code"] for r in result.failures.collect()} == {"ValidationException"}
    assert rows(found.table("t").df) == [(1, 5, "a"), (2, 6, "b")]
    execute_statement(found, "INSERT INTO t VALUE {'k': 3, 'n': 7, 's': 'c'}")
    execute_statement(found, "DELETE FROM t WHERE k = 1")
    assert rows(found.table("t").df) == [(2, 6, "b"), (3, 7, "c")]


@pytest.mark.parametrize("text", ["UPDATE t SET n = n / (k - 1)", "DELETE FROM t WHERE CAST(s AS INT) = 1", "UPDATE t SET s = 'x' WHERE 1 / (k - 2) > 0"])
def test_statements_that_fail_leave_the_table(spark, text):
    found = statements(spark)
    with pytest.raises(ValidationError, match="statement fails"):
        execute_statement(found, text)
    assert rows(found.table("t").df) == [(1, 5, "a"), (2, 6, "b")]


def test_literals_keep_their_digits(spark):
    found = statements(spark)
    literals = spark.createDataFrame([("9007199254740993", "4.5"), ("4", "4")], "k string, n string")
    result = insert_value(found.table("t"), literals, literals=True)
    assert rows(result.state.select("k", "n")) == [(1, 5), (2, 6), (4, 4)] and rows(result.failures) == [(9007199254740993, "ValidationException")]


# -- indexes ------------------------------------------------------------------------------------


def test_metadata_gives_indexes_back(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0, "x")], "id string, n double, m double, s string")
    table = ItemTable("t", df, "id", indexes={"by_n": Index("n", "m"), "thin": Index("m", include=("s",))})
    metadata = table_metadata(ItemTable("t", df, "id")).unionByName(index_metadata(table))
    found = Catalog(spark)
    assert register_from_metadata(found, metadata, {"t": df}) == ["by_n", "t", "thin"]
    got = found.table("t")
    assert got.indexes["by_n"] == Index("n", "m") and set(got.index("thin").df.columns) == set(table.index("thin").df.columns)
    assert (got.indexes["thin"].partition_key, got.indexes["thin"].sort_key) == ("m", None) and index_metadata(ItemTable("t", df, "id")) is None
    register_from_metadata(found, table_metadata(table), {"t": df})
    assert set(found.table("t").indexes) == {"by_n", "thin"} and found.table("t").indexes["thin"] == Index("id")


# -- scratch data -------------------------------------------------------------------------------


def test_scratch_data_goes_with_its_scope(spark, tmp_path):
    root = str(tmp_path / "shared")
    assert scratch_dir(spark, "x", root).startswith(root + "/x-")
    with scratch(spark, root) as folder:
        path = scratch_dir(spark, "rows")
        spark.range(5).write.parquet(path)
        with scratch(spark) as inner:
            assert inner.startswith(folder) and scratch_dir(spark, "rows").startswith(inner)
        assert path.startswith(folder) and spark.read.parquet(path).count() == 5
    assert not (tmp_path / "shared").exists() or list((tmp_path / "shared").iterdir()) == []
    assert not scratch_dir(spark, "x").startswith(root)


def test_a_large_bucket_is_written_by_several_tasks(spark, tmp_path):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "100000")
    try:
        store = SnapshotStore(spark, str(tmp_path))
        rows = spark.range(0, 200_000, 1, 8).selectExpr("id", "sha2(string(id), 256) AS note")
        store.commit({"t": ItemTable("t", rows, "id")}, buckets=2)
        assert len(store.read("t").inputFiles()) > 4
        assert store.count("t") == store.read("t").distinct().count() == 200_000
    finally:
        spark.conf.set(key, before)
