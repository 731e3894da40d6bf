"""Every registered query against its SQL, with broadcast joins and without, and its plan."""

import pytest
from oracle import compare, connect

import __spark_entry__ as contract
from itemloom.operators import write
from itemloom.plans.registry import QUERIES, SQL

#: queries whose plan turns on the size of the request side
#: queries that walk whole documents, in Arrow batches
WALKS = ("cod6_", "cod8_", "cod9_")

JOINED = [n for n in QUERIES if n.startswith(("mut1_", "mut2_", "mut3", "mut10_return_updated_new", "upd1_", "upd7", "upd16", "upd17", "txn1_c", "txn2"))]


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_contract(spark):
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows(spark, sf, con, name):
    assert compare(QUERIES[name](spark, sf), con, SQL[name]) is None


@pytest.mark.parametrize("name", JOINED)
def test_same_rows_when_requests_travel(spark, sf, con, name, monkeypatch):
    monkeypatch.setattr(write, "requests_travel", lambda items, requests: True)
    assert compare(QUERIES[name](spark, sf), con, SQL[name]) is None


@pytest.mark.parametrize("name", list(QUERIES))
def test_plan_stays_in_spark(spark, sf, name):
    if name.startswith(("src3", "src4", "sink", "str3", "txn5", "cod2_deep", "agg1_stored", "joi2_stored", "str1_between", "joi4_pinned", "src8_readded", "pag6_stored", "pag3_stored")):
        pytest.skip("runs jobs of its own")
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    python = ("BatchEvalPython",) if name.startswith(WALKS) else ("PythonUDF", "EvalPython", "ArrowEval")
    for word in (*python, "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_reach_the_scan(spark, sf):
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,450000.0)]" in plan_of(QUERIES["src5_scan_filter"](spark, sf))
    assert "StringStartsWith(o_orderpriority,1-)" in plan_of(QUERIES["flt5_begins_with"](spark, sf))
    assert "EqualTo(o_orderkey,42)" in plan_of(QUERIES["joi1_get_item"](spark, sf))
    assert "EqualTo(user_id,7)" in plan_of(QUERIES["flt1_key_condition"](spark, sf))


def test_only_needed_columns_are_read(spark, sf):
    plan = plan_of(QUERIES["agg2_count_by_partition"](spark, sf))
    assert "ReadSchema: struct<ts:timestamp,user_id:bigint,event_type:string>" in plan or "ts:timestamp_ntz" in plan
    assert "props" not in plan and "value" not in plan


def test_pages_are_cut_before_the_shuffle(spark, sf):
    plan = plan_of(QUERIES["pag5_query_pages"](spark, sf))
    assert plan.count("Exchange") == 1
    assert plan.index("row_number(), 11, Final") < plan.index("Exchange") < plan.index("row_number(), 11, Partial")


def test_limits_need_no_global_sort(spark, sf):
    assert "TakeOrderedAndProject" in plan_of(QUERIES["pag2_limit"](spark, sf))


def test_puts_shuffle_each_side_once(spark, sf, shuffled):
    plan = plan_of(QUERIES["mut1_put_merge"](spark, sf))
    assert "FullOuter" in plan and plan.count("Exchange") == 2


def test_many_updates_combine_before_the_shuffle(spark, sf, shuffled):
    plan = plan_of(QUERIES["upd19_bulk"](spark, sf))
    assert "partial_sum" in plan and plan.count("Exchange") == 2
