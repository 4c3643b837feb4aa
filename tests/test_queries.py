"""Every registered query against its SQL, and plan shape checks."""

import re
from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from oracle_check import compare, connect

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SMALL).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_equals_sql(spark, con, name):
    df = queries()[name](spark, SMALL)
    sql = oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert compare(name, df, con, sql) == ""


def test_entry(spark):
    assert entry(spark).columns == ["source", "n_rows"]


# Queries that write before they return hide their plan behind a scan; these do not.
LAZY = ["win1_source_topk", "jn1_not_sent", "snk1_mark_sent", "set2_add_threads", "sig1_normalize", "txt1_page_text",
        "txt3_markdown", "txt5_script_segments", "win6_timeline", "int5_best_per_story", "int7_selection"]


@pytest.mark.parametrize("name", LAZY)
def test_plans_have_no_cross_join_and_no_python(spark, name):
    plan = queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|ArrowEvalPython|BatchEvalPython|MapInPandas", plan)


def test_topk_is_limited_before_the_shuffle(spark):
    plan = queries()["win1_source_topk"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange hashpartitioning(source"):]
    assert re.search(r"WindowGroupLimit .*row_number\(\), 20, Partial", below)


@pytest.mark.parametrize("name", ["txt1_page_text", "txt3_markdown", "txt5_script_segments", "err1_classify", "sig3_sweep_due"])
def test_row_transforms_do_not_shuffle(spark, name):
    assert "Exchange" not in queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()


def test_scans_are_pruned(spark):
    plan = queries()["err1_classify"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,error)]" in plan
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in plan


def test_uncached_threads_need_no_window(spark):
    plan = queries()["jn3_uncached_threads"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and plan.count("FileScan") <= 4


def test_funnel_reads_and_parses_payloads_once(spark):
    plan = queries()["agg3_sweep_funnel"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Union" not in plan and "Join" not in plan
