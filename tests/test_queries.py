"""Every query against its SQL, and what all plans must have in common."""

import pytest

import __spark_entry__ as entry
from tests.conftest import plan_of
from tests.oracle import compare, connect
from workload.registry import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    plan = plan_of(df)
    assert not [n for n in (*PYTHON_NODES, "CartesianProduct", "BroadcastNestedLoopJoin") if n in plan]
    assert compare(df, duck, entry.oracle_sql()[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "city_state_rank" in df.columns


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(entry.queries()["watermark_inclusive"](spark, SF_DIR))
    assert "GreaterThanOrEqual(ts," in plan
    plan = entry.queries()["relationships_check"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_custkey:bigint>" in plan
