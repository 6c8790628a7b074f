"""Every registered query against its SQL on the smallest tables."""

import pathlib

import pytest

import __spark_entry__ as contract
from checks.catalog import ORACLES, QUERIES
from checks.compare import database, difference
from outagelens.operators import timeline

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not pathlib.Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return database(SF_DIR)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, name):
    assert name in ORACLES
    assert difference(spark, con, SF_DIR, name) is None


def test_contract(spark):
    assert QUERIES.keys() <= contract.queries().keys()
    assert contract.oracle_sql().keys() <= contract.queries().keys()
    assert QUERIES.keys() <= contract.oracle_sql().keys()
    assert contract.entry(spark).count() == 6


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_events_are_cut_before_the_shuffle(spark):
    from checks import views

    incidents = views.incidents(spark, SF_DIR)
    plan = plan_of(timeline.timeline_top(incidents, views.journal(spark, SF_DIR)))
    assert "row_number(), 20, Partial" in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(QUERIES["filter_recent"](spark, SF_DIR))
    assert "GreaterThanOrEqual(o_orderdate" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan


@pytest.mark.parametrize("name", QUERIES)
def test_no_cross_or_nested_loop_join(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
