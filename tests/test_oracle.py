"""Every named query equals its oracle SQL on the smallest test tables, value for value, and its plan
has neither a cross join nor Python rows."""

import re

import pytest

import __spark_entry__ as entry
from lakemart.plans.oracles import all_oracles
from lakemart.plans.registry import all_queries
from tests.oracle_compare import compare_frame, oracle_connection

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def con():
    return oracle_connection(FOLDER)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    assert compare_frame(df, con, ORACLES[name]) == []
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|EvalPython|InPandas|InArrow", plan)


def test_entry(spark):
    assert entry.entry(spark).columns[0] == "purchase_date"
