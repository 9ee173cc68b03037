"""Every registered query against its SQL on whole tables, and the shape of its plan."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from footings.queries.registry import REGISTRY
from tests.oracle import EMPTY, compare, connect

SF_DIR = os.environ.get("FOOTINGS_SF_DIR", "/root/testdata/sf0.001")
QUERIES = {name: fn for name, fn in queries().items() if name in REGISTRY}
SQL = {name: sql for name, sql in oracle_sql().items() if name in REGISTRY}


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan
    # On the smallest tables a query may rightly find nothing, as long as both sides do.
    assert compare(df, con, SQL[name]) in (None, EMPTY)


def test_every_query_has_an_oracle():
    assert set(SQL) == set(QUERIES)


def test_entry_runs(spark):
    assert entry(spark).count() > 0
