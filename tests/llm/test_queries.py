"""Registered queries: against SQL where there is some, else for their shape."""

import pytest

from footings.llm.queries import ORACLES, QUERIES
from tests.oracle import compare, connect


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, con, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert compare(df, con, ORACLES[name]) is None


@pytest.mark.parametrize("name", ["op5_secret_scans", "op7_sharding", "op11_decontamination"])
def test_native_queries_run_no_python(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_every_operator_is_registered():
    from __spark_entry__ import queries

    assert all(any(name.startswith(f"op{n}_") for name in queries()) for n in range(1, 14))
    assert "pipeline" in queries()
