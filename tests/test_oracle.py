"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as E
from martforge.plans import registry
from tests.conftest import SF_SMALL
from tools.oracle_check import check_query, duck_connection

# The optional subpackage has tests of its own; these hold without it.
QUERIES = {k: v for k, v in E.queries().items() if k in registry.QUERIES}
ORACLE = {k: v for k, v in E.oracle_sql().items() if k in registry.QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLE) == set()


def physical_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def check_plan(name):
    def inspect(df):
        plan = physical_plan(df)
        # No join without keys anywhere (scalar subqueries are used instead).
        assert "CartesianProduct" not in plan, plan
        assert "BroadcastNestedLoopJoin" not in plan, plan
        if name.startswith("dedup_"):
            # keep-first is limited in every map task before the shuffle
            assert "WindowGroupLimit" in plan and "Partial" in plan, plan
    return inspect


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = check_query(spark, con, SF_SMALL, name, QUERIES[name], ORACLE.get(name), check_plan(name))
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == E.entry(spark).columns
