"""Queries of the package that SQL can express, against DuckDB."""

import pytest

import __spark_entry__ as E
from martforge.llm import registry
from tests.conftest import SF_CHECK, SF_SMALL
from tools.oracle_check import check_query, duck_connection


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
@pytest.mark.parametrize("sf", [SF_SMALL, SF_CHECK])
def test_query_matches_oracle(spark, sf, name):
    ok, msg = check_query(spark, duck_connection(sf), sf, name, E.queries()[name], registry.ORACLE[name])
    assert ok, msg
