"""Queries with SQL equal DuckDB's result (sf0.001)."""

import pytest

from gearbox.llm.queries import ORACLE_SQL, QUERIES
from oracle_compare import compare, duck

SF_SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_duckdb(spark, name):
    res = compare(QUERIES[name](spark, SF_SMALL), ORACLE_SQL[name], duck(SF_SMALL))
    assert res["ok"], res
