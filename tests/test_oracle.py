"""Every registered query with an oracle equals DuckDB's result (sf0.001)."""

import pytest

import __spark_entry__ as entry
from settings import SF_SMALL
from gearbox.plans.registry import REGISTRY
from oracle_compare import compare, duck

# the model queries fit at the original settings (minutes): tests/test_models.py covers them at small ones
SQL = {n: q.sql for n, q in REGISTRY.items() if q.sql is not None and not q.fn.__module__.endswith("queries_models")}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_duckdb(spark, con, name):
    res = compare(entry.queries()[name](spark, SF_SMALL), SQL[name], con)
    assert res["ok"], res


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 3
    assert sorted(r["label"] for r in rows) == [0.0, 1.0, 2.0]


def test_every_query_has_inventory_ids():
    assert all(q.sql is not None for q in REGISTRY.values())
    assert all(q.ops for q in REGISTRY.values())
    assert set(SQL) <= set(entry.queries())
