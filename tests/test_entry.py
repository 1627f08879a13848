import pytest

import __spark_entry__ as e

from .check import compare, duck

SF = "/root/testdata/sf0.001"
QUERIES = {name: run for name, run in e.queries().items() if name not in e.LLM_QUERIES}
SQL = {name: sql for name, sql in e.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_flagship(spark):
    df = e.entry(spark)
    assert df.columns == ["did", "tags", "os"] and df.count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    ok, note = compare(spark, con, SF, name, QUERIES[name], SQL.get(name))
    assert ok, note


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(SQL)
