"""Every registered query against its DuckDB oracle (rows + values), at a small scale factor."""

import os

import pytest

import __spark_entry__ as E
from effdated.plans.driver_queries import all_queries
from oracle import compare, duck

SF = os.environ.get("EFFDATED_TEST_SF", "/root/testdata/sf0.001")
NAMES = sorted(all_queries()[0])  # the queries of llm/ have their tests in tests/llm


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
        return
    ok, msg = compare(df, con, sql)
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert len(df.columns) > 10
    assert df.count() > 0
