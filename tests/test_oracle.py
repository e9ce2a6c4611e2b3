"""Every registered query against its DuckDB twin (as the driver checks it)."""

import pytest

from tidemark.plans.catalog import QUERIES
from tidemark.plans.oracle import oracle_sql
from tools.check_oracle import compare, duck

SQLS = oracle_sql()


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, sf_small, name):
    line, ok = compare(spark, con, name, QUERIES[name], SQLS.get(name), sf_small)
    assert ok, line


def test_entry_contract(spark):
    import __spark_entry__ as e
    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
