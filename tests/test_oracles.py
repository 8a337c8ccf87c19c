"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as contract
from finflow.plans import catalog
from oracle import compare, connect

QUERIES, ORACLES = catalog.QUERIES, catalog.ORACLES


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, small, con, name):
    df = QUERIES[name](spark, small)
    if name in ORACLES:
        assert compare(df, con, ORACLES[name]) is None
    else:
        assert df.count() > 0


def test_flagship_has_rows(spark):
    assert contract.entry(spark).count() > 0


def test_oracles_name_queries():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())
