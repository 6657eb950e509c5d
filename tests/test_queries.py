"""Every registered query against its SQL answer."""

import pytest

import __spark_entry__ as entry_points
from deskflow.plans import ORACLES, QUERIES

from .compare import compare, connect


@pytest.fixture(scope="module")
def con(base):
    connection = connect(base)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, base, con, name):
    assert compare(con, QUERIES[name](spark, base), ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_returns_rows(spark, base, name):
    df = QUERIES[name](spark, base)
    assert df.count() > 0
    assert len(set(df.columns)) == len(df.columns)


def test_oracles_belong_to_queries():
    queries, oracles = entry_points.queries(), entry_points.oracle_sql()
    assert set(QUERIES) <= set(queries) and set(ORACLES) <= set(oracles) <= set(queries)


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
