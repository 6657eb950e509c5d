"""The registered queries of the operators against their SQL answers, where SQL has one."""

import pytest

from deskflow.llm.queries import ORACLES, QUERIES
from tests.compare import compare, connect


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, base, name):
    con = connect(base)
    assert compare(con, QUERIES[name](spark, base), ORACLES[name]) == []
    con.close()


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
