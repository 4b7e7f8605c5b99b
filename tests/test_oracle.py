"""Every registered query that has SQL equals DuckDB on the smallest tables."""

import pytest

from catalog import load_all
from oracle import compare, connect

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE = load_all()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, name):
    msg, _ = compare(spark, con, QUERIES[name], ORACLE[name], SF)
    assert msg is None, msg


def test_sql_only_for_registered_queries():
    assert set(ORACLE) <= set(QUERIES)
