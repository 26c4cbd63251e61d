"""Every query of the library against its SQL, and the entry point's contract."""

import pytest

import voxelmill.queries as q
from tests import oracle

QUERIES, SQL = q.queries(), q.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, sf_dir, con, name):
    oracle.same(QUERIES[name](spark, sf_dir), con, SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_has_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry_gives_rows(spark):
    import __spark_entry__ as e

    assert e.entry(spark).limit(1).count() == 1
    assert set(e.oracle_sql()) <= set(e.queries())
