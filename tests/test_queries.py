"""Every registered query against its SQL counterpart on the smallest tables."""

import pytest
from compare import difference, duck

import __spark_entry__ as entry
from dailypanel.queries.all import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(small):
    return duck(small)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, small, con, name):
    got = QUERIES[name](spark, small).toPandas()
    assert list(got.columns)
    if name in ORACLES:
        assert difference(got, con.execute(ORACLES[name]).df()) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
