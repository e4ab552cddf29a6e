"""Every query with SQL equals it on the smallest tables; the others give rows."""

import pytest

import __spark_entry__ as entry_points
from tests.compare import difference, duck

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_gives_rows(spark, name):
    assert not QUERIES[name](spark, SF_DIR).isEmpty()


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns[:2] == ["TimestampHour", "SettlementPoint"]
    assert df.count() == 1531


def test_sql_names_known_queries():
    assert set(SQL) <= set(QUERIES)
