"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry_points
from oracle import compare, connect

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_entry(spark):
    assert len(entry_points.entry(spark).collect()) > 0


def test_every_oracle_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(entry_points.queries()))
def test_query(spark, con, name):
    df = entry_points.queries()[name](spark, SF)
    sql = entry_points.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert compare(df, con, sql) is None
