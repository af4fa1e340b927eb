"""Every catalogued query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__
from inkspan.plans import catalog
from tests.oracle import connection, differences


@pytest.fixture(scope="module")
def con(sf):
    return connection(sf)


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_equals_sql(spark, sf, con, name):
    assert differences(catalog.QUERIES[name](spark, sf), catalog.SQL[name], con) == ""


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.SQL)))
def test_gives_rows(spark, sf, name):
    assert catalog.QUERIES[name](spark, sf.replace("0.001", "0.01")).count() > 0


def test_entry(spark):
    df = __spark_entry__.entry(spark)
    assert df.count() > 0
    assert set(catalog.QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
