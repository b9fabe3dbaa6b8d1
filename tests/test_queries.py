"""Every registered query against its SQL on the smallest fixture."""

import pytest
from oracle import connect, difference

import __spark_entry__ as driver
from coterie.plans.catalog import ALL_QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(ALL_QUERIES))
def test_query(spark, connection, name):
    query = ALL_QUERIES[name]
    if query.sql is None:
        assert query.run(spark, SF_DIR).count() > 0
    else:
        assert difference(spark, connection, SF_DIR, query.run, query.sql) is None


def test_driver_contract(spark):
    assert driver.entry(spark).count() > 0
    assert set(driver.oracle_sql()) <= set(driver.queries())
