"""Every registered query against its SQL, on the smallest given tables."""

import os

import pytest

import __spark_entry__ as driver
from verification.compare import connect, difference
from verification.registry import ORACLE, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    actual = driver.queries()[name](spark, SF_DIR).toPandas()
    assert difference(actual, duck.execute(driver.oracle_sql()[name]).df()) is None
