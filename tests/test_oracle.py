"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import os

import pytest
from compare import open_tables, spark_rows, sql_rows

import __spark_entry__ as driver

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


@pytest.fixture(scope="module")
def tables():
    return open_tables(SF_DIR)


def test_every_query_has_sql():
    # Corpus operators that SQL can't express have tests of their own.
    assert set(driver.QUERIES) == set(driver.ORACLE)
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query(spark, tables, name):
    assert spark_rows(driver.queries()[name](spark, SF_DIR)) == sql_rows(tables, driver.oracle_sql()[name])


def test_entry(spark):
    assert driver.entry(spark).count() > 0
