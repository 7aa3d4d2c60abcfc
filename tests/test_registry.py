"""Every registered query against its SQL, on the smallest scale of the driver's tables."""

import os

import pytest
from pyspark.sql import SparkSession

from __spark_entry__ import entry, oracle_sql, queries
from registry import ORACLES, QUERIES
from tests.compare import connect, difference

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark: SparkSession, con, name):
    assert difference(queries()[name](spark, SF_DIR), con, oracle_sql()[name]) == ""


def test_entry(spark):
    assert entry(spark).count() > 0
