"""Every registered query against its SQL on the smallest given tables."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import compare, oracle
from dimlathe.catalogue import CATALOGUE

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="given tables not present")


@pytest.fixture(scope="module")
def con():
    return oracle(FOLDER)


@pytest.mark.parametrize("name", sorted(CATALOGUE))
def test_query_gives_the_rows_of_its_sql(name, spark, con):
    assert compare(queries()[name](spark, FOLDER), con, oracle_sql()[name]) is None


def test_entry(spark):
    assert entry(spark).count() > 0
