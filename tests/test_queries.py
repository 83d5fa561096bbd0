"""Every registered query against its SQL on the smallest data set."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, name):
    assert compare(spark, con, name, queries()[name], oracle_sql().get(name), SF) == ""


def test_entry(spark):
    assert entry(spark).count() > 0
