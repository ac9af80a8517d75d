"""Every registered query against its SQL on the smallest tables."""
import pytest

import __spark_entry__ as entry
from oracle_check import compare, connect

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SF), con, ORACLES[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() == 6
