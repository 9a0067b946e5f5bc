"""Every registered query against its SQL twin, on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tools.compare import connect, difference

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    assert difference(queries()[name](spark, SF), duck.sql(oracle_sql()[name])) is None


def test_entry(spark):
    assert entry(spark).count() > 0
