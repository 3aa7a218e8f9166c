"""Every registered query against its SQL on the smallest tables."""

import pytest
from compare import connect, difference

from __spark_entry__ import entry, oracle_sql, queries
from kerbside.workload import registry

SF = "/root/testdata/sf0.001"
SQL = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(registry.queries()))
def test_query(spark, con, name):
    df = queries()[name](spark, SF)
    if name in SQL:
        assert difference(df, con, SQL[name]) is None
    else:
        assert df.count() > 0


def test_names():
    assert set(SQL) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0
