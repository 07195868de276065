"""Every registered query against its SQL twin."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import difference, oracle_connection

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF_DIR)


def test_twins_belong_to_queries():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0 and df.columns[0] == "level"


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, con, name):
    assert difference(spark, con, SF_DIR, queries()[name], oracle_sql()[name]) is None
