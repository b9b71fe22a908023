"""Every registered query against its SQL in DuckDB."""

import pytest
from compare import connect, mismatch

from __spark_entry__ import entry, oracle_sql

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, con, name):
    assert mismatch(spark, con, name, SF) is None


def test_entry(spark):
    assert entry(spark).count() > 0
