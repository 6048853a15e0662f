"""Every registered query against its SQL check."""

import pytest

from ledgerlake.plans.catalog import spark_queries, sql_checks
from tests.compare import connect, difference

SF = "/root/testdata/sf0.01"
QUERIES, CHECKS = spark_queries(), sql_checks()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_matches_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF), con, CHECKS[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(CHECKS)))
def test_rows_only(spark, name):
    df = QUERIES[name](spark, SF)
    assert df.columns and df.count() > 0
