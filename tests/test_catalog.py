import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.check_oracle import compare, connect

DIRECTORY = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(DIRECTORY)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_oracle(spark, con, name):
    assert compare(queries()[name](spark, DIRECTORY), con, oracle_sql()[name]) == ""


def test_flagship_query_runs(spark):
    df = entry(spark)
    assert df.columns == ["snapshot_date", "provider_id", "metric_name", "metric_value"] and df.count() > 0
