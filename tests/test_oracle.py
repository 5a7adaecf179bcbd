"""Every check query with SQL against that SQL, on the smallest tables."""

import os

import pytest

import __spark_entry__ as contract
from checks.compare import compare, duckdb_views

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not here")


@pytest.fixture(scope="module")
def con():
    return duckdb_views(FOLDER)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    good, note = compare(spark, con, FOLDER, name, contract.queries(), contract.oracle_sql())
    assert good, note


def test_entry_is_the_churn_template(spark):
    out = contract.entry(spark)
    assert out.count() > 0
    assert {"UserId", "AvgTimeDelta", "Tag", "TotalValueperUniqueItemId"} <= set(out.columns)
