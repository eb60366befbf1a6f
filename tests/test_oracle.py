"""Every registered query against its SQL on the smallest tables."""

import os

import pytest
from oracle_check import compare, connect

import __spark_entry__ as registered

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables absent")
from assetpulse.plans.catalog import all_queries  # noqa: E402
from assetpulse.plans.oracle import all_sql  # noqa: E402

#: The optional operators have tests of their own.
QUERIES, SQL = all_queries(), all_sql()
ROWS_ONLY = {"forest_predictions"}


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) - set(SQL) == ROWS_ONLY
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, connection, name):
    line = compare(spark, name, QUERIES[name], SQL[name], connection, SF_DIR)
    assert line.startswith("ok"), line


def test_forest_scores_the_test_days(spark):
    df = QUERIES["forest_predictions"](spark, SF_DIR)
    rows = df.collect()
    assert rows and all(0 <= row["failure_probability"] <= 1 for row in rows)
    assert {str(row["date"]) for row in rows} <= {f"2001-05-{day:02d}" for day in range(1, 31)}


def test_entry(spark):
    df = registered.entry(spark)
    assert df.count() > 0 and df.columns[:2] == ["customer_asset_identifier", "date"]
