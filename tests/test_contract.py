"""Every query that reads tables alone, beside its SQL twin on the smallest data."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as contract  # noqa: E402
import check_oracle  # noqa: E402
from daybook.plans.oracle import ORACLE  # noqa: E402
from daybook.plans.queries import QUERIES  # noqa: E402

# These run whole runs or streams, which the other tests cover.
LONG = {"kpi_upsert_replace", "kpi_upsert_recompute", "kpi_recompute_after_replace", "daily_run_category", "stream_order_daily_kpis", "stream_gate"}


@pytest.fixture(scope="module")
def con(sf_dir):
    connection = duckdb.connect()
    check_oracle.register(connection, sf_dir)
    return connection


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - LONG))
def test_query(spark, con, sf_dir, name):
    result = check_oracle.compare(spark, con, sf_dir, name)
    assert result.startswith("ok"), result
    assert result != "ok 0"


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["category", "order_date", "daily_revenue", "avg_order_value", "avg_return_rate"]
    assert df.count() > 0
