"""Every operator query with a SQL twin, side by side with it."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))

import check_oracle  # noqa: E402
from daybook.llm.oracle import ORACLE  # noqa: E402
from daybook.llm.queries import QUERIES  # noqa: E402


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, sf_dir, name):
    con = duckdb.connect()
    check_oracle.register(con, sf_dir)
    result = check_oracle.compare(spark, con, sf_dir, name)
    assert result.startswith("ok") and result != "ok 0", result
