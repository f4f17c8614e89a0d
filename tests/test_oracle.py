"""Every registered query with oracle SQL equals DuckDB on the same tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import compare, duck  # noqa: E402

from conftest import SF_SMALL  # noqa: E402

SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    info = compare(spark, con, name, E.queries()[name], SQL[name], SF_SMALL)
    assert info["ok"], info


def test_every_query_has_a_builder():
    assert set(SQL) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "share_drifted_columns" in df.columns
