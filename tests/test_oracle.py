"""Every registered query with an oracle equals DuckDB on the same tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from conftest import SF_SMALL  # noqa: E402
from oracle_check import compare, duck  # noqa: E402

ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_duckdb(spark, con, name):
    r = compare(spark, name, E.queries()[name], ORACLES[name], SF_SMALL, con, verbose=True)
    assert r["cols_ok"], r
    assert r["rows"] == r["oracle_rows"], r
    assert r["values_ok"], r


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert set(df.columns) == {"work_type", "split", "n_rows", "positive_rate", "mean_net_capital_log"}
