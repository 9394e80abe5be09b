"""Registered queries against their SQL in DuckDB, over whole tables."""
import datetime
import math

import duckdb
import pytest

from tessera.llm.queries import ORACLE, QUERIES

from .conftest import SF


def _plain(v):
    if isinstance(v, float) and math.isnan(v):
        return None
    assert not isinstance(v, datetime.datetime)
    return v


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, name):
    got = QUERIES[name](spark, SF)
    c = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = c.execute(ORACLE[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(got.columns)
    rows = [tuple(map(_plain, r)) for r in want.fetchall()]
    assert sorted(map(tuple, got.select(*columns).collect()), key=repr) == sorted(rows, key=repr)


def test_one_query_each():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == sorted(set(numbers)) and set(ORACLE) <= set(QUERIES)
