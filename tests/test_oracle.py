"""Every registered query equals its DuckDB oracle on the smallest driver tables."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from compare_oracle import canon, duck  # noqa: E402

SF = "/root/testdata/sf0.001"
QUERIES = entry.queries()
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    # corpus operators are tested against brute force where SQL cannot state them
    assert set(ORACLE) <= set(QUERIES)
    assert all(name == "pipeline" or name.startswith("op") for name in set(QUERIES) - set(ORACLE))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    s_cols, s_rows = canon(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(ORACLE[name])
    d_cols, d_rows = canon([c[0] for c in res.description], res.fetchall())
    assert s_cols == d_cols
    assert len(s_rows) == len(d_rows)
    assert s_rows == d_rows


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["category", "merchandise_revenue", "orders"]
    assert 0 < df.count() <= 10
