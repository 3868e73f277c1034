"""The registered queries against their SQL on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")
NAMES = sorted(k for k in entry.oracle_sql())


def plain(v):
    if isinstance(v, float):
        return repr(round(v, 9))
    return [plain(x) for x in v] if isinstance(v, (list, tuple)) else repr(v)


@pytest.fixture(scope="module")
def con():
    if not os.path.exists(DATA):
        pytest.skip("no test tables")
    c = duckdb.connect()
    for f in os.listdir(DATA):
        c.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{DATA}/{f}'")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, con, name):
    df = entry.queries()[name](spark, DATA)
    rel = con.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    at = [rel.columns.index(c) for c in df.columns]
    assert sorted(map(plain, (list(r) for r in df.collect())), key=str) == sorted(map(plain, ([r[i] for i in at] for r in rel.fetchall())), key=str)


def test_entry(spark):
    if not os.path.exists(DATA):
        pytest.skip("no test tables")
    assert entry.entry(spark).count() == 3 and set(entry.oracle_sql()) <= set(entry.queries())
