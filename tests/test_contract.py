"""Registered queries against their SQL on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables")
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in DATA.glob("*.parquet"):
        c.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return c


def plain(v):
    return ("NaN" if math.isnan(v) else round(v, 6) + 0.0) if isinstance(v, float) else float(v) if type(v).__name__ == "Decimal" else v


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, str(DATA))
    cur = con.execute(ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(names)
    want = sorted((tuple(plain(r[names.index(c)]) for c in sorted(names)) for r in cur.fetchall()), key=str)
    got = sorted((tuple(plain(r[c]) for c in sorted(names)) for r in df.collect()), key=str)
    assert got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_runs(spark, name):
    assert QUERIES[name](spark, str(DATA)).count() >= 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
