"""Registered queries against their SQL in DuckDB, on the smallest tables."""

import math
import os

import duckdb
import pytest

from towerline import plans

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 3) + 0.0
    return v


@pytest.mark.parametrize("name", [n for n in plans.ORACLE if n.endswith(("_cells", "_states", "_day", "_join", "_gaps", "_week")) or n[:3] in ("b03", "c05", "c08", "d12", "d20", "e12", "g05", "h06", "h16", "a01", "j06")])
def test_query_matches_sql(spark, con, name):
    df = plans.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    have = sorted(repr(tuple(plain(r[c]) for c in cols)) for r in df.collect())
    rel = con.sql(plans.ORACLE[name])
    at = [rel.columns.index(c) for c in cols]
    want = sorted(repr(tuple(plain(r[i]) for i in at)) for r in rel.fetchall())
    assert sorted(rel.columns) == cols and have == want


def test_every_oracle_has_a_query():
    assert set(plans.ORACLE) <= set(plans.QUERIES)


def test_entry_runs(spark):
    import __spark_entry__ as e

    assert e.entry(spark).limit(1).count() == 1
    assert set(e.oracle_sql()) <= set(e.queries())
