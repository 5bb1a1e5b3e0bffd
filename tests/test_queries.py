"""Every registered query against its SQL, on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

from nivalis.plans import all_queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = all_queries()


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return str(v) if hasattr(v, "isoformat") else v


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, tables, name):
    df = QUERIES[name](spark, SF)
    want = tables.sql(SQL[name])
    names = sorted(df.columns)
    assert names == sorted(want.columns)
    rows = sorted((tuple(plain(r[n]) for n in names) for r in df.collect()), key=repr)
    assert rows == sorted((tuple(plain(r[want.columns.index(n)]) for n in names) for r in want.fetchall()), key=repr)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_runs(spark, name):
    df = QUERIES[name](spark, SF)
    rows = df.collect()
    assert rows and all(len(r) == len(df.columns) for r in rows)
