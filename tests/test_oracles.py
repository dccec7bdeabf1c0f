"""Every query of the library against its SQL in DuckDB, on the smallest tables."""

import glob
import os

import duckdb
import pytest

from siftstone.queries import QUERIES, SQL

D = "/root/testdata/sf0.001"


def norm(v):
    if isinstance(v, float):
        return float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(map(norm, v))
    if type(v).__name__ == "Decimal":
        return float(v) if v % 1 else int(v)
    return v


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    c.execute("set timezone='UTC'")
    for p in glob.glob(f"{D}/*.parquet"):
        c.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, D)
    cols = sorted(df.columns)
    got = sorted(repr(tuple(map(norm, r))) for r in df.select(*cols).collect())
    if name in SQL:
        rel = db.sql(SQL[name])
        assert sorted(rel.columns) == cols
        want = sorted(repr(tuple(map(norm, r))) for r in rel.project(", ".join(f'"{c}"' for c in cols)).fetchall())
        assert got == want
    else:
        assert got
