"""Every registered query of the library's own operators against DuckDB, on the smallest tables."""

import math
import os

import duckdb
import pytest

from quarrystone.plans.catalog import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in os.listdir(FOLDER):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{f}'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v.isoformat().replace("T00:00:00", "") if hasattr(v, "isoformat") else v


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL) and len(QUERIES) > 70


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, FOLDER)
    got = [tuple(plain(r[c]) for c in sorted(df.columns)) for r in df.collect()]
    rel = db.execute(SQL[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == sorted(df.columns)
    want = [tuple(plain(r[names.index(c)]) for c in sorted(names)) for r in rel.fetchall()]
    assert sorted(map(str, got)) == sorted(map(str, want))
