"""Every registered query against its SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

from gridloom.plans.catalog import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        c.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


def plain(rows, columns):
    def one(x):
        return round(float(x), 5) if isinstance(x, (int, float)) and not isinstance(x, bool) else x

    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(one(r[i]) for i in order) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, DATA)
    got = [tuple(r) for r in df.collect()]
    if name not in ORACLES:
        assert df.columns and len(got) > 0
        return
    want = db.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert plain(got, df.columns) == plain(want.fetchall(), want.columns)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() >= 0 and set(e.oracle_sql()) <= set(e.queries())
