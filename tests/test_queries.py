"""Driver queries against their SQL on small tables, where those are there."""

import glob
import os

import duckdb
import pytest

from tidelog.plans.oracle import ORACLE
from tidelog.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


def _norm(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, SF)
    rows = sorted(repr([_norm(r[c]) for c in sorted(df.columns)]) for r in df.collect())
    assert rows or name in ORACLE
    if name in ORACLE:
        found = db.sql(ORACLE[name])
        at = [found.columns.index(c) for c in sorted(found.columns)]
        assert sorted(df.columns) == sorted(found.columns)
        assert rows == sorted(repr([_norm(r[i]) for i in at]) for r in found.fetchall())


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
