"""Every query that has SQL gives the same rows as the SQL, on the smallest test data."""

import glob
import os

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    if not os.path.isdir(SF):
        pytest.skip("no test data")
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for f in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_as_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    r = duck.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in r.description]
    assert sorted(columns) == sorted(df.columns)
    want = sorted(repr(row) for row in r.fetchall())
    assert sorted(repr(tuple(row[c] for c in columns)) for row in df.collect()) == want


def test_entry(spark):
    if not os.path.isdir(SF):
        pytest.skip("no test data")
    assert entry.entry(spark).count() > 0
