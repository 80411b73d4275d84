"""Every query with SQL held against DuckDB on the smallest tables; the rest must run."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

DATA = os.environ.get("COTEJO_TEST_DATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
FAST = [n for n in entry.queries() if n not in ("native_revenue_cube",)]


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("set timezone='UTC'")
    for f in os.listdir(DATA):
        c.execute(f"create view {f.split('.')[0]} as select * from read_parquet('{DATA}/{f}')")
    return c


def canonical(columns, data):
    order = sorted(range(len(columns)), key=lambda k: columns[k])

    def one(v):
        return f"{v:.8g}" if isinstance(v, float) else repr(v)

    return sorted(tuple(one(r[k]) for k in order) for r in data)


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns


@pytest.mark.parametrize("name", FAST)
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, DATA)
    data = [tuple(r) for r in df.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert len(df.columns) > 0
        return
    found = duck.execute(sql)
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(df.columns)
    assert canonical(df.columns, data) == canonical(columns, found.fetchall())
