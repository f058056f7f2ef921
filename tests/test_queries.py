"""Every registered query against its SQL on the smallest tables, where those are present."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry

DATA = os.environ.get("TIDELOG_TEST_DATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(v):
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v


CORE = [n for n in entry.queries() if n[:2] not in ("p6", "p7", "p8")]


@pytest.mark.parametrize("name", CORE)
def test_query(spark, sql, name):
    df = entry.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    rows = sorted((tuple(plain(v) for v in r) for r in df.select(*columns).collect()), key=repr)
    text = entry.oracle_sql().get(name)
    if text:
        result = sql.sql(text)
        names = list(result.columns)
        assert sorted(names) == columns
        at = [names.index(c) for c in columns]
        assert rows == sorted((tuple(plain(r[i]) for i in at) for r in result.fetchall()), key=repr)


def test_entry(spark):
    assert entry.entry(spark).columns == ["db_name", "table_name", "record_key", "file_no", "log_pos"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
