"""The text queries that have SQL, against it, on the smallest tables, where those are present."""

import glob
import os

import duckdb
import pytest

from tidelog.llm import queries

DATA = os.environ.get("TIDELOG_TEST_DATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, sql, name):
    df = queries.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    rows = sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
    if name in queries.ORACLE:
        result = sql.sql(queries.ORACLE[name])
        at = [list(result.columns).index(c) for c in columns]
        assert rows == sorted((tuple(r[i] for i in at) for r in result.fetchall()), key=repr)
