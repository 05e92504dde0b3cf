"""Every registered query against its SQL twin on the smallest tables."""

import glob
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_queries import kinds, table_of

SQL = oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(os.path.join(sf_dir, "*.parquet")):
        name = os.path.basename(path)[:-8]
        connection.execute(f"create view {name} as select * from '{path}'")
    return connection


def test_entry(spark):
    df = entry(spark)
    assert len(df.columns) == 104 and df.count() == 1000


def test_every_sql_has_a_query():
    assert set(SQL) <= set(queries()) and len(queries()) > 100


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, duck, sf_dir, name):
    df = queries()[name](spark, sf_dir)
    names, rows = table_of(df.columns, [tuple(r) for r in df.collect()])
    if name not in SQL:
        assert rows
        return
    result = duck.execute(SQL[name])
    want_names, want = table_of([c[0] for c in result.description], result.fetchall())
    assert names == want_names
    assert rows == want
    assert kinds(rows) == kinds(want)
