"""Every registered query with SQL against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from tallyfold.catalog import all_queries

FOLDER = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(r[i]) if isinstance(r[i], float) else str(r[i]) for i in order) for r in values)


@pytest.mark.parametrize("query", [q for q in all_queries() if q.sql], ids=lambda q: q.name)
def test_query_equals_sql(spark, con, query):
    df = query.run(spark, FOLDER)
    answer = con.sql(query.sql)
    assert sorted(df.columns) == sorted(answer.columns)
    assert rows(df.columns, df.collect()) == rows(answer.columns, answer.fetchall())


@pytest.mark.parametrize("query", [q for q in all_queries() if not q.sql], ids=lambda q: q.name)
def test_query_without_sql_gives_rows(spark, query):
    assert query.run(spark, FOLDER).count() > 0


def test_contract(spark):
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
    assert entry_point.entry(spark).count() == 10
