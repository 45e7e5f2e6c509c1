"""Every registered query against its SQL on the smallest data."""

import duckdb
import pytest

import check
from __spark_entry__ import LLM_QUERIES, entry, oracle_sql, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in check.TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(queries()) - set(LLM_QUERIES) <= set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(set(queries()) - set(LLM_QUERIES)))
def test_query_equals_sql(spark, db, name):
    df = queries()[name](spark, SF)
    cursor = db.execute(oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(c.lower() for c in df.columns) == sorted(c.lower() for c in columns)
    got = check.rows_of(df.columns, df.collect())
    assert got and got == check.rows_of(columns, cursor.fetchall())
