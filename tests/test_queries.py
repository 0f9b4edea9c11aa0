from __future__ import annotations

import datetime
import os

import duckdb
import pytest

from folioflow.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for name in os.listdir(SF):
        con.sql(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{name}'")
    return con


def plain(value):
    return value.replace(tzinfo=None).isoformat() if isinstance(value, datetime.datetime) else repr(value)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    want = duck.sql(ORACLE_SQL[name])
    assert sorted(want.columns) == columns
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    at = [want.columns.index(c) for c in columns]
    assert got == sorted(tuple(plain(r[i]) for i in at) for r in want.fetchall())


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - ORACLE_SQL.keys()))
def test_query_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(QUERIES) <= set(__spark_entry__.queries())
