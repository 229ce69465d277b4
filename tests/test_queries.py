"""Every registered query against its DuckDB statement on the smallest tables."""

import math
import os
import sys

import duckdb
import pytest
from conftest import DATA

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as entry_point  # noqa: E402

QUERIES, ORACLE = entry_point.queries(), entry_point.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in os.listdir(DATA):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{file}'")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    return repr(value) if isinstance(value, float) else str(value)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    rows = df.collect()
    if name not in ORACLE:
        assert rows
        return
    cursor = duck.execute(ORACLE[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    expected = sorted(tuple(_plain(r[columns.index(c)]) for c in df.columns) for r in cursor.fetchall())
    assert sorted(tuple(_plain(v) for v in r) for r in rows) == expected


def test_every_statement_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    assert entry_point.entry(spark).count() == 3
