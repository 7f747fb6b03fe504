"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tools.check_oracle import canonical


@pytest.fixture(scope="module")
def duck(sf):
    import os

    connection = duckdb.connect()
    for file in os.listdir(sf):
        connection.execute(f"CREATE VIEW {file[:-8]} AS SELECT * FROM '{sf}/{file}'")
    return connection


def test_sql_is_for_known_queries():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, sf, duck, name):
    df = queries()[name](spark, sf)
    columns = sorted(df.columns)
    got = canonical([tuple(r) for r in df.select(*columns).collect()])
    assert got
    if name in oracle_sql():
        want = duck.sql(oracle_sql()[name])
        assert columns == sorted(want.columns)
        assert got == canonical(duck.sql(f"SELECT {', '.join(columns)} FROM ({oracle_sql()[name]})").fetchall())


def test_entry(spark, sf):
    assert entry(spark).columns == ["source", "part", "n", "reviews", "summary"]
