"""Queries that SQL can express against their SQL, on the whole sample tables."""

import os

import duckdb
import pytest
from pavilion.llm import queries


@pytest.mark.parametrize("name", queries.oracle_sql())
def test_against_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark"):
        con.sql(f"create view {table} as select * from '{os.path.join(sf_dir, table + '.parquet')}'")
    got = queries.queries()[name](spark, sf_dir)
    columns = sorted(got.columns)
    want = con.sql(f"select {', '.join(columns)} from ({queries.oracle_sql()[name]})").fetchall()
    assert sorted(map(str, map(tuple, got.select(*columns).collect()))) == sorted(map(str, want))


def test_one_query_an_operator():
    numbers = sorted(int(name.split("_")[0][2:]) for name in queries.queries())
    assert numbers == list(range(1, 14))
