"""Every registered query against its SQL, and on skewed input with short spans forced."""

import math
import os

import __spark_entry__ as entry
import duckdb
import pytest
from pavilion.operators import running

QUERIES, SQL = entry.own_queries(), entry.entry_sql.SQL


def connect(folder):
    con = duckdb.connect()
    for f in os.listdir(folder):
        con.sql(f"create view {f.removesuffix('.parquet')} as select * from '{folder}/{f}'")
    return con


def canonical(rows):
    def value(v):
        return repr(v) if isinstance(v, float) and not math.isnan(v) else str(v)

    return sorted(tuple(map(value, r)) for r in rows)


def assert_same(spark, con, folder, name):
    df = QUERIES[name](spark, folder)
    columns = sorted(df.columns)
    expected = con.sql(f"select {', '.join(columns)} from ({SQL[name]})")
    assert canonical(df.select(*columns).collect()) == canonical(expected.fetchall())


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, sf_dir, name):
    assert_same(spark, duck, sf_dir, name)


@pytest.fixture(scope="module")
def skewed(sf_dir, tmp_path_factory):
    """The sample tables with a third of the balls in one order line, and a third of the events on one day of one user."""
    folder = tmp_path_factory.mktemp("skewed")
    con = connect(sf_dir)
    for (name,) in con.sql("select view_name from duckdb_views() where not internal").fetchall():
        rows = f"select * from {name}"
        if name == "lineitem":
            hot = "(l_partkey * 7 + l_suppkey) % 3 = 0"
            rows = f"""select * replace (if({hot}, 71, l_orderkey) as l_orderkey, if({hot}, 4, l_linenumber) as l_linenumber)
                       from lineitem"""
        if name == "events":
            hot = "event_id % 3 = 0"
            rows = f"""select * replace (if({hot}, 5, user_id) as user_id,
                         if({hot}, timestamp '2024-01-05 01:00:00' + to_microseconds(event_id), ts) as ts) from events"""
        con.sql(f"copy ({rows}) to '{folder}/{name}.parquet' (format parquet)")
    return str(folder)


@pytest.mark.parametrize(
    "name", ["player_stats", "fall_of_wickets", "manhattan", "batting_scorecard", "ball_map", "fact_deliveries", "job_report"]
)
def test_skewed(spark, skewed, monkeypatch, name):
    monkeypatch.setattr(running.running_totals, "__defaults__", (16,))
    assert_same(spark, connect(skewed), skewed, name)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
