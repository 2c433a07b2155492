import random

import pytest
from pavilion.operators import joins, ordinals, running, texts
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def rows(spark):
    """Three hundred rows, half of them under one key."""
    rng = random.Random(3)
    data = [(("hot" if i % 2 else f"k{i % 7}"), rng.randrange(1000), i, rng.randrange(9)) for i in range(300)]
    return data, spark.createDataFrame(data, "k string, o int, id int, v int").repartition(5).cache()


@pytest.mark.parametrize("slices", [1, 4, 30])
def test_row_numbers_of_hot_and_null_groups(rows, slices):
    data, df = rows
    data = [(None if r[0] == "hot" else r[0], *r[1:]) for r in data]
    df = df.withColumn("k", F.nullif("k", F.lit("hot")))
    expected = {}
    for k in {r[0] for r in data}:
        for n, r in enumerate(sorted(r[1:3] for r in data if r[0] == k), 1):
            expected[r[1]] = n
    got = ordinals.row_numbers(df, ["k"], ["o", "id"], "n", slices=slices)
    assert set(got.columns) == {"k", "o", "id", "v", "n"}
    assert {r["id"]: r["n"] for r in got.collect()} == expected


@pytest.mark.parametrize("hot", [1000, 40, 1])
def test_row_numbers_of_small_groups_take_one_exchange(rows, hot):
    data, df = rows
    data = [(None if r[0] == "hot" else r[0], *r[1:]) for r in data]
    df = df.withColumn("k", F.nullif("k", F.lit("hot")))
    expected = {r[1:3]: 1 + sum(o[0] == r[0] and o[1:3] < r[1:3] for o in data) for r in data}
    got = ordinals.row_numbers(df, ["k"], ["o", "id"], "n", hot=hot)
    assert set(got.columns) == {"k", "o", "id", "v", "n"}
    assert {(r.o, r.id): r.n for r in got.collect()} == expected
    text = got._jdf.queryExecution().sparkPlan().toString()
    assert ("Join" in text) == (hot < 1000)  # offsets, where a group is cut into slices


def test_dense_ids(rows):
    data, df = rows
    got = ordinals.dense_ids(df.unionByName(df.withColumn("k", F.lit(None).cast("string"))), "k", "i", first=11)
    names = sorted({r[0] for r in data})
    assert {r.k: r.i for r in got.collect()} == {k: 11 + i for i, k in enumerate(names)}


@pytest.mark.parametrize("span", [4096, 50, 3])
def test_running_totals_count_peers_and_cross_spans(spark, span):
    rng = random.Random(span)
    data = [(None if i % 3 else f"g{i % 2}", rng.randrange(0, 200), rng.choice([None, 1, 2, 5])) for i in range(400)]
    df = spark.createDataFrame(data, "g string, o int, v int")
    got = running.running_totals(df, ["g"], "o", {"t": "v", "n": F.lit(1)}, span=span).collect()
    assert len(got) == len(data)
    for r in got:
        before = [d for d in data if d[0] == r.g and d[1] <= r.o]
        assert (r.t, r.n) == (sum(d[2] or 0 for d in before), len(before))


def test_joined_text(spark):
    data = [("a", i, f"t{i}") for i in (5, 1, 9, 3, 22)] + [("b", 2, "x")]
    df = spark.createDataFrame(data, "g string, o int, v string")
    got = texts.joined_text(df, ["g"], ["o"], "v", ",", "s")
    assert {r.g: r.s for r in got.collect()} == {"a": "t1,t3,t5,t9,t22", "b": "x"}


def test_top_ties(spark):
    df = spark.createDataFrame([(1, 5), (2, 9), (3, 9), (4, None)], "id int, v int")
    assert sorted(r.id for r in joins.top_ties(df, "v").collect()) == [2, 3]
    blank = df.filter("id = 4").union(spark.createDataFrame([(5, None)], df.schema))
    assert sorted(r.id for r in joins.top_ties(blank, "v").collect()) == [4, 5]
