"""Components against a plain search, and how many tasks their rounds take."""

import random

import pytest
from pavilion.llm import components as stars


def brute(links):
    near = {}
    for u, v in links:
        near.setdefault(u, set()).add(v)
        near.setdefault(v, set()).add(u)
    out = set()
    while near:
        group, at = set(), [next(iter(near))]
        while at:
            node = at.pop()
            if node not in group:
                group.add(node)
                at += near.pop(node)
        out |= {(node, min(group)) for node in group if len(group) > 1}
    return out


@pytest.fixture
def many_partitions(spark):
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "97")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    for k, v in held.items():
        spark.conf.set(k, v)


def test_tasks_follow_the_links(spark, many_partitions, monkeypatch):
    rng = random.Random(4)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)] + [(1000 + i, 1001 + i) for i in range(30)]
    links += [(2000, 2001 + i) for i in range(200)] + [(3000, 3000), (-5, 7)]
    written, write = [], stars.materialize

    def watched(df, name):
        out = write(df, name)
        written.append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(stars, "materialize", watched)
    got = stars.components(spark.createDataFrame(links, "u long, v long"))
    most = spark.sparkContext.defaultParallelism
    assert {tuple(r) for r in got.collect()} == brute(links)
    assert got.rdd.getNumPartitions() <= most
    # The first are written as they come; each round's by as many tasks as its links need.
    assert len(written) > 2 and all(n <= most for n in written[1:])
    monkeypatch.setattr(stars, "TASK_LINKS", 20)
    assert {tuple(r) for r in stars.components(spark.createDataFrame(links, "u long, v long")).collect()} == brute(links)


def test_stars_take_no_round(spark, monkeypatch):
    written, write = [], stars.materialize
    monkeypatch.setattr(stars, "materialize", lambda df, name: written.append(name) or write(df, name))
    for links, rounds in [([], 0), ([(4, 4)], 0), ([(1, 2), (3, 1), (1, 3), (-8, 9)], 0), ([(1, 3), (2, 3)], 1), ([(1, 2), (2, 3)], 1)]:
        written.clear()
        got = sorted(tuple(r) for r in stars.components(spark.createDataFrame(links, "u long, v long")).collect())
        assert got == sorted(brute([link for link in links if link[0] != link[1]]))
        assert len(written) == 1 + rounds, links
