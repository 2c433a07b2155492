"""What the plans must and must not hold."""

import __spark_entry__ as entry
import pytest
from pavilion.operators import joins
from pavilion.plans import joblog, scorecard, star as star_plan
from pavilion.plans.measures import evaluate
from pavilion.session import materialize
from pavilion.sources.sample_star import document_star, documents, sample_jobs, sample_star
from pyspark.sql import functions as F


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def star(spark, sf_dir):
    return sample_star(spark, sf_dir)


def test_drill_through_reaches_the_scan(star):
    for name, df in scorecard.page(star, 7, 1).items():
        assert "EqualTo(match_id,7)" in plan(df), name


def test_scans_read_only_their_columns(star):
    text = plan(evaluate(star, ["player_id"], ["batter_runs"]))
    assert "ReadSchema: struct<match_id:bigint,innings:int,batter_id:bigint,batter_runs:int>" in text


def test_additive_measures_take_two_small_exchanges_and_no_sort(star):
    text = plan(evaluate(star, ["player_id"], ["batter_runs", "fours", "wickets", "catches", "best_bowl_innings"]))
    assert text.count("Exchange hashpartitioning") == 2
    assert "SortAggregate" not in text and "Sort [" not in text


def scans(df, name):
    """How often a plan reads a table. Sample tables are folders of their names."""
    return sum(f"/{name}-" in line for line in plan(df).splitlines() if "FileScan" in line)


@pytest.mark.parametrize("name", ["team_measures", "season_measures", "match_type_measures", "event_measures", "player_stats"])
def test_measures_read_the_balls_once(spark, sf_dir, name):
    df = entry.own_queries()[name](spark, sf_dir)
    assert scans(df, "t_fact_deliveries") == 1


def test_progress_reads_the_balls_once(star, monkeypatch):
    written = []

    def keep(df, name):
        written.append(scans(df, "t_fact_deliveries"))
        return df.sparkSession.createDataFrame(df.collect(), df.schema)

    monkeypatch.setattr(scorecard, "materialize", keep)
    rest = scorecard.manhattan(star)
    assert [*written, scans(rest, "t_fact_deliveries")] == [1, 0]
    assert scans(scorecard.ball_map(star), "t_fact_deliveries") == 2


def test_job_report_reads_the_log_twice(spark, sf_dir):
    report = joblog.job_report(sample_jobs(spark, sf_dir), F.lit("2024-02-15").cast("timestamp_ntz"))
    # A third scan is the exchange of the second, used again.
    report.collect()
    text = plan(report).split("Initial Plan")[0]
    assert sum("/t_job-" in line for line in text.splitlines() if "FileScan" in line) <= 3 and "NestedLoop" not in text


def test_documents_are_parsed_once_and_never_shuffled(spark, sf_dir, monkeypatch):
    staging = document_star(spark, sf_dir)[0]
    written = []

    def keep(df, name):
        written.append((name, plan(df)))
        return materialize(df, name)

    monkeypatch.setattr(star_plan, "materialize", keep)
    star_plan.build_star(staging, store=keep)
    # One table is made from the innings' text, in one parse, on the scan; what it holds is narrow.
    parsing = {name: text for name, text in written if "match_innings" in text}
    assert set(parsing) == {"balls"}
    assert parsing["balls"].count("from_json(") == 1 and "Exchange" not in parsing["balls"]


@pytest.mark.parametrize("join", ["apart", "spread"])
def test_missing_keys_are_not_one_tasks_rows(spark, join):
    """Nine tenths of the rows without a key, in a shuffled join."""
    rows = spark.range(20_000).selectExpr("id", "if(id % 10 = 0, id % 7, null) as key")
    dim = spark.range(5).selectExpr("id as key", "'n' || id as name")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        if join == "apart":
            df = joins.left_join_apart(rows, dim, "key")
            keyed, rest = plan(df).split("SortMergeJoin")
            # The exchanged side holds no row without a key; the other side of the union has no exchange.
            assert "isnotnull" in rest
            counts = df.filter("key is not null").groupBy(F.spark_partition_id()).count().collect()
            assert sum(r["count"] for r in counts) == 2000
        else:
            df = joins.left_join_spread(rows, dim, "key", -2 - F.col("id"))
            counts = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
            assert max(counts) < 2 * sum(counts) / len(counts)
        got = {(r.id, r.key, r["name"]) for r in df.collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {(i, i % 7 if i % 10 == 0 else None, f"n{i % 7}" if i % 10 == 0 and i % 7 < 5 else None) for i in range(20_000)}


@pytest.mark.parametrize("name", [n for n in entry.own_queries() if not n.startswith(("dim_upsert", "merge", "compacted"))])
def test_no_nested_loops_and_no_python(spark, sf_dir, name):
    text = plan(entry.own_queries()[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "Python" not in text and "InPandas" not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_balls_are_dealt_out_once_for_documents(spark, sf_dir):
    """Listed to overs, innings and matches where their match is."""
    text = documents(sample_star(spark, sf_dir))._jdf.queryExecution().executedPlan().toString()
    balls = text[: text.rindex("t_fact_deliveries-")].rsplit("t_dim_match-", 1)[-1]
    assert balls.count("Exchange hashpartitioning") == 1


def test_balls_meet_their_match_without_a_sort(spark, sf_dir, monkeypatch):
    staging = document_star(spark, sf_dir)[0]
    written = {}

    def keep(df, name):
        written[name] = df._jdf.queryExecution().executedPlan().toString()
        return materialize(df, name)

    star_plan.build_star(staging, store=keep)
    # What stands above the scan of the balls, up to the join.
    above = written["t_fact_deliveries"].split("/balls-")[0].splitlines()
    join = max(i for i, line in enumerate(above) if "ShuffledHashJoin [match_id" in line)
    assert not any("Sort [" in line or "SortMergeJoin" in line for line in above[join:][:5])
