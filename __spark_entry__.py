"""Registered queries and the SQL they are checked against."""

from __future__ import annotations

import importlib
import os
import sys
import time
import uuid
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession, functions as F  # noqa: E402

import entry_sql  # noqa: E402
from pavilion.operators import tables  # noqa: E402
from pavilion.operators.ordinals import positions  # noqa: E402
from pavilion.operators.shred import match_facts, squads  # noqa: E402
from pavilion.plans import joblog, reports, scorecard, star as star_plan  # noqa: E402
from pavilion.plans.load import load  # noqa: E402
from pavilion.plans.measures import DELIVERY_MEASURES, SQUAD_MEASURES, evaluate  # noqa: E402
from pavilion.plans.selectors import SELECTORS  # noqa: E402
from pavilion.session import shared_dir  # noqa: E402
from pavilion.sources.match_json import (  # noqa: E402
    file_key, list_files, new_files, problems, read_files, read_matches, split_documents, stage,
)
from pavilion.sources.sample_star import document_folder, document_star, documents, sample_jobs, sample_star, table  # noqa: E402

OPTIONAL = {"corpus_pipeline", "pavilion.llm", "pavilion.llm.queries"}


def optional(name: str):
    """A module of the training-data part, or None where that part is not there."""
    try:
        return importlib.import_module(name)
    except ModuleNotFoundError as missing:
        if missing.name not in OPTIONAL:
            raise
        return None


llm = optional("pavilion.llm.queries")
corpus_pipeline = optional("corpus_pipeline")


SEASON_SETS = ["highest_score", "highest_wickets", "hundreds", "highest_sixes", "highest_wickets_in_over", "tied"]


def of_star(report):
    return lambda spark, sf: report(sample_star(spark, sf))


def measured(keys, *measures, **context):
    return lambda spark, sf: evaluate(sample_star(spark, sf), keys, list(measures), **context)


def of_jobs(report, timed=False):
    def run(spark, sf):
        jobs = sample_jobs(spark, sf)
        # The open end of a running job: a fixed moment, so that results can be compared.
        return report(jobs, F.lit("2024-02-15").cast("timestamp_ntz")) if timed else report(jobs)

    return run


def of_documents(pick):
    return lambda spark, sf: pick(*document_star(spark, sf))


def selected(name):
    def run(spark, sf):
        star = sample_star(spark, sf)
        # "All matches" is about a chosen team; the others look at everything.
        context = {"teams": [3]} if name == "all_matches" else {}
        keys, measures = ["match_id", "team_id"], ["deliveries", "overall_runs", "sixes"]
        return evaluate(star, keys, measures, selector=SELECTORS[name](star, **context))

    return run


def selected_in(name, where=None, teams=None):
    """A match set found within a season or a team's balls."""

    def run(spark, sf):
        star = sample_star(spark, sf)
        found = SELECTORS[name](star, where=where and F.expr(where), teams=teams)
        return evaluate(star, ["match_id", "team_id"], ["deliveries", "overall_runs", "sixes"], selector=found)

    return run


def on_page(part, match_id, innings=None):
    return of_star(lambda star: scorecard.page(star, match_id, innings)[part])


def placed(query, *order):
    """A query's rows with their place in the display order, which is compared as a value. "-" goes before falling columns."""
    def by(column):
        return F.desc(column[1:]) if column.startswith("-") else F.asc(column)

    return lambda spark, sf: positions(query(spark, sf), *map(by, order))


def logged_jobs(spark, sf):
    """The sample jobs as log rows, starts and ends apart, and back."""
    rows = sample_jobs(spark, sf)
    none = [F.lit(None).cast("string").alias(c) for c in ("parent_job_id", "job_name", "job_category")]
    starts = rows.select(
        "job_id", "parent_job_id", "job_name", "job_category", "start_time", F.lit(None).cast("timestamp_ntz").alias("end_time"),
        F.lit("InProgress").alias("status"), "message", F.lit(None).cast("int").alias("seconds"),
    )
    ends = rows.filter("end_time is not null").select(
        "job_id", *none, F.lit(None).cast("timestamp_ntz"), "end_time", "status", F.lit("ended"),
        F.when(F.col("status") == "Failed", 30),
    )
    return joblog.logged_jobs(starts.union(ends))


def filtered_measures(spark, sf):
    where = F.col("match_date").between("1995-03-01", "1996-06-30") & F.col("match_type").isin("T20", "Test")
    rows = evaluate(
        sample_star(spark, sf), ["player_id"], ["batter_runs", "deliveries", "fours"], where=where, teams=[2, 5]
    )
    return rows


def scratch_schema(spark) -> str:
    """A schema of its own in the shared folder, for queries that write tables."""
    name = f"scratch_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE SCHEMA {name} LOCATION '{shared_dir(spark)}/{name}'")
    return name


def customers(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", "c_name")


def early_customers(spark, sf):
    early = table(spark, sf, "orders").filter("o_orderdate < '1995-02-01'").select(F.col("o_custkey").alias("c_custkey"))
    return customers(spark, sf).join(early, "c_custkey", "left_semi")


def dim_upsert(spark, sf):
    """The names of early customers first, then all of them."""
    name = f"{scratch_schema(spark)}.t_dim_customer"
    tables.create_or_insert_names(early_customers(spark, sf), name, "customer_id", "c_name")
    tables.create_or_insert_names(customers(spark, sf), name, "customer_id", "c_name")
    return spark.table(name)


def merge_insert(spark, sf):
    """Merging all customers twice into the early ones leaves each there once."""
    name = f"{scratch_schema(spark)}.t_customer"
    tables.replace_table(early_customers(spark, sf), name)
    for _ in range(2):
        tables.merge_insert(customers(spark, sf), name, ["c_custkey"])
    return spark.table(name).groupBy("c_custkey", "c_name").agg(F.count(F.lit(1)).alias("n"))


def merge_update(spark, sf):
    """Jobs as logged at their start, updated with the ends of those that did not fail."""
    jobs = sample_jobs(spark, sf)
    started = jobs.withColumn("end_time", F.lit(None).cast("timestamp_ntz"))
    # A duration where the job is still running, the recorded end otherwise.
    ends = jobs.filter("status <> 'Failed'").select(
        "job_id", "end_time", F.lit("ended").alias("message"),
        F.when(F.col("status") == "InProgress", 90).alias("seconds"),
    )
    changes = {
        "end_time": "coalesce(t.start_time + make_dt_interval(0, 0, 0, s.seconds), s.end_time)",
        "message": "s.message",
    }
    name = f"{scratch_schema(spark)}.t_job"
    tables.replace_table(started, name)
    tables.merge_update(ends, name, ["job_id"], changes)
    return spark.table(name).select("job_id", "start_time", "end_time", "status", "message")


def merge_update_month(spark, sf):
    """Orders by month, the urgent ones of one month closed. "rewritten" is told from the times of the files."""
    month = F.date_format("o_orderdate", "yyyy-MM").alias("month")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", month)
    name = f"{scratch_schema(spark)}.t_order"
    tables.create_partitioned(orders, name, ["month"])
    written = F.col("_metadata.file_modification_time")
    before = spark.table(name).agg(F.max(written)).first()[0]
    urgent = orders.filter("month = '1995-03' and o_orderpriority = '1-URGENT'").select("o_orderkey")
    time.sleep(0.01)  # so that files of the update are younger
    tables.merge_update(urgent, name, ["o_orderkey"], {"o_orderstatus": "'C'"})
    return spark.table(name).select("o_orderkey", "o_orderstatus", "month", (written > F.lit(before)).alias("rewritten"))


def dim_hashed_ids(spark, sf):
    """Two loads that see the same empty dimension and both append. How many ids a name has, and how many names an id: also
    with hashes of eight bits, most of which clash.
    """
    name = f"{scratch_schema(spark)}.t_dim_customer"
    loads = [tables.hashed_rows(names, name, "c_name") for names in (early_customers(spark, sf), customers(spark, sf))]
    for rows in loads:
        tables.append_table(rows, name)
    found = None
    for bits in (63, 8):
        ids = tables.hashed_ids(spark.table(name), "customer_id", "c_name", bits)
        per_id = ids.groupBy("customer_id").agg(F.count(F.lit(1)).alias("names"))
        ids = ids.join(per_id, "customer_id").groupBy("c_name").agg(
            F.countDistinct("customer_id").alias("ids"), F.max("names").alias("names"), F.count(F.lit(1)).alias("rows")
        )
        ids = ids.withColumn("bits", F.lit(bits))
        found = ids if found is None else found.union(ids)
    return found


def schema_merge(spark, sf):
    """Customers appended three times, with columns that come and go, read through the merged schema of the files."""
    name, rows = f"{scratch_schema(spark)}.t_customer", table(spark, sf, "customer")
    tables.replace_table(rows.filter("c_custkey % 3 = 0").select("c_custkey", "c_name"), name)
    tables.append_table(rows.filter("c_custkey % 3 = 1").select("c_custkey", "c_nationkey", "c_mktsegment"), name)
    tables.append_table(rows.filter("c_custkey % 3 = 2").select("c_mktsegment", "c_custkey", "c_name"), name)
    both = spark.table(name).withColumn("reader", F.lit("catalog"))
    files = tables.merged_files(spark, name).withColumn("reader", F.lit("files"))
    return both.unionByName(files)


def new_data_gate(spark, sf):
    matches = sample_star(spark, sf).matches
    return tables.count_gate(matches.filter("match_result is null"), matches)


def new_matches(spark, sf):
    matches = sample_star(spark, sf).matches
    return tables.new_rows(matches.filter("match_result is null"), matches, ["match_id"]).select("match_id")


def digits_cleanup(spark, sf):
    return customers(spark, sf).select("c_custkey", tables.digits_only(F.col("c_name")).alias("number"))


def file_keys(spark, sf):
    order, status = F.col("o_orderkey").cast("string"), F.col("o_orderstatus")
    name = (
        F.when(status == "F", F.concat(F.lit("wi_"), order))
        .when(status == "P", F.col("o_orderpriority"))
        .otherwise(order)
    )
    files = table(spark, sf, "orders").select(F.concat(name, F.lit(".json")).alias("file_name")).distinct()
    return files.select("file_name", file_key(F.col("file_name")).alias("match_id"))


def compacted_table(spark, sf):
    """A fact stored in files of the session's advisory size, and read back."""
    name = f"{scratch_schema(spark)}.t_fact_deliveries"
    tables.replace_table(tables.evenly(sample_star(spark, sf).deliveries), name)
    return spark.table(name).groupBy("match_id").agg(F.count(F.lit(1)).alias("n"), F.sum("total_runs").alias("runs"))


def match_files(spark, sf):
    """Match files read back as staging rows, and the files in their folder that are none."""
    folder = document_folder(spark, sf)
    stamped = (F.col("last_update_ts") >= F.col("file_time")) & (F.col("last_update_ts") <= F.now())
    read = read_matches(spark, folder).withColumn("stamped", stamped).drop("file_bytes", "file_time", "last_update_ts")
    refused = problems(read_files(spark, folder)).select("file_name", "problem")
    return read.unionByName(refused, allowMissingColumns=True)


def catalog_listing(spark, sf):
    """What a schema of its own lists, with the number of rows of each table: written, appended to, merged, literal and empty."""
    schema = scratch_schema(spark)
    tables.create_schemas(spark, schema)  # there already, and left as it is
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    tables.replace_table(customers(spark, sf), f"{schema}.t_customer")
    tables.replace_table(orders.filter("o_orderstatus = 'F'"), f"{schema}.t_order")
    tables.append_table(orders.filter("o_orderstatus = 'O'"), f"{schema}.t_order")
    tables.replace_table(tables.literal_rows(spark, [(1, "a"), (2, None)], "id int, name string"), f"{schema}.t_literal")
    tables.replace_table(orders.limit(0), f"{schema}.t_empty")
    rows = [(name, schema in tables.list_schemas(spark), tables.row_count(spark, f"{schema}.{name}")) for name in tables.list_tables(spark, schema)]
    return tables.literal_rows(spark, rows, "table_name string, schema_listed boolean, n long")


def load_log(spark, sf):
    """A folder loaded twice and a job that fails: what the log says of each, and how many rows each table has."""
    schema, folder = scratch_schema(spark), document_folder(spark, sf)
    log = f"{schema}.t_job"

    def logged_load(job_id):
        run = lambda: load(spark, folder, schema, schema, schema, parent_id=job_id)
        return joblog.run_logged(spark, log, "Load", run, "Orchestrator", job_id=job_id)

    def fail():
        raise RuntimeError("refresh failed")

    star = logged_load("first")
    for again in (lambda: logged_load("second"), lambda: joblog.run_logged(spark, log, "Refresh", fail, parent="Load")):
        try:
            again()
        except (tables.NoNewData, RuntimeError):
            pass
    jobs = joblog.with_parent_names(joblog.logged_jobs(spark.table(log)))
    found = jobs.groupBy(
        F.lit("job").alias("kind"), F.col("job_name").alias("name"), F.col("job_category").alias("category"),
        F.col("parent_job_id").alias("parent"), "parent_job_name", "status", "message",
    ).agg(F.count(F.lit(1)).alias("n"))
    stored = {
        "t_dim_match": star.matches, "t_dim_team": star.teams, "t_dim_player": star.players, "t_dim_date": star.dates,
        "t_fact_team_players": star.team_players, "t_fact_deliveries": star.deliveries,
        "t_refused_file": spark.table(f"{schema}.t_refused_file"),
    }
    for name, df in stored.items():
        count = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit("table").alias("kind"), F.lit(name).alias("name"), "n")
        found = found.unionByName(count, allowMissingColumns=True)
    return found


def gate_files(spark, sf):
    """The names that a load has to read, where files of even numbers are staged in the version that the folder has."""
    folder, name = document_folder(spark, sf), f"{scratch_schema(spark)}.t_match_document"
    staged = read_matches(spark, folder).filter("match_id % 2 = 0")
    tables.replace_table(staged, name)
    return new_files(list_files(spark, folder), spark.table(name)).select("file_name")


def squad_explode(spark, sf):
    """Squads out of whole document texts, whose two parts stay text until they are read."""
    parts = documents(sample_star(spark, sf))
    content = F.concat(F.lit('{"info":'), "info", F.lit(',"innings":'), "innings", F.lit("}"))
    return squads(stage(split_documents(parts.select(content.alias("content"), "file_name"))))


def first_team_case(staging, star):
    return match_facts(staging).select("match_id", "toss_winner", "toss_decision", "first_bat", "first_field")


def document_matches(staging, star):
    return star.matches


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: the player table."""
    return reports.player_stats(sample_star(spark, "/root/testdata/sf0.001"))


def own_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = plain_queries()
    return own | {name: placed(own[name], *order) for name, order in ORDERS.items()}


def plain_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = ("player_stats", "team_stats", "kpi_cards", "wins_by_year", "wins_by_month", "match_results", "match_cards",
             "slicer_values", "player_teams")
    cards = ("batting_scorecard", "bowling_scorecard", "fall_of_wickets_rows", "fall_of_wickets", "did_not_bat",
             "innings_header", "manhattan", "worm", "worm_tooltip", "ball_map")
    player = ["player_id"]
    return {
        **{name: of_star(getattr(reports, name)) for name in named},
        "player_stats_of_team": of_star(lambda star: reports.player_stats(star, teams=[3])),
        "batting_leaderboard": measured(
            player, "innings_count", "batter_runs", "deliveries", "wides", "strike_rate", "batting_average",
            "highest_score", "fours", "sixes",
        ),
        "bat_innings_not_outs": measured(player, "bat_innings", "not_outs"),
        "milestones_50_100": measured(player, "fifties", "hundreds"),
        "bowling_leaderboard": measured(
            player, "bowl_innings", "wickets", "other_wickets", "conceded_runs", "economy", "bowling_average",
            "no_balls_bowled", "wides_bowled",
        ),
        "five_wicket_hauls": measured(player, "five_wickets"),
        "best_bowling": measured(player, "best_bowl_innings"),
        "maidens": measured(player, "maidens"),
        "fielding_catches": measured(player, "catches"),
        "player_of_match": measured(player, "player_of_match"),
        "innings_measures": measured(
            ["match_id", "innings"], "deliveries", "overall_runs", "batter_runs", "extra_runs", "byes_runs",
            "leg_byes_runs", "wides", "no_balls", "innings_count", "over_count", "fours", "sixes",
        ),
        "team_measures": measured(["team_id"], *DELIVERY_MEASURES),
        "event_measures": measured(
            ["event_name", "team_id"], "overall_runs", "wickets", "bowler_overs", "hundreds", "matches", "seasons",
            "season_wins",
        ),
        "match_type_measures": measured(["match_type"], *DELIVERY_MEASURES),
        "season_measures": measured(
            ["season"], *DELIVERY_MEASURES, *[m for m in SQUAD_MEASURES if m != "player_of_match"]
        ),
        "season_winners": measured(
            ["team_id"], "season_wins", "won_batting_first", "won_fielding_first", "last_played"
        ),
        "filtered_measures": filtered_measures,
        **{name: of_star(getattr(scorecard, name)) for name in cards},
        **{f"selector_{name}": selected(name) for name in SELECTORS},
        **{f"season_{name}": selected_in(name, where="season = '1995'") for name in SEASON_SETS},
        "team_highest_score": selected_in("highest_score", teams=[3]),
        "season_wins_by_match": measured(["match_id", "team_id"], "season_wins"),
        "page_batting": on_page("batting", 3),
        "page_bowling": on_page("bowling", 3),
        "page_header": on_page("header", 3),
        "page_fall_of_wickets": on_page("fall_of_wickets", 3, innings=1),
        "page_did_not_bat": on_page("did_not_bat", 3, innings=2),
        "logged_jobs": logged_jobs,
        "job_report": of_jobs(joblog.job_report, timed=True),
        "job_monitor": of_jobs(joblog.monitor, timed=True),
        "job_latest_parent": of_jobs(joblog.latest_run),
        "job_monitor_latest_run": of_jobs(
            lambda jobs, now: joblog.of_latest_run(joblog.monitor(jobs, now), jobs), timed=True
        ),
        "jobs_by_status": of_jobs(joblog.jobs_by_status),
        "duration_by_category": of_jobs(joblog.duration_by_category, timed=True),
        "job_cards": of_jobs(joblog.job_cards, timed=True),
        "staged_matches": of_documents(lambda staging, star: staging.select("match_id", "file_name")),
        "compacted_table": compacted_table,
        "match_files": match_files,
        "catalog_listing": catalog_listing,
        "gate_files": gate_files,
        "load_log": load_log,
        "squad_explode": squad_explode,
        "first_team_case": of_documents(first_team_case),
        "dim_player": of_documents(lambda staging, star: star.players),
        "dim_team": of_documents(lambda staging, star: star.teams),
        "dim_match": of_documents(document_matches),
        "dim_date": of_documents(lambda staging, star: star.dates),
        "fact_team_players": of_documents(lambda staging, star: star.team_players),
        "opponent_window": of_documents(lambda staging, star: star_plan.opponents(star.team_players)),
        "fact_deliveries": of_documents(lambda staging, star: star.deliveries),
        "dim_upsert": dim_upsert,
        "merge_insert": merge_insert,
        "merge_update": merge_update,
        "merge_update_month": merge_update_month,
        "dim_hashed_ids": dim_hashed_ids,
        "schema_merge": schema_merge,
        "new_data_gate": new_data_gate,
        "new_matches": new_matches,
        "digits_cleanup": digits_cleanup,
        "file_keys": file_keys,
    }


# Total orders of the reports that are shown sorted.
ORDERS = {
    "match_results": ["-match_date", "-match_id"],
    "wins_by_month": ["month_number"],
    "job_report": ["-start_time", "job_id"],
    "page_batting": ["innings", "first_ball_faced", "player_name"],
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = own_queries()
    if llm:
        own |= llm.queries()
    if corpus_pipeline:
        own["pipeline"] = corpus_pipeline.run
    return own


def oracle_sql() -> dict[str, str]:
    own = dict(entry_sql.SQL)
    if llm:
        own |= llm.oracle_sql()
    if corpus_pipeline and corpus_pipeline.ORACLE_SQL:
        own["pipeline"] = corpus_pipeline.ORACLE_SQL
    return own
