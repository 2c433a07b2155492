"""A load from match documents to star tables, with its gates and its job log."""

from pyspark.sql import DataFrame, SparkSession

from pavilion.operators import tables
from pavilion.plans import star as plan
from pavilion.plans.joblog import run_logged
from pavilion.plans.star import Star
from pavilion.session import materialize
from pavilion.sources.match_json import list_files, new_files, problem, problems, read_files, stage

STAGING, STAR = "Ingest to Raw", "Build Star Schema"  # job categories, as the monitor shows them


def stored_star(spark: SparkSession, schema="reporting") -> Star:
    """The star as it is stored."""
    names = ["t_dim_match", "t_dim_team", "t_dim_player", "t_dim_date", "t_fact_team_players", "t_fact_deliveries"]
    return Star(*[spark.table(f"{schema}.{name}") for name in names])


def file_gate(spark: SparkSession, folder: str, staged: str, refused: str) -> DataFrame:
    """The versions of files in a folder that are neither staged nor refused; raises NoNewData if there are none.

    Only names, sizes and times are looked at.
    """
    known = [spark.table(name) for name in (staged, refused) if tables.table_exists(spark, name)]
    new = materialize(new_files(list_files(spark, folder), *known), "new_files")
    if new.isEmpty():
        raise tables.NoNewData()
    return new


def stage_files(spark: SparkSession, folder: str, new: DataFrame, staged: str, refused: str) -> None:
    """Parses the new files. A new version of a file takes the place of the old one; what is no match document is put on record."""
    files = materialize(read_files(spark, folder, new), "files")
    tables.append_table(problems(files), refused)
    rows = stage(files.filter(problem().isNull()))
    if tables.table_exists(spark, staged):
        before = spark.table(staged)
        if not before.join(new, "file_name", "left_semi").isEmpty():
            return tables.replace_table(before.join(new, "file_name", "left_anti").unionByName(rows), staged)
    tables.append_table(rows, staged)


def load(
    spark: SparkSession, documents, staging="staging", reporting="reporting", logs="logs", parent=None, parent_id=None
) -> Star:
    """Stages documents and builds the star, unless there is nothing new.

    documents: a folder of match files, of which only new ones and new versions are read, or staging rows. Raises NoNewData
    if the folder has no such file, or staging as many documents as offered. Every step is a logged job; dimensions keep the
    ids of earlier loads.
    """
    tables.create_schemas(spark, staging, reporting, logs)
    log, staged, refused = f"{logs}.t_job", f"{staging}.t_match_document", f"{staging}.t_refused_file"

    def step(job, category, function):
        return run_logged(spark, log, job, function, category, parent, parent_id=parent_id)

    def keep(df, name):
        table = f"{reporting}.{name}"
        step(name, STAR, lambda: tables.replace_table(df, table))
        return spark.table(table)

    def keep_names(squads, name):
        table = f"{reporting}.{name}"
        if name == "t_dim_player" and not tables.table_exists(spark, table):
            return keep(plan.player_dim(squads), name)
        key, column = ("player_id", "player_name") if name == "t_dim_player" else ("team_id", "team")
        step(name, STAR, lambda: tables.create_or_insert_names(squads, table, key, column))
        return spark.table(table)

    if isinstance(documents, str):
        new = step("Gate Staging", STAGING, lambda: file_gate(spark, documents, staged, refused))
        step("Stage Documents", STAGING, lambda: stage_files(spark, documents, new, staged, refused))
    else:
        step("Gate Staging", STAGING, lambda: tables.require_new_data(spark, staged, documents.select("match_id")))
        step("Stage Documents", STAGING, lambda: tables.replace_table(documents, staged))
        step("Gate Star", STAR, lambda: tables.require_new_data(spark, f"{reporting}.t_dim_match", spark.table(staged)))
    return plan.build_star(spark.table(staged), keep, keep_names)
