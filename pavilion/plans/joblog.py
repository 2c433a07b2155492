"""The job log: reports over it, and the writer that keeps it."""

import datetime
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pavilion.functions.blanks import blank_zero
from pavilion.functions.elapsed import elapsed_measure, elapsed_report, seconds_between
from pavilion.operators.joins import left_join_apart
from pavilion.operators.tables import NoNewData, append_table, literal_rows, table_exists


def duration(now: Column) -> Column:
    return seconds_between(F.col("start_time"), F.coalesce(F.col("end_time"), now))


def with_parent_names(jobs: DataFrame) -> DataFrame:
    """Jobs and their parents' names. Root jobs, which may be most, have none to be looked up."""
    names = jobs.select(F.col("job_id").alias("parent_job_id"), F.col("job_name").alias("parent_job_name"))
    return left_join_apart(jobs, names, "parent_job_id")


def known_jobs(jobs: DataFrame) -> DataFrame:
    """Per id that is a job's or a parent's: the job's name and start, whether it is a root, and how many children it has."""
    own = "struct(job_id as id, job_name as name, start_time as start, parent_job_id is null as is_root, 0 as child)"
    named = "if(false, job_name, null) as name, if(false, start_time, null) as start, if(false, true, null) as is_root"
    rows = jobs.selectExpr(f"inline(array({own}, struct(parent_job_id as id, {named}, 1 as child)))").filter("id is not null")
    return rows.groupBy("id").agg(
        F.max("name").alias("name"), F.max("start").alias("start"), F.max("is_root").alias("is_root"), F.sum("child").alias("children")
    )


def job_report(jobs: DataFrame, now: Column) -> DataFrame:
    """Every job with its parent's name, whether it belongs to the latest run, and its time.

    A job meets its root by one key, its parent's id or else its own, so none is without a key. The latest run is that of the
    root with children that started last: one row.
    """
    known = known_jobs(jobs)
    headed = F.col("is_root") & (F.col("children") > 0)
    latest = known.filter(headed).agg(F.max_by("id", F.struct("start", "id")).alias("latest_id"))
    roots = known.join(F.broadcast(latest), F.col("id") == F.col("latest_id"), "left").select(
        F.col("id").alias("root_id"), "name",
        F.when(headed, F.when(F.col("latest_id").isNotNull(), "Y").otherwise("N")).alias("is_latest_parent"),
    )
    rows = jobs.withColumn("root_id", F.coalesce("parent_job_id", "job_id")).join(roots, "root_id", "left")
    rows = rows.withColumns({"parent_job_name": F.when(F.col("parent_job_id").isNotNull(), F.col("name")), "duration_sec": duration(now)})
    return rows.select(
        "job_category", "job_name", "parent_job_name", "is_latest_parent", "start_time", "end_time",
        elapsed_report(F.col("duration_sec")).alias("time_elapsed"),
        "status", "message", "duration_sec", "job_id", "parent_job_id",
    ).orderBy(F.desc("start_time"))


def latest_run(jobs: DataFrame) -> DataFrame:
    """Ids of the jobs that share the start of the latest parent, and of their children.

    Parents here are all jobs named as a parent, and the latest is a moment, not a row.
    """
    parents = jobs.filter("parent_job_id is not null").select(F.col("parent_job_id").alias("job_id")).distinct()
    moment = jobs.join(parents, "job_id", "left_semi").agg(F.max("start_time").alias("start_time"))
    starters = jobs.join(F.broadcast(moment), "start_time", "left_semi").select("job_id")
    children = jobs.join(starters.select(F.col("job_id").alias("parent_job_id")), "parent_job_id", "left_semi")
    return starters.union(children.select("job_id")).distinct()


def of_latest_run(report: DataFrame, jobs: DataFrame) -> DataFrame:
    """The rows of a job report that belong to the latest run."""
    return report.join(latest_run(jobs), "job_id", "left_semi")


def monitor(jobs: DataFrame, now: Column) -> DataFrame:
    rows = with_parent_names(jobs).withColumn("duration_sec", duration(now))
    return rows.select(
        "job_id", "job_name", "job_category", "start_time", "end_time", "status", "message", "parent_job_name",
        elapsed_measure(F.col("duration_sec")).alias("time_elapsed"), "duration_sec",
    ).orderBy(F.desc("start_time"))


def jobs_by_status(jobs: DataFrame) -> DataFrame:
    children = jobs.filter("parent_job_id is not null")
    return children.groupBy("status").agg(F.count(F.lit(1)).alias("job_count"))


def duration_by_category(jobs: DataFrame, now: Column) -> DataFrame:
    children = jobs.filter("parent_job_id is not null")
    return children.groupBy("job_category").agg(F.sum(duration(now)).alias("duration_sec"))


def job_cards(jobs: DataFrame, now: Column) -> DataFrame:
    """Overall time of root jobs, number of child jobs, the one status (if there is one), own time."""
    root = F.col("parent_job_id").isNull()
    sums = jobs.agg(
        F.sum(F.when(root, duration(now))).alias("root_sec"),
        blank_zero(F.count_if(~root)).alias("overall_jobs"),
        F.when(F.min("status") == F.max("status"), F.max("status")).alias("current_status"),
        F.sum(F.when(F.col("job_category") != "Orchestrator", duration(now))).alias("own_duration_sec"),
    )
    return sums.select(
        elapsed_measure(F.col("root_sec")).alias("overall_duration"),
        "overall_jobs", "current_status", "own_duration_sec",
    )


# A row of the log: the start of a job or its end, which has a status and the seconds it took where they are known.
JOB = """
    job_id string, parent_job_id string, job_name string, job_category string,
    start_time timestamp, end_time timestamp, status string, message string, seconds int
"""


def logged_jobs(log: DataFrame) -> DataFrame:
    """One row per job out of its log rows. The log is only ever appended to, so no writer can undo another's rows."""
    ended = F.col("end_time").isNotNull()
    last = F.max_by(F.struct("end_time", "status", "message", "seconds"), F.when(ended, F.col("end_time")))
    jobs = log.groupBy("job_id").agg(
        *[F.max(c).alias(c) for c in ("parent_job_id", "job_name", "job_category", "start_time")], last.alias("last")
    )
    by_duration = F.col("start_time") + F.make_dt_interval(secs=F.col("last.seconds"))
    return jobs.select(
        "job_id", "parent_job_id", "job_name", "job_category", "start_time",
        F.coalesce(by_duration, "last.end_time").alias("end_time"),
        F.coalesce("last.status", F.lit("InProgress")).alias("status"), F.col("last.message").alias("message"),
    )


def latest_job_id(jobs: DataFrame, job_name: str):
    """Id of the last started job of a name, or nothing."""
    named = jobs.filter(F.col("job_name") == job_name)
    return named.agg(F.max_by("job_id", F.struct("start_time", "job_id")).alias("job_id")).first()["job_id"]


def _append(spark, table, *row):
    append_table(literal_rows(spark, [row], JOB), table)


def _now():
    return datetime.datetime.now().replace(microsecond=0)


def start_job(spark: SparkSession, table, job_name, category="Adhoc", parent=None, job_id=None, parent_id=None) -> str:
    """Logs a job in progress and returns its id. A parent is given by id, or by name: then its latest run is meant."""
    job_id = job_id or str(uuid.uuid4())
    if parent_id is None and parent and table_exists(spark, table):
        parent_id = latest_job_id(spark.table(table), parent)
    _append(spark, table, job_id, parent_id, job_name, category, _now(), None, None, None, None)
    return job_id


def end_job(spark: SparkSession, table, job_id, status, message=None, duration=None) -> None:
    """Logs the end of a job: now, or its start and the given seconds."""
    _append(spark, table, job_id, None, None, None, None, _now(), status, message, duration)


def run_logged(spark: SparkSession, table, job_name, function, category="Adhoc", parent=None, job_id=None, parent_id=None, **kwargs):
    """Runs function between start and end rows. The id is carried, so equal names cannot mix."""
    job_id = start_job(spark, table, job_name, category, parent, job_id, parent_id)
    try:
        result = function(**kwargs)
    except Exception as error:
        status = "Completed" if isinstance(error, NoNewData) else "Failed"
        end_job(spark, table, job_id, status, str(error))
        raise
    end_job(spark, table, job_id, "Completed")
    return result
