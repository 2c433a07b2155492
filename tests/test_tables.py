import uuid

import pytest
from pavilion.operators import tables
from pavilion.plans import joblog
from pavilion.session import shared_dir
from pyspark.sql import functions as F


@pytest.fixture
def schema(spark):
    name = f"t_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE SCHEMA {name} LOCATION '{shared_dir(spark)}/{name}'")
    return name


def content(spark, name):
    return sorted(tuple(r) for r in spark.table(name).collect())


def test_upsert_keeps_ids_and_is_idempotent(spark, schema):
    name = f"{schema}.t_dim"
    for batch in (["a", "b"], ["b", "c"], ["b", "c"], ["c", "aa"]):
        names = tables.literal_rows(spark, [(b,) for b in batch], "n string")
        tables.create_or_insert_names(names, name, "id", "n")
    assert content(spark, name) == [(1, "a"), (2, "b"), (3, "c"), (4, "aa")]


def test_replace_reads_itself_and_merges_schemas(spark, schema):
    name = f"{schema}.t"
    assert not tables.table_exists(spark, name)
    tables.replace_table(spark.range(3).toDF("id"), name)
    tables.replace_table(spark.table(name).withColumn("x", F.col("id") * 2), name)
    tables.append_table(spark.range(9, 10).toDF("id"), name)
    assert content(spark, name)[:3] == [(0, 0), (1, 2), (2, 4)]
    assert spark.table(name).filter("x is null").first().id == 9
    assert tables.table_exists(spark, name) and tables.row_count(spark, name) == 4


def test_merges(spark, schema):
    name = f"{schema}.t"
    tables.replace_table(tables.literal_rows(spark, [(1, "a", None), (2, "b", 5)], "k int, s string, v int"), name)
    more = tables.literal_rows(spark, [(2, "z", 9), (3, "c", 7)], "k int, s string, v int")
    for _ in range(2):
        tables.merge_insert(more, name, ["k"])
    assert content(spark, name)[1:] == [(2, "b", 5), (3, "c", 7)]
    tables.merge_update(more, name, ["k"], {"v": "coalesce(t.v, 0) + s.v", "s": "null"})
    assert sorted(spark.table(name).collect(), key=lambda r: r.k) == [(1, "a", None), (2, None, 14), (3, None, 14)]


def test_gate(spark, schema):
    name = f"{schema}.t"
    offered = spark.range(5).toDF("id")
    assert tables.require_new_data(spark, name, offered) == 5
    tables.replace_table(offered.filter("id < 3"), name)
    assert tables.require_new_data(spark, name, offered) == 2
    assert tables.count_gate(spark.table(name), offered).first() == (3, 5, 2, True)
    with pytest.raises(tables.NoNewData, match="No new data"):
        tables.require_new_data(spark, name, spark.range(7, 10).toDF("id"))
    # equal counts hide new keys; the anti-join finds them
    assert tables.new_rows(spark.table(name), spark.range(1, 4).toDF("id"), ["id"]).first().id == 3


def test_small_parts_are_written_as_one_file(spark, schema):
    tables.replace_table(tables.evenly(spark.range(100).repartition(7)), f"{schema}.b")
    assert len(spark.table(f"{schema}.b").inputFiles()) == 1
    assert content(spark, f"{schema}.b") == [(i,) for i in range(100)]


def test_digits_only(spark):
    df = tables.literal_rows(spark, [("21,345 matches",), ("none",), (None,)], "t string")
    assert [r[0] for r in df.select(tables.digits_only(F.col("t"))).collect()] == [21345, None, None]


def test_schemas(spark):
    tables.create_schemas(spark, "default")
    assert "default" in tables.list_schemas(spark)


def test_logged_runs(spark, schema):
    log = f"{schema}.t_job"
    assert joblog.run_logged(spark, log, "load", lambda x: x + 1, "Orchestrator", x=1) == 2

    def stop():
        raise tables.NoNewData()

    def fail():
        raise ValueError("broken")

    with pytest.raises(tables.NoNewData):
        joblog.run_logged(spark, log, "gate", stop, "Ingest", parent="load")
    with pytest.raises(ValueError):
        joblog.run_logged(spark, log, "build", fail, "Build", parent="load")
    rows = {r.job_name: r for r in joblog.logged_jobs(spark.table(log)).collect()}
    assert {n: (r.status, r.message) for n, r in rows.items()} == {
        "load": ("Completed", None), "gate": ("Completed", "No new data"), "build": ("Failed", "broken"),
    }
    assert rows["gate"].parent_job_id == rows["load"].job_id == joblog.latest_job_id(spark.table(log), "load")
    assert all(r.end_time is not None for r in rows.values())
    joblog.start_job(spark, log, "timed", job_id="j")
    joblog.end_job(spark, log, "j", "Completed", duration=90)
    timed = joblog.logged_jobs(spark.table(log)).filter("job_id = 'j'").first()
    assert (timed.end_time - timed.start_time).total_seconds() == 90
    report = joblog.job_report(joblog.logged_jobs(spark.table(log)), F.current_timestamp())
    assert {r.job_name: r.is_latest_parent for r in report.collect()} == {
        "load": "Y", "gate": "Y", "build": "Y", "timed": None,
    }


def test_merge_with_a_repeated_key_fails(spark, schema):
    name = f"{schema}.t_twice"
    tables.replace_table(tables.literal_rows(spark, [(1, "a"), (2, "b")], "k int, v string"), name)
    twice = tables.literal_rows(spark, [(1, "x"), (1, "y")], "k int, v string")
    with pytest.raises(Exception, match="several source rows"):
        tables.merge_update(twice, name, ["k"], {"v": "s.v"})
    assert {tuple(r) for r in spark.table(name).collect()} == {(1, "a"), (2, "b")}


def test_two_writers_of_the_log(spark, schema):
    log = f"{schema}.t_shared"
    first, second = (joblog.start_job(spark, log, name) for name in ("a", "b"))
    joblog.end_job(spark, log, second, "Failed", "late")
    joblog.end_job(spark, log, first, "Completed")
    child = joblog.start_job(spark, log, "c", parent_id=first)
    rows = {r.job_id: r for r in joblog.logged_jobs(spark.table(log)).collect()}
    assert (rows[first].status, rows[second].status, rows[child].status) == ("Completed", "Failed", "InProgress")
    assert rows[child].parent_job_id == first and rows[child].end_time is None


def folders(spark, name):
    """Files of each partition."""
    found = {}
    for path in spark.table(name).inputFiles():
        folder, file = path.rsplit("/", 2)[1:]
        found.setdefault(folder, set()).add(file)
    return found


def test_an_update_writes_only_the_folders_it_touches(spark, schema):
    name = f"{schema}.t_parted"
    rows = [(i, f"v{i}", None if i % 4 == 3 else i % 4) for i in range(40)]
    tables.create_partitioned(tables.literal_rows(spark, rows, "k int, v string, part int"), name, ["part"])
    before = folders(spark, name)
    assert len(before) == 4 and tables.partition_columns(spark, name) == ["part"]
    change = tables.literal_rows(spark, [(5, "x"), (9, "y"), (3, "z"), (999, "none")], "k int, v string")
    tables.merge_update(change, name, ["k"], {"v": "t.v || s.v"})
    after = folders(spark, name)
    assert set(after) == set(before)
    touched = {"part=1", "part=__HIVE_DEFAULT_PARTITION__"}
    assert {f for f in before if before[f] != after[f]} == touched
    new = {5: "v5x", 9: "v9y", 3: "v3z"}
    assert sorted(spark.table(name).collect(), key=lambda r: r.k) == [(k, new.get(k, v), p) for k, v, p in rows]
    # Nothing to update writes nothing; a partition column stays.
    tables.merge_update(change.filter("k = 999"), name, ["k"], {"v": "s.v"})
    assert folders(spark, name) == after
    with pytest.raises(ValueError, match="part"):
        tables.merge_update(change, name, ["k"], {"part": "1"})
    with pytest.raises(Exception, match="several source rows"):
        tables.merge_update(change.union(change), name, ["k"], {"v": "s.v"})
    assert folders(spark, name) == after


def test_ids_of_two_loads_at_once(spark, schema):
    name = f"{schema}.t_hashed"

    def names(*values):
        return tables.literal_rows(spark, [(v,) for v in values], "n string")

    def ids(bits):
        return {r.n: r.id for r in tables.hashed_ids(spark.table(name), "id", "n", bits).collect()}

    # Both look before either writes.
    first, second = tables.hashed_rows(names("a", "b", "b", None), name, "n"), tables.hashed_rows(names("b", "c"), name, "n")
    tables.append_table(first, name)
    tables.append_table(second, name)
    before = {bits: ids(bits) for bits in (63, 2)}
    assert all(set(found) == {"a", "b", "c"} and len(set(found.values())) == 3 for found in before.values())
    # Later names change no id, clash or not, and known ones add no row.
    tables.create_or_insert_hashed(names("c", *[f"n{i}" for i in range(30)]), name, "n")
    assert spark.table(name).count() == 4 + 30
    for bits, known in before.items():
        found = ids(bits)
        assert len(set(found.values())) == 33 and {n: found[n] for n in known} == known
    assert sum(i < 0 for i in ids(2).values()) >= 29 and all(i > 0 for i in ids(63).values())
