import json
import uuid

import pytest
from matches import MATCHES, ball, info, innings, write_all
from pavilion.operators.tables import NoNewData
from pavilion.plans import joblog, load as load_plan, reports
from pavilion.plans.load import load, stored_star
from pavilion.session import shared_dir
from pavilion.sources import folders
from pavilion.sources.match_json import read_matches
from pyspark.sql import functions as F


def test_loads_keep_ids_and_log_their_steps(spark, tmp_path):
    suffix = uuid.uuid4().hex[:8]
    schemas = [f"{s}_{suffix}" for s in ("staging", "reporting", "logs")]
    for s in schemas:
        spark.sql(f"CREATE SCHEMA {s} LOCATION '{shared_dir(spark)}/{s}'")
    write_all(tmp_path)

    def run():
        return load(spark, read_matches(spark, str(tmp_path)), *schemas)

    def names():
        return {r.player_name: r.player_id for r in spark.table(f"{schemas[1]}.t_dim_player").collect()}

    run()
    before = names()
    assert before["Extras"] == -1 and len(before) == 7
    with pytest.raises(NoNewData):
        run()
    new = info("2022-01-01", "A", {"runs": 1}, players={"A": ["a1", "a0"], "C": ["c1"]})
    text = json.dumps({"info": new, "innings": [innings("C", [ball("c1", "a0", "c1", 4)])]})
    (tmp_path / "9.json").write_text(text)
    run()
    after = names()
    # new names come after all known ones, in name order
    assert {k: after[k] for k in before} == before and (after["a0"], after["c1"]) == (7, 8)
    star = stored_star(spark, schemas[1])
    assert star.matches.count() == len(MATCHES) + 1
    assert star.deliveries.filter("match_id = 9").first().batting_team_id == 3
    assert {r.player_name: r.batter_runs for r in reports.player_stats(star).collect()}["c1"] == 4
    jobs = joblog.logged_jobs(spark.table(f"{schemas[2]}.t_job"))
    gates = [r.message for r in jobs.filter("job_name = 'Gate Staging'").orderBy("start_time").collect()]
    assert sorted(gates, key=str) == ["No new data", None, None]
    assert jobs.filter("status <> 'Completed'").count() == 0
    assert joblog.monitor(jobs, F.current_timestamp()).count() == jobs.count() == 1 + 2 * 9


def test_a_folder_is_loaded_by_its_new_files(spark, tmp_path):
    suffix = uuid.uuid4().hex[:8]
    schemas = [f"{s}_{suffix}" for s in ("staging", "reporting", "logs")]
    for s in schemas:
        spark.sql(f"CREATE SCHEMA {s} LOCATION '{shared_dir(spark)}/{s}'")
    write_all(tmp_path)
    (tmp_path / "77.json").write_text("{")

    def staged():
        return {r.file_name: r for r in spark.table(f"{schemas[0]}.t_match_document").collect()}

    load(spark, str(tmp_path), *schemas)
    first = staged()
    assert set(first) == set(MATCHES)
    assert [(r.file_name, r.problem) for r in spark.table(f"{schemas[0]}.t_refused_file").collect()] == [("77.json", "not a JSON object")]
    with pytest.raises(NoNewData):
        load(spark, str(tmp_path), *schemas)
    # A mended file, a new version of one, and one more: the others keep the row of the first load.
    for name in ("77.json", "5.json", "78.json"):
        more = info("2022-01-01", "A", {"runs": 1}, season=name)
        (tmp_path / name).write_text(json.dumps({"info": more, "innings": [innings("A", [ball("a1", "b1", "a2", 4)])]}))
    star = load(spark, str(tmp_path), *schemas)
    second = staged()
    assert set(second) == {*MATCHES, "77.json", "78.json"}
    assert {n for n in first if second[n] != first[n]} == {"5.json"}
    assert {r.season for r in star.matches.collect()} >= {"77.json", "5.json", "78.json"}
    jobs = joblog.logged_jobs(spark.table(f"{schemas[2]}.t_job"))
    assert sorted((r.status, str(r.message)) for r in jobs.filter("job_name = 'Gate Staging'").collect()) == [
        ("Completed", "No new data"), ("Completed", "None"), ("Completed", "None"),
    ]


def test_a_large_folder_is_loaded_without_its_files_on_the_driver(spark, tmp_path, monkeypatch):
    schema = f"large_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE SCHEMA {schema} LOCATION '{shared_dir(spark)}/{schema}'")
    monkeypatch.setattr(folders, "SCANNED", 3)
    seen, staged = [], load_plan.stage_files
    monkeypatch.setattr(load_plan, "stage_files", lambda spark, folder, new, *names: seen.append({r.file_name for r in new.collect()}) or staged(spark, folder, new, *names))
    lists, reads = load_plan.list_files, load_plan.read_files
    for name, read in (("list_files", lists), ("read_files", reads)):
        monkeypatch.setattr(load_plan, name, lambda *given, read=read: held(read(*given)))

    def held(df):
        assert not any(str(tmp_path) in f for f in df.inputFiles())
        return df

    def table(name):
        return {r.file_name: r for r in spark.table(f"{schema}.{name}").collect()}

    write_all(tmp_path)
    (tmp_path / "77.json").write_text("{")
    assert load(spark, str(tmp_path), schema, schema, schema).matches.count() == len(MATCHES)
    first = table("t_match_document")
    assert set(first) == set(MATCHES) and set(table("t_refused_file")) == {"77.json"}
    with pytest.raises(NoNewData):
        load(spark, str(tmp_path), schema, schema, schema)
    more = info("2022-01-01", "A", {"runs": 1}, season="new")
    (tmp_path / "5.json").write_text(json.dumps({"info": more, "innings": [innings("A", [ball("a1", "b1", "a2", 4)])]}))
    load(spark, str(tmp_path), schema, schema, schema)
    second = table("t_match_document")
    assert {n for n in first if second[n] != first[n]} == {"5.json"} and set(second) == set(first)
    assert seen == [{*MATCHES, "77.json"}, {"5.json"}]
