import json
import os

from matches import MATCHES, write_all
from pavilion.sources.match_json import file_key, list_files, new_files, problems, read_files, read_matches
from pavilion.sources.sample_star import write_files
from pyspark.sql import functions as F


def test_file_keys(spark):
    cases = {"12.json": 12, "wi_12.json": -12, "abc.json": None, "wibble789.json": 789, "x34y56.json": 34, "7": 7}
    rows = spark.createDataFrame([(k,) for k in cases], "f string").select("f", file_key(F.col("f")).alias("k"))
    assert {r.f: r.k for r in rows.collect()} == cases


def test_multi_line_files_keep_nested_json_as_text(spark, tmp_path):
    write_all(tmp_path)
    rows = {r.file_name: r for r in read_matches(spark, str(tmp_path)).collect()}
    assert set(rows) == set(MATCHES)
    assert rows["wi_4.json"].match_id == -4
    for name, (info, innings) in MATCHES.items():
        assert json.loads(rows[name].match_info) == info
        assert json.loads(rows[name].match_innings) == innings
        assert rows[name].last_update_ts is not None


ODD = {
    "8.json": '{"info": {"a": 1}, "innings": [1,', "9 x+y é%20.json": '{"info": {"a": 1},\n "innings": []}', "11.json": "[1,2]",
    "12.json": '{"info": {}}', "13.json": " \n", "14.json": '"x"', "no.json": '{"info": {"a": 1}, "innings": []}', "15.json": '{"innings": []}',
}


def test_files_that_do_not_parse_are_named(spark, tmp_path):
    write_all(tmp_path)
    for name, text in ODD.items():
        (tmp_path / name).write_text(text)
    (tmp_path / "16.txt").write_text("{}")
    found = {r.file_name: r.problem for r in problems(read_files(spark, str(tmp_path))).collect()}
    broken = "not a JSON object"
    assert found == {"8.json": broken, "11.json": broken, "13.json": broken, "14.json": broken, "12.json": "no innings", "15.json": "no info", "no.json": "no number in the name"}
    staged = {r.file_name: r for r in read_matches(spark, str(tmp_path)).collect()}
    assert set(staged) == {*MATCHES, "9 x+y é%20.json"} and staged["9 x+y é%20.json"].match_id == 9
    listed = {(r.file_name, r.file_bytes, r.file_time) for r in list_files(spark, str(tmp_path)).collect()}
    assert {(r.file_name, r.file_bytes, r.file_time) for r in staged.values()} < listed and len(listed) == len(MATCHES) + len(ODD)


def test_only_new_files_are_opened(spark, tmp_path):
    write_all(tmp_path)
    folder = str(tmp_path)
    for i, name in enumerate(sorted(MATCHES)):
        os.utime(tmp_path / name, (1_000_000 + i, 1_000_000 + i))
    seen = list_files(spark, folder)
    assert "content" not in seen._jdf.queryExecution().executedPlan().toString()
    assert new_files(seen, read_matches(spark, folder)).count() == 0
    new = new_files(seen, seen.filter("file_name <> '5.json' and file_name <> 'wi_4.json'"))
    some = read_files(spark, folder, new)
    assert {r.file_name for r in some.collect()} == {"5.json", "wi_4.json"}
    # Files older than the new ones are passed over by the scan.
    scan = some._jdf.queryExecution().executedPlan().toString()
    assert "FileScan text" in scan and "file_modification_time" in scan.split("DataFilters:")[1].split("Format")[0]


def test_files_are_written_under_their_names(spark, tmp_path):
    """By the tasks: nothing is left to be moved."""
    texts = {f"{i}.json": f'{{"info": {{}},\n "é": {i}}}' for i in range(40)}
    rows = spark.createDataFrame([*texts.items(), (None, "x")], "file_name string, content string").repartition(3)
    write_files(rows, str(tmp_path / "files"))
    assert {p.name: p.read_bytes().decode() for p in (tmp_path / "files").iterdir()} == {k: v + "\n" for k, v in texts.items()}
    assert [p.name for p in tmp_path.iterdir()] == ["files"]
