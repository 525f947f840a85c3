"""Whole-file source: empty, nested, many and oddly named files."""

import gzip
import json

import pytest

from colloquy.plans.jobs import read_run_files, score_runs, write_raw_transcripts
from colloquy.sources.decoders import read_paths, read_whole
from colloquy.sources.files import WholeFilesReader, WholeFilesWriter, write_shared
from colloquy.sources.sinks import model_answers, render_txt, write_named_files


def test_empty_odd_and_hidden_files(spark, tmp_path):
    texts = {"a.txt": "héllo\r\nx\n", "b.txt": "", "c d%20é+.txt": "﻿x", "[1].txt": "one", "_no.txt": "n", ".no.txt": "n"}
    for name, text in texts.items():
        (tmp_path / name).write_text(text, newline="")
    (tmp_path / "sub.txt").mkdir()
    (tmp_path / "sub.txt" / "deep.txt").write_text("deep")
    (tmp_path / "z.json.gz").write_bytes(gzip.compress(b"[]"))
    (tmp_path / "bad.txt").write_bytes(b"a\xffb")
    want = {k: v for k, v in texts.items() if k[0] not in "_."} | {"bad.txt": "a�b"}
    got = {r.name: r.value for r in read_whole(spark, str(tmp_path / "*.txt")).collect()}
    assert got == want
    assert {r.name: r.value for r in read_whole(spark, f"file:{tmp_path}").collect()} == want | {"z.json.gz": "[]"}
    assert [r.value for r in read_paths(spark, str(tmp_path / "b.txt")).collect()] == [""]
    assert [r.value for r in read_paths(spark, str(tmp_path / "[[]1].txt")).collect()] == ["one"]
    assert read_paths(spark, str(tmp_path / "*.none")).count() == 0
    with pytest.raises(FileNotFoundError):
        read_paths(spark, str(tmp_path / "absent" / "*.txt"))
    # alternatives go through Spark's own reader, with the same rows
    assert {r.value for r in read_paths(spark, str(tmp_path / "{a,b}.txt")).collect()} == {texts["a.txt"], ""}


def test_many_files_of_one_folder_are_dealt_over_tasks(spark, tmp_path):
    for k in range(600):
        (tmp_path / f"{k:04d}.txt").write_text("" if k % 7 == 0 else f"text {k}")
    reader = WholeFilesReader(str(tmp_path), 8)
    parts = [[p for p, _ in reader.read(part)] for part in reader.partitions()]
    assert len(parts) == 8 and sum(map(len, parts)) == 600 and max(map(len, parts)) < 150
    df = read_whole(spark, str(tmp_path), "id", ".txt")
    assert df.rdd.getNumPartitions() > 1
    assert {r.id: r.value for r in df.collect()} == {f"{k:04d}": "" if k % 7 == 0 else f"text {k}" for k in range(600)}


def test_nested_run_folders(spark, tmp_path):
    for run in ("r 1", "r2"):
        (tmp_path / run).mkdir()
        for k in ("01", "02"):
            (tmp_path / run / f"{k}.txt").write_text("" if run == "r2" else k)
        (tmp_path / run / "notes.json").write_text("{}")
    got = {(r.run_name, r.id): r.value for r in read_run_files(spark, str(tmp_path), ".txt").collect()}
    assert got == {("r 1", "01"): "01", ("r 1", "02"): "02", ("r2", "01"): "", ("r2", "02"): ""}


def test_files_are_named_replaced_and_read_again(spark, tmp_path):
    rows = [("r1", "01", "a\r\n"), ("r1", "02", ""), ("r 2", "01", "é"), ("r 2", "03", None)]
    files = spark.createDataFrame(rows, "run_name string, id string, value string").repartition(3)
    want = {(r, i): v or "" for r, i, v in rows}
    (tmp_path / "tree" / "r1").mkdir(parents=True)
    (tmp_path / "tree" / "r1" / "01.txt").write_text("old")
    (tmp_path / "tree" / "r1" / "09.txt").write_text("stays")
    write_named_files(files, str(tmp_path / "tree"), folders=True)
    got = {(r.run_name, r.id): r.value for r in read_run_files(spark, str(tmp_path / "tree"), ".txt").collect()}
    assert got == want | {("r1", "09"): "stays"}
    write_named_files(files, str(tmp_path / "flat"))
    assert sorted(p.name for p in (tmp_path / "flat").iterdir()) == ["r 2_01.txt", "r 2_03.txt", "r1_01.txt", "r1_02.txt"]
    one = spark.createDataFrame([(None, "07", "x")], "run_name string, id string, value string")
    write_named_files(one, str(tmp_path / "alone"), suffix=".json")
    assert [p.name for p in (tmp_path / "alone").iterdir()] == ["07.json"]


@pytest.mark.parametrize("names", [["01", "01"], ["../out"], ["/etc"], ["_x"], [None]])
def test_a_failed_job_leaves_no_file(spark, tmp_path, names):
    rows = [("ok", "good")] + [(n, "v") for n in names]
    with pytest.raises(Exception):
        write_shared(spark.createDataFrame(rows, "path string, value string"), str(tmp_path / "out"))
    assert not list((tmp_path / "out").iterdir()) if (tmp_path / "out").exists() else True


def test_commit_takes_the_attempts_that_count(tmp_path):
    w = WholeFilesWriter(str(tmp_path))
    w.write([("a.txt", "lost attempt"), ("b/c.txt", "lost")])
    w.commit([w.write([("a.txt", "1")]), w.write([("d/e.txt", "2")])])
    assert {str(p.relative_to(tmp_path)): p.read_text() for p in tmp_path.rglob("*") if p.is_file()} == {"a.txt": "1", "d/e.txt": "2"}
    w.abort([])
    assert not [p for p in tmp_path.iterdir() if p.name.startswith("_")]


def test_label_then_score_over_files(spark, tmp_path):
    """Turns rendered to files that score_runs reads; raw chunks written in both formats."""
    raw = [{"timestamp": [k, k + 1], "text": t} for k, t in enumerate([" Hello there.", " How are you?", "\n", " Fine."])]
    (tmp_path / "input").mkdir()
    (tmp_path / "gold").mkdir()
    for i in ("01", "02"):
        (tmp_path / "input" / f"{i}.json").write_text(json.dumps(raw))
        (tmp_path / "gold" / f"{i}.txt").write_text("Student: Hello there. How are you?\n\nPatient: Fine.")
    turns = spark.createDataFrame([(r, i, k, s, t) for r in ("good", "other") for i in ("01", "02") for k, (s, t) in enumerate(
        [("Student", "Hello there. How are you?"), ("Patient" if r == "good" else "Student", "Fine.")])],
        "run_name string, id string, pos int, speaker string, text string")
    write_named_files(render_txt(model_answers(turns, 1)), str(tmp_path / "labelled"), folders=True)
    scores = {(r.run_name, r.id): r for r in score_runs(
        spark, str(tmp_path / "labelled"), str(tmp_path / "input"), str(tmp_path / "gold"), segments=1).collect()}
    assert set(scores) == {(r, i) for r in ("good", "other") for i in ("01", "02")}
    assert scores["good", "01"].lev_acc == 1.0 > scores["other", "01"].lev_acc
    write_raw_transcripts(spark, str(tmp_path / "input"), str(tmp_path / "raw"), 2, "run", chunked=True)
    made = {p.name: p.read_text() for p in (tmp_path / "raw").iterdir()}
    assert set(made) == {f"run_{i}.{x}" for i in ("01", "02") for x in ("txt", "json")}
    assert made["run_01.txt"].startswith("chunk 0:\n\n") and "Fine." in made["run_01.txt"]
    assert [len(v) for v in json.loads(made["run_02.json"]).values()] == [2, 2]
