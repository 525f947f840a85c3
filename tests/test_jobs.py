"""File-based jobs on a small folder tree (the FIXTURES golden example as files)."""

import json

import pytest

from colloquy.operators.requests import LabellingRun
from colloquy.operators.runs import one_segment_means, run_means
from colloquy.plans.jobs import labelling_requests, problems, read_score_files, score_runs
from colloquy.sources.sinks import score_file_payload, write_scores
from colloquy.operators.scoring import to_tall

RAW = [{"timestamp": [0.0, 1.5], "text": " Hello there."}, {"timestamp": [1.5, 2.0], "text": " Hi."},
       {"timestamp": [2.0, 4.0], "text": " How long have you felt sick?"},
       {"timestamp": [4.0, 5.5], "text": " About two days."}]
GOLD = "student: Hello there.\n\npatient: Hi.\n\nstudent: How long have you felt sick?\n\npatient: About two days."
PRED = ("Student: Hello there.\n\nPatient: Hi.\n\nPatient: How long have you felt sick?\n\n"
        "Patient: About two days.\n\n")


@pytest.fixture()
def tree(tmp_path):
    (tmp_path / "input").mkdir()
    (tmp_path / "input" / "01.json").write_text(json.dumps(RAW))
    (tmp_path / "gold").mkdir()
    (tmp_path / "gold" / "01.txt").write_text(GOLD)
    for run, text in [("my run", PRED), ("perfect", GOLD.replace("student", "Student")
                                          .replace("patient", "Patient") + "\n\n")]:
        (tmp_path / "labelled" / run).mkdir(parents=True)
        (tmp_path / "labelled" / run / "01.txt").write_text(text)
    (tmp_path / "ids.jsonl").write_text('{"id": "01"}\n{"id": "07"}')
    return tmp_path


def test_score_runs_from_files(spark, tree):
    scores = score_runs(spark, str(tree / "labelled"), str(tree / "input"), str(tree / "gold"),
                        str(tree / "ids.jsonl"), segments=1)
    rows = {r.run_name: r for r in scores.collect()}
    assert set(rows) == {"my run", "perfect"}
    assert rows["my run"].lev_acc == pytest.approx(1 - 18 / 97)
    assert rows["my run"].diff_acc_normed == pytest.approx(0.5511363636363635)
    assert rows["perfect"].lev_acc == 1.0 and rows["perfect"].lev_pres == 1.0


def test_scores_round_trip_and_means(spark, tree, tmp_path):
    scores = score_runs(spark, str(tree / "labelled"), str(tree / "input"), str(tree / "gold"),
                        segments=1)
    write_scores(scores, str(tmp_path / "scores"))
    assert spark.read.parquet(str(tmp_path / "scores")).count() == 2
    payload = score_file_payload(to_tall(scores), shards=1).collect()
    out = tmp_path / "score_files"
    out.mkdir()
    for r in payload:
        (out / f"{r.run_name}.json").write_text(r.value)
    wide = read_score_files(spark, str(out))
    means = {r.run_name: r for r in run_means(wide).collect()}
    assert means["my run"].composite == pytest.approx((1 - 18 / 97 + 0.8977272727272727) / 2)
    from colloquy.sources.sinks import write_score_files
    write_score_files(score_file_payload(to_tall(scores), shards=3), str(tmp_path / "sharded"))
    sharded = read_score_files(spark, str(tmp_path / "sharded"), sharded=True)
    cols = sorted(wide.columns)
    assert sorted(map(tuple, sharded.select(cols).collect())) == sorted(map(tuple, wide.select(cols).collect()))


def test_labelling_requests_from_files(spark, tree):
    prompts = spark.createDataFrame([("diarize_no_summary", "Label the speakers.")],
                                    "prompt_name string, text string")
    runs = [LabellingRun("c3", "claude-sonnet-3.5").override(chunk_num=3), LabellingRun("x", "unknown-model")]
    req = {(r.run_name, r.chunk): r for r in labelling_requests(spark, str(tree / "input"), runs, prompts,
                                                                 str(tree / "ids.jsonl")).collect()}
    assert set(req) == {("c3", 0), ("c3", 1), ("c3", 2), ("x", 0)}
    assert req[("c3", 0)].model_id == "claude-3-5-sonnet-20240620"
    assert req[("c3", 0)].system == "Label the speakers."
    # chunk text is " " + utterance text, and raw utterances start with a space
    assert req[("c3", 0)].messages[0].content == "transcript:   Hello there."
    assert req[("c3", 2)].messages[0].content == "transcript:   How long have you felt sick?  About two days."
    assert req[("x", 0)].provider is None and req[("x", 0)].problem == "unknown model"


def test_request_settings_and_missing_summaries(spark, tree):
    (tree / "input" / "02.json").write_text("[]")
    prompts = spark.createDataFrame([("diarize_w_summary", "With."), ("summary", "Sum.")],
                                    "prompt_name string, text string")
    runs = [LabellingRun("s", "llama-70b", "azure", None, True, 2, azure_deployment_summary="dep",
                         top_p_diarize=0.5), LabellingRun("plain", "llama-8b")]
    ask = lambda **kw: labelling_requests(spark, str(tree / "input"), runs, prompts, **kw).collect()
    summary = ask(stage="summary")
    assert {r.run_name for r in summary} == {"s"} and {r.model_id for r in summary} == {"dep"}
    assert sorted((r.id, r.chunk) for r in summary) == [("01", 0), ("01", 1), ("02", 0), ("02", 1)]
    whole = {r.id: r for r in ask(stage="summary", summary_chunking=False)}
    assert whole["01"].chunk is None and whole["02"].messages[0].content == "Sum.\n\ntranscript: \n\n\n\n\n\n"
    label = {(r.run_name, r.id, r.chunk): r for r in ask()}
    assert label[("s", "01", 0)].problem == "no summary" and label[("s", "01", 0)].messages[1].content is None
    assert label[("s", "01", 0)].model_id == "70b-instruct" and label[("s", "01", 0)].top_p == 0.5
    assert label[("plain", "01", 0)].problem == "no prompt" and label[("plain", "01", 0)].model_id == "8b-instruct"
    answers = spark.createDataFrame([("s", "01", 0, "S0"), ("s", "01", 1, "S1")],
                                    "run_name string, id string, chunk int, summary string")
    with_summary = {(r.run_name, r.id, r.chunk): r for r in ask(summaries=answers)}
    assert with_summary[("s", "01", 1)].messages[1].content.startswith("summary: S1\n\ntranscript: ")
    assert with_summary[("s", "02", 0)].problem == "no summary"


def test_nothing_is_lost_in_silence(spark, tree):
    (tree / "labelled" / "my run" / "02.txt").write_text("")
    for side, text in (("input", json.dumps(RAW)), ("gold", GOLD)):
        (tree / side / ("02.json" if side == "input" else "02.txt")).write_text(text)
    (tree / "ids.jsonl").write_text('{"id": "01"}\n{"id": "02"}\n{"id": "07"}')
    args = (spark, str(tree / "labelled"), str(tree / "input"), str(tree / "gold"), str(tree / "ids.jsonl"))
    rows = {(r.run_name, r.id): r for r in score_runs(*args, segments=1).collect()}
    assert rows[("my run", "02")].lev_acc == 0.0 and rows[("my run", "02")].lev_pres == 0.0
    found = {tuple(r) for r in problems(*args).collect()}
    assert found == {("my run", "07", "no labelled file"), ("perfect", "07", "no labelled file"),
                     ("perfect", "02", "no labelled file")}
    with pytest.raises(ValueError, match="07"):
        score_runs(*args, segments=1, strict=True)


def test_broken_json_is_reported_not_scored(spark, tree):
    turns = [{"chunk": 0, "speaker": "Student", "text": " Hello there."}]
    run = tree / "json" / "r"
    run.mkdir(parents=True)
    for name, text in (("01", json.dumps(turns)), ("02", json.dumps(turns)[:20]), ("03", "[]"), ("04", "{}")):
        (run / f"{name}.json").write_text(text)
        (tree / "gold" / f"{name}.txt").write_text(GOLD)
        (tree / "input" / f"{name}.json").write_text(json.dumps(RAW))
    (tree / "input" / "03.json").write_text('[{"text": ')
    args = (spark, str(tree / "json"), str(tree / "input"), str(tree / "gold"))
    rows = {r.id: r for r in score_runs(*args, segments=1, input_json=True).collect()}
    assert set(rows) == {"01", "03"} and rows["03"].lev_acc == 0.0 and rows["03"].lev_pres is None
    assert {(r.id, r.reason) for r in problems(*args, input_json=True).collect()} == {
        ("02", "malformed labelled file"), ("04", "malformed labelled file"), ("03", "malformed raw file")}


def test_written_labels_are_scored(spark, tree, tmp_path):
    from colloquy.sources.sinks import render_json, write_json_and_txt
    txt = spark.createDataFrame([("a", "01", PRED), ("a", "02", "")], "run_name string, id string, value string")
    turns = spark.createDataFrame([("a", "01", 0, 0, "Student", " Hello there.")],
                                  "run_name string, id string, chunk int, pos int, speaker string, text string")
    js = render_json(turns, transcripts=txt)
    assert {r.id: r.value for r in js.collect()}["02"] == "[]"
    write_json_and_txt(txt, js, str(tmp_path / "out"))
    args = (str(tree / "input"), str(tree / "gold"))
    rows = {r.id: r for r in score_runs(spark, str(tmp_path / "out" / "text"), *args, segments=1).collect()}
    assert rows["01"].lev_acc == pytest.approx(1 - 18 / 97) and set(rows) == {"01", "02"}
    rows = {r.id: r for r in score_runs(spark, str(tmp_path / "out" / "json"), *args, segments=1, input_json=True).collect()}
    assert set(rows) == {"01", "02"} and rows["01"].lev_acc > 0


def test_one_segment_means_take_segment_zero(spark, tmp_path):
    (tmp_path / "x-seg.json").write_text(json.dumps(
        [["01"], {"accuracy": {"levenshtein": {"01": {"0": 1.0, "1": 0.0}}}}]))
    wide = read_score_files(spark, str(tmp_path))
    assert run_means(wide).first().lev_acc == 0.5 and one_segment_means(wide).first().lev_acc == 1.0


def test_turn_segmentation_aligns_sides(spark, tree):
    by_line = {r.run_name + str(r.segment): r for r in
               score_runs(spark, str(tree / "labelled"), str(tree / "input"), str(tree / "gold"),
                          segments=2, metrics=("levenshtein",)).collect()}
    by_turn = {r.run_name + str(r.segment): r for r in
               score_runs(spark, str(tree / "labelled"), str(tree / "input"), str(tree / "gold"),
                          segments=2, metrics=("levenshtein",), segment_by="turn").collect()}
    # turn cuts put the same turns in the same segment on every side
    assert by_turn["perfect0"].lev_acc == 1.0 and by_turn["perfect1"].lev_acc == 1.0
    assert by_turn["perfect0"].lev_pres == 1.0 and by_turn["perfect1"].lev_pres == 1.0
    assert set(by_line) == set(by_turn)


def test_plain_text_to_utterance_json(spark, tmp_path):
    from colloquy.plans.jobs import utterances_from_texts
    (tmp_path / "txt").mkdir()
    (tmp_path / "txt" / "01.txt").write_text("Hello, Mr. Jo. Hi! A?  b.")
    row = utterances_from_texts(spark, str(tmp_path / "txt")).first()
    assert row.id == "01"
    assert [u["text"] for u in json.loads(row.value)] == ["Hello, Mr. Jo.", "Hi!", "A?", "b."]


def test_manifest_first_match_and_missing_files(spark, tmp_path):
    from pyspark.sql import functions as F
    from colloquy.plans.jobs import missing_files
    from colloquy.sources.decoders import decode_manifest, read_ids, read_whole
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "lookup.csv").write_text(
        'id,path\n01,"/data/a/01.mp4"\n02,/data/b/02.wav\n01,/data/c/01.mp4\n')
    m = decode_manifest(read_whole(spark, str(tmp_path / "m")))
    first = {r.id: r.path for r in m.groupBy("id").agg(F.min_by("path", "line_no").alias("path")).collect()}
    assert first == {"01": "/data/a/01.mp4", "02": "/data/b/02.wav"}
    (tmp_path / "m2").mkdir()
    (tmp_path / "m2" / "lookup.csv").write_text('path,grade,id\n/data/01.mp4,A,01\n')
    assert [tuple(r) for r in decode_manifest(read_whole(spark, str(tmp_path / "m2"))).collect()] == [(1, "01", "/data/01.mp4")]
    (tmp_path / "ids.jsonl").write_text('{"id": "01"}\n{"id": "03"}\n')
    files = spark.createDataFrame([("01", "x")], "id string, value string")
    assert [r.id for r in missing_files(read_ids(spark, str(tmp_path / "ids.jsonl")), files).collect()] == ["03"]


def test_raw_transcript_files(spark):
    import json
    from colloquy.plans.jobs import raw_transcript_files
    rows = [("01", k, float(k), k + 1.0, t) for k, t in enumerate(["a", "\n", "b b", "c", "d"])] + [("2", 0, 0.0, 1.0, "x")]
    utts = spark.createDataFrame(rows, "id string, pos int, start_s double, end_s double, text string")
    got = {r.name: r for r in raw_transcript_files(utts, 2, "run").collect()}
    assert set(got) == {"run_01", "run_2"}
    assert got["run_01"].txt == " a\n\n b b c d\n\n"
    chunks = json.loads(got["run_01"].json)
    assert {k: [u["text"] for u in v] for k, v in chunks.items()} == {"chunk 0": ["a", "\n"], "chunk 1": ["b b", "c", "d"]}
    assert {k: len(v) for k, v in json.loads(got["run_2"].json).items()} == {"chunk 0": 0, "chunk 1": 1}
    alone = {r.name: r for r in raw_transcript_files(utts, 1).collect()}
    assert set(alone) == {"01", "2"} and [u["text"] for u in json.loads(alone["01"].json)] == ["a", "\n", "b b", "c", "d"]
