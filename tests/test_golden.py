"""The invented golden example of FIXTURES.md, scored end to end from files."""

import pytest
from pyspark.sql import functions as F

from colloquy.operators.consolidate import segment_texts_from_lines, segment_texts_from_turns
from colloquy.operators.requests import parse_answers
from colloquy.operators.scoring import score_segments
from colloquy.operators.segments import flatten_text
from colloquy.sources.decoders import decode_lines, decode_turns, decode_utterances, read_whole
from colloquy.sources.sinks import render_json

RAW = '[{"timestamp": [0.0, 1.5], "text": " Hello there."}, {"timestamp": [1.5, 2.0], "text": " Hi."},' \
      ' {"timestamp": [2.0, 4.0], "text": " How long have you felt sick?"},' \
      ' {"timestamp": [4.0, 5.5], "text": " About two days."}]'
GOLD = "student: Hello there.\n\npatient: Hi.\n\nstudent: How long have you felt sick?\n\npatient: About two days."
PRED = ("Student: Hello there.\n\nPatient: Hi.\n\nPatient: How long have you felt sick?\n\n"
        "Patient: About two days.\n\n")

EXPECTED = {
    "canonical": dict(lev_acc=1 - 18 / 97, lev_baseline=1 - 36 / 97, lev_acc_normed=0.5,
                      diff_acc=0.8977272727272727, diff_baseline=0.7721518987341772,
                      diff_acc_normed=0.5511363636363635),
    "literal": dict(lev_acc=1.0, lev_baseline=1 - 9 / 70, lev_acc_normed=1.0, diff_acc=1.0,
                    diff_baseline=0.9312977099236641, diff_acc_normed=1.0),
}


def sides(spark, mode, raw_norm="always"):
    raw_files = spark.createDataFrame([("01", RAW)], "id string, value string")
    utts = decode_utterances(raw_files, ["id"])
    raw = flatten_text(utts, ["id"], 1, raw_norm, transcripts=raw_files.select("id"))
    gold_files = spark.createDataFrame([("01", GOLD)], "id string, value string")
    gold = segment_texts_from_lines(decode_lines(gold_files, ["id"]), 1, ["id"], gold_files, mode,
                                    with_bare=False)
    pred_files = spark.createDataFrame([("run", "01", PRED)], "run_name string, id string, value string")
    pred = segment_texts_from_lines(decode_lines(pred_files, ["run_name", "id"]), 1, ["run_name", "id"],
                                    pred_files.select("run_name", "id"), mode)
    return raw, gold, pred


@pytest.mark.parametrize("mode", ["canonical", "literal"])
def test_golden_scores(spark, mode):
    raw, gold, pred = sides(spark, mode)
    row = score_segments(pred, gold, raw).first().asDict()
    for k, v in EXPECTED[mode].items():
        assert row[k] == pytest.approx(v, abs=1e-12), k
    assert row["lev_pres"] == 1.0
    assert row["composite"] == pytest.approx((row["lev_acc"] + row["diff_acc"]) / 2)


def test_golden_texts(spark):
    raw, gold, pred = sides(spark, "canonical")
    assert gold.first().labelled == ("Student: Hello there. Patient: Hi. Student: How long have you felt "
                                     "sick? Patient: About two days.")
    p = pred.first()
    assert p.labelled == "Student: Hello there. Patient: Hi. How long have you felt sick? About two days."
    assert p.bare == "Hello there. Hi. How long have you felt sick? About two days."
    _, lgold, lpred = sides(spark, "literal")
    assert lgold.first().labelled == "Student: Hello there. Hi. How long have you felt sick? About two days."
    assert lpred.first().labelled == lgold.first().labelled


def test_raw_literal_is_not_collapsed(spark):
    raw, gold, pred = sides(spark, "canonical", raw_norm="literal")
    assert raw.first().text == "  Hello there.  Hi.  How long have you felt sick?  About two days."
    row = score_segments(pred, gold, raw).first()
    assert row.lev_pres == pytest.approx(1 - 5 / 66)
    assert row.diff_pres == pytest.approx(0.9606299212598425)


def test_json_path_matches_txt_path(spark):
    answers = spark.createDataFrame([("run", "01", 0, PRED.rstrip("\n"))],
                                    "run_name string, id string, chunk int, answer string")
    turns = parse_answers(answers).withColumnRenamed("block", "pos")
    files = render_json(turns)
    js = segment_texts_from_turns(decode_turns(files, ["run_name", "id"]), 1, ["run_name", "id"],
                                  files.select("run_name", "id"))
    _, _, txt = sides(spark, "canonical")
    assert js.first().labelled == txt.first().labelled
    assert js.first().bare == txt.first().bare


def test_more_segments_than_lines_gives_empty_segments(spark):
    pred_files = spark.createDataFrame([("run", "01", "Student: a\n\nPatient: b")],
                                       "run_name string, id string, value string")
    segs = segment_texts_from_lines(decode_lines(pred_files, ["run_name", "id"]), 9, ["run_name", "id"],
                                    pred_files.select("run_name", "id")).orderBy("segment").collect()
    assert [s.segment for s in segs] == list(range(9))
    assert [s.labelled for s in segs[:8]] == [""] * 8
    assert segs[8].labelled == "Student: a Patient: b"


def test_unlabelled_line_continues_speaker(spark):
    pred_files = spark.createDataFrame([("run", "01", "Student: a\nmore\n\nPatient: b\n\nPatient: c")],
                                       "run_name string, id string, value string")
    seg = segment_texts_from_lines(decode_lines(pred_files, ["run_name", "id"]), 1, ["run_name", "id"],
                                   pred_files.select("run_name", "id")).first()
    assert seg.labelled == "Student: a more Patient: b c"


def test_baseline_one_gives_null_normed(spark):
    gold_files = spark.createDataFrame([("01", "x")], "id string, value string")
    gold = segment_texts_from_lines(decode_lines(gold_files, ["id"]), 1, ["id"], gold_files, with_bare=False)
    pred = spark.createDataFrame([("run", "01", 0, "Unknown:x", "Unknown:x")],
                                 "run_name string, id string, segment int, labelled string, bare string")
    row = score_segments(pred, gold, families=("accuracy",)).first()
    assert row.lev_baseline == 1.0 and row.lev_acc_normed is None


def test_read_whole_decodes_file_names(spark, tmp_path):
    d = tmp_path / "scores"
    d.mkdir()
    (d / "my run-3-seg.json").write_text('[["01"], {"accuracy": {"levenshtein": {"01": {"0": 0.5}}}}]')
    files = read_whole(spark, str(d), name_col="run_name", strip_suffix=".json")
    from colloquy.sources.decoders import decode_scores
    row = decode_scores(files).first()
    assert (row.run_name, row.family, row.metric, row.id, row.segment, row.score) == \
        ("my run-3-seg", "accuracy", "levenshtein", "01", 0, 0.5)


def test_id_list_keeps_leading_zeros(spark, tmp_path):
    p = tmp_path / "ids.jsonl"
    p.write_text('{"id": "01"}\n{"id": "02"}')
    from colloquy.sources.decoders import read_ids
    assert [r.id for r in read_ids(spark, str(p)).collect()] == ["01", "02"]


def test_write_txt_and_json_side_by_side(spark, tmp_path):
    from colloquy.sources.sinks import render_json, write_json_and_txt
    answers = spark.createDataFrame([("run", "01", 0, PRED.rstrip("\n"))],
                                    "run_name string, id string, chunk int, answer string")
    from colloquy.operators.requests import parse_answers
    from colloquy.sources.sinks import render_txt
    turns = parse_answers(answers).withColumnRenamed("block", "pos")
    write_json_and_txt(render_txt(answers), render_json(turns), str(tmp_path / "out"))
    from colloquy.sources.decoders import read_exported
    txt = read_exported(spark, str(tmp_path / "out" / "text")).first()
    assert txt.value == PRED and txt.run_name == "run"
    js = read_exported(spark, str(tmp_path / "out" / "json")).first().value
    import json
    assert [t["speaker"] for t in json.loads(js)] == ["Student", "Patient", "Patient", "Patient"]
    from colloquy.sources.sinks import export_files
    export_files(render_txt(answers), str(tmp_path / "files"))
    back = read_exported(spark, str(tmp_path / "files")).first()
    assert (back.run_name, back.id, back.value) == ("run", "01", PRED)


def test_read_prompts(spark, tmp_path):
    from colloquy.sources.decoders import read_prompts
    (tmp_path / "summary prompt.txt").write_text("Summarise.\n")
    row = read_prompts(spark, str(tmp_path)).first()
    assert (row.prompt_name, row.text) == ("summary prompt", "Summarise.\n")


def test_chunked_json_map(spark):
    import json
    from colloquy.sources.sinks import render_chunked_json
    utts = spark.createDataFrame([("01", p, float(p), float(p + 1), f" u{p}") for p in range(5)],
                                 "id string, pos int, start_s double, end_s double, text string")
    two = json.loads(render_chunked_json(utts, 2).first().value)
    assert list(two) == ["chunk 0", "chunk 1"]
    assert [u["text"] for u in two["chunk 0"]] == [" u0", " u1"]
    assert [u["text"] for u in two["chunk 1"]] == [" u2", " u3", " u4"]
    assert two["chunk 1"][0]["timestamp"] == [2.0, 3.0]
    nine = json.loads(render_chunked_json(utts, 9).first().value)
    assert [len(nine[f"chunk {k}"]) for k in range(9)] == [0] * 8 + [5]
    one = json.loads(render_chunked_json(utts, 1).first().value)
    assert [u["text"] for u in one] == [" u0", " u1", " u2", " u3", " u4"]
