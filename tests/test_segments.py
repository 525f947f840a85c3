"""Segments in one pass over the rows: equal to the form that unions a grid."""

import json

import pytest

from colloquy.operators.consolidate import segment_texts_from_lines, segment_texts_from_turns
from colloquy.operators.segments import flatten_text
from colloquy.sources.decoders import decode_lines, decode_turns, decode_utterances

TEXTS = {
    "empty": "", "blank": "\n\n \n", "one": "student: Hi.", "blank first": "\n\nstudent: Hi.\n\npatient: Yes.\n",
    "unlabelled": "just words\nmore words\n\n\nand more", "long": "\n".join(f"student: line {k}\n" for k in range(9)),
    "gap": "student: a\n" + "\n" * 12 + "patient: b", "same": "Patient: a\n\npatient: b\nand c\n\nstudent: d\n\n",
}


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("n", [1, 3, 9])
def test_lines_in_one_pass(spark, n):
    files = spark.createDataFrame(list(TEXTS.items()), "id string, value string")
    for mode in ("canonical", "literal"):
        for by in ("line", "turn"):
            grid = segment_texts_from_lines(decode_lines(files, ["id"]), n, ["id"], files.select("id"), mode, segment_by=by)
            once = segment_texts_from_lines(decode_lines(files, ["id"], keep_empty=True), n, ["id"], None, mode, segment_by=by)
            assert rows(once) == rows(grid) and len(rows(once)) == n * len(TEXTS)


@pytest.mark.parametrize("n", [1, 4])
def test_json_in_one_pass(spark, n):
    turns = {str(m): json.dumps([{"chunk": 0, "speaker": "ab"[k % 2], "text": f" t{k}"} for k in range(m)]) for m in (0, 1, 3, 4, 11)}
    utts = {k: json.dumps([{"text": "\n" if i == 1 else t["text"]} for i, t in enumerate(json.loads(v))]) for k, v in turns.items()}
    files = spark.createDataFrame(list(turns.items()), "id string, value string")
    raw = spark.createDataFrame(list(utts.items()), "id string, value string")
    for mode in ("canonical", "literal"):
        assert rows(segment_texts_from_turns(decode_turns(files, ["id"], keep_empty=True), n, ["id"], None, mode)) == \
            rows(segment_texts_from_turns(decode_turns(files, ["id"]), n, ["id"], files.select("id"), mode))
    once = flatten_text(decode_utterances(raw, ["id"], keep_empty=True), ["id"], n)
    assert rows(once) == rows(flatten_text(decode_utterances(raw, ["id"]), ["id"], n, transcripts=raw.select("id")))
    assert len(rows(once)) == 5 * n


def test_no_read_of_the_files_for_empty_segments(spark, tmp_path):
    from colloquy.plans.jobs import score_runs
    for folder, name, value in (("runs/a", "1.txt", TEXTS["same"]), ("gold", "1.txt", TEXTS["gap"]), ("raw", "1.json", '[{"text": " a"}]')):
        (tmp_path / folder).mkdir(parents=True)
        (tmp_path / folder / name).write_text(value)
    df = score_runs(spark, str(tmp_path / "runs"), str(tmp_path / "raw"), str(tmp_path / "gold"), segments=3)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the static plan shows what is reused
    try:
        plan = df.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    # one scan per side, and one more as the scores of the distinct pairs are joined back
    assert plan.count("BatchScan whole_files") == 2 * 3
    assert [r.segment for r in df.orderBy("segment").collect()] == [0, 1, 2]
