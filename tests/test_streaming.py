"""The streaming driver scores the same as the batch plan."""

from colloquy.operators.consolidate import segment_texts_from_lines
from colloquy.operators.scoring import score_segments
from colloquy.operators.segments import flatten_text
from colloquy.sources.decoders import decode_lines
from colloquy.streaming import score_stream

GOLD = {"01": "student: Hello there.\n\npatient: Hi.\n\nstudent: How long?\n\npatient: Two days.",
        "02": "student: Good morning.\n\npatient: Morning."}
PRED = {("runA", "01"): "Student: Hello there.\n\nPatient: Hi.\n\nPatient: How long?\n\nPatient: Two days.\n\n",
        ("runA", "02"): "Student: Good morning.\n\nPatient: Morning.\n\n",
        ("runB", "01"): "Student: Hello there. Hi.\n\nPatient: How long?\n\nPatient: Two days.\n\n"}


def test_stream_matches_batch(spark, tmp_path):
    root = tmp_path / "labelled"
    for (run, id_), text in PRED.items():
        d = root / run
        d.mkdir(parents=True, exist_ok=True)
        (d / f"{id_}.txt").write_text(text)
    gold_files = spark.createDataFrame(list(GOLD.items()), "id string, value string")
    gold = segment_texts_from_lines(decode_lines(gold_files, ["id"]), 2, ["id"], gold_files, with_bare=False)
    utts = spark.createDataFrame(
        [(i, p, " " + t.split(": ", 1)[1]) for i, v in GOLD.items() for p, t in enumerate(v.split("\n\n"))],
        "id string, pos int, text string")
    raw = flatten_text(utts, ["id"], 2)
    out = tmp_path / "scores"
    q = score_stream(spark, str(root), gold, raw, str(out), n_segments=2,
                     checkpoint=str(tmp_path / "ckpt"))
    q.awaitTermination(300)
    got = spark.read.parquet(str(out)).drop("batch_id")
    pred_files = spark.createDataFrame([(r, i, v) for (r, i), v in PRED.items()],
                                       "run_name string, id string, value string")
    pred = segment_texts_from_lines(decode_lines(pred_files, ["run_name", "id"]), 2, ["run_name", "id"],
                                    pred_files.select("run_name", "id"))
    want = score_segments(pred, gold, raw)
    cols = sorted(want.columns)
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()))
    assert got.count() == 6


def test_stream_restart_scores_only_new_files(spark, tmp_path):
    root = tmp_path / "labelled"
    (root / "runA").mkdir(parents=True)
    (root / "runA" / "01.txt").write_text(PRED[("runA", "01")])
    gold_files = spark.createDataFrame(list(GOLD.items()), "id string, value string")
    gold = segment_texts_from_lines(decode_lines(gold_files, ["id"]), 1, ["id"], gold_files, with_bare=False)
    out, ckpt = tmp_path / "scores", tmp_path / "ckpt"
    score_stream(spark, str(root), gold, None, str(out), n_segments=1, metrics=("levenshtein",),
                 families=("accuracy",), checkpoint=str(ckpt)).awaitTermination(300)
    assert spark.read.parquet(str(out)).count() == 1
    (root / "runA" / "02.txt").write_text(PRED[("runA", "02")])
    score_stream(spark, str(root), gold, None, str(out), n_segments=1, metrics=("levenshtein",),
                 families=("accuracy",), checkpoint=str(ckpt)).awaitTermination(300)
    got = sorted((r.id, r.lev_acc) for r in spark.read.parquet(str(out)).collect())
    assert [g[0] for g in got] == ["01", "02"]
    assert got[1][1] == 1.0
