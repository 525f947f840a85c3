"""Small exact cases of the text shaping functions."""

from pyspark.sql import functions as F

from colloquy.functions.text import (canonical_speaker, collapse_ws, label_of, split_lines,
                                     strip_first_token, text_after_label)
from colloquy.operators.requests import parse_answers
from colloquy.operators.segments import segment_of
from colloquy.operators.sentences import sentences


def one(spark, col, value):
    return spark.createDataFrame([(value,)], "v string").select(col(F.col("v")).alias("o")).first()["o"]


def test_collapse_whitespace_like_python_split(spark):
    s = "a b\t c\x1cd  "
    assert one(spark, collapse_ws, s) == " ".join(s.split()) == "a b c d"


def test_strip_first_token(spark):
    assert one(spark, strip_first_token, "Student: hi: you") == " hi: you"
    assert one(spark, strip_first_token, "nolabel") == ""
    assert one(spark, strip_first_token, " lead sp") == " lead sp"


def test_split_at_first_colon(spark):
    assert one(spark, label_of, "Student: hi: you") == "Student"
    assert one(spark, text_after_label, "Student: hi: you") == " hi: you"
    assert one(spark, label_of, "no colon") is None
    assert one(spark, text_after_label, "no colon") == "no colon"


def test_canonical_speaker(spark):
    cases = {"student": "Student", "**Patient**": "Patient", "Medical Student": "Student",
             "instructions": "Instructions", "Student and patient": "Student"}
    for raw, want in cases.items():
        assert one(spark, canonical_speaker, raw) == want


def test_split_lines_like_readlines(spark):
    cases = ["", "a", "a\n", "a\n\nb", "a\r\nb\rc\n", "\n"]
    df = spark.createDataFrame([(c,) for c in cases], "v string")
    got = [r["l"] for r in df.select(split_lines("v").alias("l")).collect()]
    want = [[x.rstrip("\r\n") for x in __import__("io").StringIO(c, newline=None).readlines()]
            for c in cases]
    assert got == want


def test_segment_of(spark):
    df = spark.range(7).select(F.col("id").cast("int").alias("pos"))
    for n, want in [(3, [0, 0, 1, 1, 2, 2, 2]), (6, [0, 1, 2, 3, 4, 5, 5]), (9, [8] * 7)]:
        rows = df.select("pos", segment_of("pos", F.lit(7), n).alias("s")).orderBy("pos").collect()
        got = [r.s for r in rows]
        assert got == want


def test_parse_answers_drops_blocks_without_colon(spark):
    df = spark.createDataFrame([("r", "1", 0, "A: b\n\nB: c: d\n\n\nC")],
                               "run_name string, id string, chunk int, answer string")
    got = [(r.speaker, r.text) for r in parse_answers(df).orderBy("block").collect()]
    assert got == [("A", " b"), ("B", " c: d")]


def test_sentences(spark):
    df = spark.createDataFrame([("1", "Hello, Mr. Jo. Hi! A?  b.")], "id string, text string")
    got = [r.sentence for r in sentences(df).orderBy("pos").collect()]
    assert got == ["Hello, Mr. Jo.", "Hi!", "A?", "b."]
