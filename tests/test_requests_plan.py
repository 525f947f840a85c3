"""What the request queries shuffle."""

import pytest
from pyspark.sql import functions as F

from colloquy.operators.segments import flatten_text
from colloquy.plans import catalogue as C


@pytest.fixture
def tables(spark, tmp_path):
    rows = [(c, t, "user", f"turn {t} of {c}") for c in range(1, 9) for t in range(c)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string") \
        .write.parquet(str(tmp_path / "conversations.parquet"))
    return str(tmp_path)


def test_texts_are_shuffled_per_chunk_count_not_per_run(spark, tables):
    plan = C._chunks(spark, tables)._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("RepartitionByExpression", 1)
    assert "r5" in above and "r5" not in below


def test_chunks_of_every_run(spark, tables):
    got = sorted(map(tuple, C._chunks(spark, tables).collect()))
    utts = C.raw_utterances(spark, tables)
    want = []
    for run in C.REQUEST_RUNS:
        parts = flatten_text(utts, ["id"], run.chunk_num, "never")
        want += map(tuple, parts.select(F.lit(run.run_name), "id", "segment", "text").collect())
    assert got == sorted(want)
