"""Shared inputs of the named plans: the files a labelling/scoring job reads,
derived from the driver's tables by Spark (so the work grows with them).

* prediction txt files: every run's labelled turns, cut into the run's chunk
  count, rendered as model answers, written as a txt per transcript;
* gold txt files: the gold labelling rendered as a gold-standard txt;
* raw utterances: the conversation turns.

Everything is lazy; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.operators.consolidate import segment_texts_from_lines, segment_texts_from_turns
from colloquy.operators.requests import parse_answers
from colloquy.operators.scoring import score_segments
from colloquy.operators.segments import flatten_text
from colloquy.sources.decoders import decode_lines, decode_turns
from colloquy.sources.sinks import model_answers, render_gold_txt, render_json, render_txt
from colloquy.sources.tables import gold_turns, predicted_turns, raw_utterances

RUN_KEYS = ["run_name", "id"]
N_SEGMENTS = 3


def pred_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(run_name, id, chunk, answer)``: one simulated model answer per chunk."""
    return model_answers(predicted_turns(spark, sf_dir), "chunk_num", RUN_KEYS)


def pred_txt_files(spark: SparkSession, sf_dir: str, chunked: bool = False) -> DataFrame:
    """``(run_name, id, value)``: the labelled txt each run wrote per transcript."""
    return render_txt(pred_answers(spark, sf_dir), RUN_KEYS, chunked=chunked)


def pred_json_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(run_name, id, value)``: the labelled JSON each run wrote per transcript."""
    answers = pred_answers(spark, sf_dir)
    turns = parse_answers(answers).withColumnRenamed("block", "pos")
    return render_json(turns, RUN_KEYS, order=("chunk", "pos"), transcripts=answers)


def gold_txt_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, value)``: gold standard txt per transcript."""
    return render_gold_txt(gold_turns(spark, sf_dir), ["id"])


def pred_segments(spark: SparkSession, sf_dir: str, n_segments: int = N_SEGMENTS,
                  label_mode: str = "canonical", source: str = "txt",
                  with_labelled: bool = True, with_bare: bool = True,
                  segment_by: str = "line", strip_mode: str = "first_token") -> DataFrame:
    """``(run_name, id, segment, labelled, bare)`` from the txt or JSON files."""
    if source == "txt":
        lines = decode_lines(pred_txt_files(spark, sf_dir), RUN_KEYS, keep_empty=True)
        return segment_texts_from_lines(lines, n_segments, RUN_KEYS, None,
                                        label_mode, with_labelled, with_bare, segment_by, strip_mode)
    turns = decode_turns(pred_json_files(spark, sf_dir), RUN_KEYS, keep_empty=True)
    return segment_texts_from_turns(turns, n_segments, RUN_KEYS, None, label_mode, with_labelled, with_bare)


def gold_segments(spark: SparkSession, sf_dir: str, n_segments: int = N_SEGMENTS,
                  label_mode: str = "canonical", segment_by: str = "line") -> DataFrame:
    """``(id, segment, labelled)`` of the gold standard."""
    lines = decode_lines(gold_txt_files(spark, sf_dir), ["id"], keep_empty=True)
    return segment_texts_from_lines(lines, n_segments, ["id"], None, label_mode,
                                    with_labelled=True, with_bare=False, segment_by=segment_by)


def raw_segments(spark: SparkSession, sf_dir: str, n_segments: int = N_SEGMENTS,
                 normalise: str = "always") -> DataFrame:
    """``(id, segment, text, n_utterances)`` of the raw transcripts."""
    return flatten_text(raw_utterances(spark, sf_dir), ["id"], n_segments, normalise)


def scores(spark: SparkSession, sf_dir: str, n_segments: int = N_SEGMENTS,
           metrics=("levenshtein", "diff"), families=("preservation", "accuracy"),
           label_mode: str = "canonical", source: str = "txt",
           raw_normalise: str = "always", segment_by: str = "line",
           strip_mode: str = "first_token") -> DataFrame:
    """The score table for every simulated run: one row per (run, id, segment)."""
    pred = pred_segments(spark, sf_dir, n_segments, label_mode, source, segment_by=segment_by,
                         strip_mode=strip_mode)
    gold = gold_segments(spark, sf_dir, n_segments, label_mode, segment_by) \
        if "accuracy" in families else None
    raw = raw_segments(spark, sf_dir, n_segments, raw_normalise) if "preservation" in families else None
    return score_segments(pred, gold, raw, metrics=metrics, families=families)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every DOUBLE column (the oracle compares values by hash)."""
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c)
                       for c, t in df.dtypes])
