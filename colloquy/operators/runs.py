"""Comparing experiment runs: means per run / segment, progression over a
transcript, and named selections of runs.

All of it is aggregation over the ``scores`` table (one row per run, id,
segment); a selection of runs is a small ordered dimension joined by run name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from colloquy.operators.scoring import SCORE_COLUMNS


def _score_cols(df: DataFrame, cols: Sequence[str] | None) -> list[str]:
    return list(cols) if cols else [c for c in SCORE_COLUMNS if c in df.columns]


def run_means(scores: DataFrame, cols: Sequence[str] | None = None,
              keys: Sequence[str] = ("run_name",)) -> DataFrame:
    """Mean of every score per run (NULL/NaN scores skipped) and the row count."""
    cols = _score_cols(scores, cols)
    return scores.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.avg(F.when(~F.isnan(c), F.col(c))).alias(c) for c in cols])


def segment_means(scores: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Mean of every score per (run, segment); also each run's segment count."""
    cols = _score_cols(scores, cols)
    means = run_means(scores, cols, keys=("run_name", "segment"))
    n_seg = (F.max("segment").over(Window.partitionBy("run_name")) + 1).alias("n_segments")
    return means.select("run_name", "segment", n_seg, "n_rows", *cols)


def progression(scores: DataFrame, value_col: str = "composite_normed") -> DataFrame:
    """Per-transcript curve of ``value_col`` over segments, next to the run's
    mean curve at the same segment, with a flag for transcripts whose curve has
    every segment of the run (shorter curves are reported, not drawn).

    The run-level figures are partial aggregates (one row per run and segment)
    joined back, not windows over a whole run: a run holding most rows never
    lands in one task.  The per-transcript count is a window over (run, id),
    bounded by the segment count.  ``scores`` is read twice: materialize it
    first when it is expensive to recompute."""
    seg_mean = scores.groupBy("run_name", "segment").agg(F.avg(value_col).alias("mean_value"))
    run_segs = seg_mean.groupBy("run_name").agg((F.max("segment") + 1).alias("_n_seg"))
    id_w = Window.partitionBy("run_name", "id")
    curve = scores.select("run_name", "id", "segment", F.col(value_col).alias("value"),
                          F.count(F.lit(1)).over(id_w).alias("_n"))
    return (curve.join(seg_mean, ["run_name", "segment"]).join(run_segs, "run_name")
            .select("run_name", "id", "segment", "value", "mean_value",
                    (F.col("_n") == F.col("_n_seg")).alias("complete")))


def one_segment_means(scores: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Mean per run over segment 0 only, whatever other segments there are."""
    return run_means(scores.where(F.col("segment") == 0), cols)


def curves(scores: DataFrame, value_col: str = "composite_normed") -> DataFrame:
    """``(run_name, id, curve, complete)``: each transcript's values in numeric
    order of their segments, and whether it has every segment of its run."""
    n_seg = scores.groupBy("run_name").agg((F.max("segment") + 1).alias("_n"))
    pairs = F.array_sort(F.collect_list(F.struct("segment", F.col(value_col).alias("value"))))
    own = scores.groupBy("run_name", "id").agg(pairs.alias("_p"))
    return own.join(n_seg, "run_name").select(
        "run_name", "id", F.transform("_p", lambda x: x["value"]).alias("curve"),
        (F.size("_p") == F.col("_n")).alias("complete"))


def compare_named(means: DataFrame, name: str) -> DataFrame:
    """A comparison of the catalogue by its name: the runs it lists, or the
    group means of a group comparison."""
    spark = means.sparkSession
    if name in GROUP_CATALOGUE:
        return compare_groups(means, selection_frame(spark, GROUP_CATALOGUE[name]))
    if name not in CATALOGUE:
        raise ValueError(f"no comparison named {name!r}")
    return compare_runs(means, selection_frame(spark, CATALOGUE[name]))


def compare_catalogue(means: DataFrame) -> DataFrame:
    """Every comparison of the catalogue in one pass over ``means``: ``(selection,
    ord, label, n_runs, n_rows, scores)``, a row per listed run, or per label of
    a group comparison (mean of its runs' means, at its first place)."""
    spark = means.sparkSession
    cols = _score_cols(means, None)
    listed = [(name, group, i, r, lab) for group, named in ((False, CATALOGUE), (True, GROUP_CATALOGUE))
              for name, selection in named.items() for i, (r, lab) in enumerate(selection)]
    dim = spark.createDataFrame(listed, "selection string, grouped boolean, ord int, run_name string, label string")
    # a listed run is a group of its own
    place = F.when(~F.col("grouped"), F.col("ord"))
    return (dim.join(means, "run_name").groupBy("selection", "label", place.alias("_place"))
            .agg(F.min("ord").alias("ord"), F.count(F.lit(1)).alias("n_runs"), F.sum("n_rows").alias("n_rows"),
                 *[F.avg(c).alias(c) for c in cols]).drop("_place"))


def selection_frame(spark: SparkSession, selection: Sequence[tuple[str, str]]) -> DataFrame:
    """``[(run_name, label), ...]`` -> ``(ord, run_name, label)``; order and
    repeats are kept."""
    return spark.createDataFrame([(i, r, lab) for i, (r, lab) in enumerate(selection)],
                                 "ord int, run_name string, label string")


def compare_runs(means: DataFrame, selection: DataFrame) -> DataFrame:
    """Rows of ``means`` for the selected runs, in selection order, labelled.
    A run listed twice appears twice; ``missing_runs`` reports absent ones."""
    return (selection.join(means, "run_name", "inner")
            .orderBy("ord"))


def missing_runs(means: DataFrame, selection: DataFrame) -> DataFrame:
    return selection.join(means.select("run_name"), "run_name", "left_anti")


def compare_groups(means: DataFrame, groups: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Mean of run means per group label: ``groups (ord, run_name, label)``."""
    cols = _score_cols(means, cols)
    joined = groups.join(means, "run_name", "inner")
    return (joined.groupBy("label").agg(F.min("ord").alias("ord"), F.count(F.lit(1)).alias("n_runs"),
                                        *[F.avg(c).alias(c) for c in cols])
            .orderBy("ord"))


def compare_by(means: DataFrame, runs: DataFrame, dims: Sequence[str],
               cols: Sequence[str] | None = None) -> DataFrame:
    """The same comparison by columns of the ``runs`` dimension (model, chunk
    count, prompt, summary flag) instead of spelled-out lists."""
    cols = _score_cols(means, cols)
    joined = means.join(runs.select("run_name", *dims), "run_name")
    return joined.groupBy(*dims).agg(F.count(F.lit(1)).alias("n_runs"),
                                     *[F.avg(c).alias(c) for c in cols])


# --- fixed values ---------------------------------------------------------
# Named comparisons of the original experiments: (run_name, label) in display
# order.  Run names are the score files' names.
CATALOGUE: dict[str, list[tuple[str, str]]] = {
    "one_chunk_by_model": [
        ("gpt4-1chunk", "gpt4 2-15-24"), ("gpt4-diar", "gpt4 5-1-24"), ("gpt4o-diar", "gpt4o"),
        ("claude-sonnet-3.5-diar", "claude sonnet 3.5"), ("llama-8b-diar", "llama 8b"),
        ("llama-70b-diar", "llama 70b")],
    "gpt4_feb_vs_may": [
        ("gpt4-1chunk", "gpt4 2-15-24 1 chunk"), ("gpt4_3chunk_pass2", "gpt4 2-15-24 3 chunk"),
        ("GPT4 6-chunk", "gpt4 2-15-24 6 chunk"), ("GPT4 9-chunk", "gpt4 2-15-24 9 chunk"),
        ("gpt4-diar", "gpt4 5-1-24 1 chunk"), ("gpt4-all", "gpt4 5-1-24 1 chunk")],
    "three_chunks_by_model": [
        ("gpt4_3chunk_pass2", "gpt4 2-15-24"), ("gpt4o-3ch", "gpt4o"),
        ("claude-sonnet-3.5-3ch", "claude sonnet 3.5"), ("llama-70b-3ch", "llama 70b")],
    "six_chunks_by_model": [
        ("GPT4 6-chunk", "gpt4 2-15-24"), ("gpt4o-6ch", "gpt4o"),
        ("claude-sonnet-3.5-6ch", "claude sonnet 3.5"), ("llama-70b-6ch", "llama 70b")],
    "nine_chunks_by_model": [
        ("GPT4 9-chunk", "gpt4 2-15-24"), ("gpt4o-9ch", "gpt4o"),
        ("claude-sonnet-3.5-9ch", "claude sonnet 3.5"), ("llama-70b-9ch", "llama 70b")],
    "gpt4_chunk_counts": [
        ("gpt4-1chunk", "1"), ("gpt4_3chunk_pass2", "3"), ("GPT4 6-chunk", "6"), ("GPT4 9-chunk", "9")],
    "gpt4o_chunk_counts": [
        ("gpt4o-diar", "1"), ("gpt4o-3ch", "3"), ("gpt4o-6ch", "6"), ("gpt4o-9ch", "9")],
    "claude_chunk_counts": [
        ("claude-sonnet-3.5-diar", "1"), ("claude-sonnet-3.5-3ch", "3"),
        ("claude-sonnet-3.5-6ch", "6"), ("claude-sonnet-3.5-9ch", "9")],
    "llama70_chunk_counts": [
        ("llama-70b-diar", "1"), ("llama-70b-3ch", "3"), ("llama-70b-6ch", "6"), ("llama-70b-9ch", "9")],
    "summary_vs_none_by_model": [
        ("gpt4-all", "gpt4 sum"), ("gpt4-diar", "no sum"), ("gpt4o-all", "gpt4o sum"),
        ("gpt4o-diar", "no sum"), ("claude-sonnet-3.5-all", "claude sonnet sum"),
        ("claude-sonnet-3.5-diar", "no sum"), ("llama-70b-all", "llama 70b sum"),
        ("llama-70b-diar", "no sum")],
    "gpt4_prompt_styles": [
        ("gpt4-feb-0sh", "0 shot"), ("gpt4_3chunk_pass2", "hypothetical shot"),
        ("gpt4-feb-fsh", "few shot"), ("gpt4-feb-wsh", "whole shot")],
    "gpt4o_prompt_styles": [
        ("gpt4o-0sh", "0 shot"), ("gpt4o-diar", "hypothetical shot"), ("gpt4o-fsh", "few shot"),
        ("gpt4o-wsh", "whole shot")],
    "claude_prompt_styles": [
        ("claude-sonnet-3.5-0sh", "0 shot"), ("claude-sonnet-3.5-diar", "hypothetical shot"),
        ("claude-sonnet-3.5-fsh", "few shot"), ("claude-sonnet-3.5-wsh", "whole shot")],
    "llama70_prompt_styles": [
        ("llama-70b-0sh", "0 shot"), ("llama-70b-diar", "hypothetical shot"),
        ("llama-70b-fsh", "few shot"), ("llama-70b-wsh", "whole shot")],
    "few_shot_by_model": [
        ("gpt4o-fsh", "gpt4o"), ("claude-sonnet-3.5-fsh", "claude sonnet 3.5"),
        ("llama-70b-fsh", "llama 70b")],
    "gpt4o_few_shot_summary_vs_none": [("gpt4o-all-fsh", "summary"), ("gpt4o-fsh", "no summary")],
    "zero_shot_by_model": [
        ("gpt4o-0sh", "gpt4o"), ("claude-sonnet-3.5-0sh", "claude sonnet 3.5"),
        ("llama-70b-0sh", "llama 70b")],
    "hypothetical_shot_by_model": [
        ("gpt4o-3ch", "gpt4o"), ("claude-sonnet-3.5-3ch", "claude sonnet 3.5"),
        ("llama-70b-3ch", "llama 70b")],
    "whole_shot_by_model": [
        ("gpt4o-wsh", "gpt4o"), ("claude-sonnet-3.5-wsh", "claude sonnet 3.5"),
        ("llama-70b-wsh", "llama 70b")],
    "best_of_each": [
        ("gpt4o-fsh", "gpt4o"), ("claude-sonnet-3.5-diar", "claude sonnet 3.5"),
        ("llama-70b-fsh", "llama 70b")],
}
# Group comparisons: (run_name, group label) -- mean of the run means per label.
GROUP_CATALOGUE: dict[str, list[tuple[str, str]]] = {
    "summary_vs_none_overall": [
        ("gpt4-all", "summary"), ("gpt4o-all", "summary"), ("claude-sonnet-3.5-all", "summary"),
        ("llama-70b-all", "summary"), ("gpt4-diar", "no summary"), ("gpt4o-diar", "no summary"),
        ("claude-sonnet-3.5-diar", "no summary"), ("llama-70b-diar", "no summary")],
}
# --------------------------------------------------------------------------
