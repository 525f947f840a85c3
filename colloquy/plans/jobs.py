"""File-based jobs: the labelling and scoring workflows over folders of files.

These take the same inputs as the original tools (an id list, raw transcript
JSON per id, labelled txt / JSON per id, gold standards per id, score files
per run) and return lazy DataFrames.  Many runs are scored in one job: a run
is a folder ``<root>/<run_name>/`` of labelled files, and ``run_name`` is a
column.

    scores = score_runs(spark, "labelled/", raw_dir="input/", gold_dir="gold/",
                        ids_path="ids.jsonl", segments=3)
    write_scores(scores, "scores/")
    means = run_means(read_scores(spark, "scores/"))
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.operators.consolidate import segment_texts_from_lines, segment_texts_from_turns
from colloquy.operators.requests import LabellingRun, build_requests, labelling_runs
from colloquy.operators.scoring import METRICS, score_segments
from colloquy.operators.segments import flatten_text
from colloquy.sources.decoders import (TURN_SCHEMA, UTTERANCE_SCHEMA, decode_lines, decode_scores, decode_turns,
                                       decode_utterances, is_json, malformed_json, read_exported, read_ids,
                                       read_paths, read_whole, without_suffix)
from colloquy.operators.sentences import sentences
from colloquy.sources.files import write_shared
from colloquy.sources.sinks import output_name, render_chunked_json, render_sentences_json, render_txt

RUN_KEYS = ["run_name", "id"]


def read_run_files(spark: SparkSession, root: str, suffix: str) -> DataFrame:
    """``(run_name, id, value)`` for every ``<root>/<run_name>/<id><suffix>``,
    files of no bytes included, or for the tree of ``sinks.export_files``
    (``run_name=<run>/id=<id>/``) under ``root``."""
    root = root.rstrip("/")
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/run_name=*")
    if hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop):
        return read_exported(spark, root)
    parts = F.split(F.col("path"), "/")
    return read_paths(spark, f"{root}/*/*{suffix}").select(
        F.element_at(parts, -2).alias("run_name"), without_suffix(F.element_at(parts, -1), suffix).alias("id"), "value")


def _only_listed(files: DataFrame, ids: DataFrame | None) -> DataFrame:
    return files if ids is None else files.join(ids.select("id").distinct(), "id", "left_semi")


def missing_files(ids: DataFrame, files: DataFrame, keys: Sequence[str] = ("id",)) -> DataFrame:
    """Listed ids that have no file (the original tools stop at the first)."""
    return ids.select("id").distinct().join(files.select(*keys).distinct(), "id", "left_anti")


def raw_segments_from_files(spark: SparkSession, raw_dir: str, segments: int,
                            ids: DataFrame | None = None, normalise: str = "always") -> DataFrame:
    """``(id, segment, text, n_utterances)`` from ``<raw_dir>/<id>.json``."""
    files = _only_listed(read_whole(spark, raw_dir, "id", ".json"), ids)
    files = files.where(is_json("value", UTTERANCE_SCHEMA))
    return flatten_text(decode_utterances(files, ["id"], keep_empty=True), ["id"], segments, normalise)


def gold_segments_from_files(spark: SparkSession, gold_dir: str, segments: int,
                             ids: DataFrame | None = None, gold_json: bool = False,
                             label_mode: str = "canonical", segment_by: str = "line") -> DataFrame:
    """``(id, segment, labelled)`` from ``<gold_dir>/<id>.txt`` (or ``.json``)."""
    suffix = ".json" if gold_json else ".txt"
    files = _only_listed(read_whole(spark, gold_dir, "id", suffix), ids)
    if gold_json:
        files = files.where(is_json("value", TURN_SCHEMA))
        return segment_texts_from_turns(decode_turns(files, ["id"], keep_empty=True), segments, ["id"],
                                        label_mode=label_mode, with_bare=False)
    return segment_texts_from_lines(decode_lines(files, ["id"], keep_empty=True), segments, ["id"],
                                    label_mode=label_mode, with_bare=False, segment_by=segment_by)


def pred_segments_from_files(spark: SparkSession, root: str, segments: int,
                             ids: DataFrame | None = None, input_json: bool = False,
                             label_mode: str = "canonical", segment_by: str = "line",
                             strip_mode: str = "first_token") -> DataFrame:
    """``(run_name, id, segment, labelled, bare)`` for every run folder under ``root``."""
    files = _only_listed(read_run_files(spark, root, ".json" if input_json else ".txt"), ids)
    if input_json:
        files = files.where(is_json("value", TURN_SCHEMA))
        return segment_texts_from_turns(decode_turns(files, RUN_KEYS, keep_empty=True), segments, RUN_KEYS,
                                        label_mode=label_mode)
    return segment_texts_from_lines(decode_lines(files, RUN_KEYS, keep_empty=True), segments, RUN_KEYS,
                                    label_mode=label_mode, segment_by=segment_by, strip_mode=strip_mode)


def problems(spark: SparkSession, root: str, raw_dir: str | None, gold_dir: str | None,
             ids_path: str | None = None, input_json: bool = False, gold_json: bool = False) -> DataFrame:
    """``(run_name, id, reason)`` of every transcript that ``score_runs`` cannot
    score as asked: a listed id without a labelled file of a run, a labelled
    transcript without a raw or gold file, JSON that does not parse.  The
    original tools stop at the first of these."""
    ids = read_ids(spark, ids_path) if ids_path else None
    pred = _only_listed(read_run_files(spark, root, ".json" if input_json else ".txt"), ids)
    found = []

    def report(rows: DataFrame, reason: str) -> None:
        run = F.col("run_name") if "run_name" in rows.columns else F.lit(None).cast("string")
        found.append(rows.select(run.alias("run_name"), "id", F.lit(reason).alias("reason")))

    if ids is not None:
        names = [r.run_name for r in pred.select("run_name").distinct().collect()]  # as many as run folders
        listed = ids.select("id").distinct().select("id", F.explode(
            F.array(*map(F.lit, names)).cast("array<string>")).alias("run_name"))
        report(listed.join(pred.select(*RUN_KEYS), RUN_KEYS, "left_anti"), "no labelled file")
    if input_json:
        report(malformed_json(pred, TURN_SCHEMA), "malformed labelled file")
    wanted = pred.select("id").distinct()
    for folder, suffix, schema, side in ((raw_dir, ".json", UTTERANCE_SCHEMA, "raw"),
                                         (gold_dir, ".json" if gold_json else ".txt",
                                          TURN_SCHEMA if gold_json else None, "gold")):
        if folder:
            files = _only_listed(read_whole(spark, folder, "id", suffix), ids)
            report(wanted.join(files.select("id"), "id", "left_anti"), f"no {side} file")
            if schema is not None:
                report(malformed_json(files, schema), f"malformed {side} file")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def score_runs(spark: SparkSession, root: str, raw_dir: str | None, gold_dir: str | None,
               ids_path: str | None = None, segments: int = 1,
               metrics: Sequence[str] = METRICS, families=("preservation", "accuracy"),
               input_json: bool = False, gold_json: bool = False,
               label_mode: str = "canonical", raw_norm: str = "always",
               autojunk: bool = True, segment_by: str = "line", strip_mode: str = "first_token",
               strict: bool = False) -> DataFrame:
    """Score every run folder under ``root``: one row per (run, id, segment)
    with the enabled score columns.  ``ids_path`` (JSONL) restricts the ids.

    A labelled file of no bytes is scored as the empty text.  What cannot be
    scored has no row, or NULL where only one side is missing, and is listed by
    ``problems``; ``strict`` raises if there is any, as the original tools do."""
    if strict:
        some = problems(spark, root, raw_dir if "preservation" in families else None,
                        gold_dir if "accuracy" in families else None, ids_path, input_json, gold_json).take(20)
        if some:
            raise ValueError("cannot score: " + "; ".join(f"{r.run_name or '-'}/{r.id}: {r.reason}" for r in some))
    ids = read_ids(spark, ids_path) if ids_path else None
    pred = pred_segments_from_files(spark, root, segments, ids, input_json, label_mode, segment_by, strip_mode)
    gold = gold_segments_from_files(spark, gold_dir, segments, ids, gold_json, label_mode, segment_by) \
        if "accuracy" in families else None
    raw = raw_segments_from_files(spark, raw_dir, segments, ids, raw_norm) \
        if "preservation" in families else None
    return score_segments(pred, gold, raw, metrics=metrics, families=families, autojunk=autojunk)


def utterances_from_texts(spark: SparkSession, input_dir: str, ids_path: str | None = None) -> DataFrame:
    """Plain transcripts ``<input_dir>/<id>.txt`` -> raw transcript JSON per id
    (one utterance per sentence), ready for ``raw_segments_from_files``."""
    ids = read_ids(spark, ids_path) if ids_path else None
    files = _only_listed(read_whole(spark, input_dir, "id", ".txt"), ids)
    return render_sentences_json(sentences(files, ["id"], "value"), transcripts=files.select("id"))


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    """A score table written by ``sinks.write_scores`` (parquet by run)."""
    return spark.read.parquet(path)


def read_score_files(spark: SparkSession, path: str, sharded: bool = False) -> DataFrame:
    """Score files -> wide score table ``(run_name, id, segment, lev_pres, ...,
    composite, composite_normed)``.  Flat layout: ``<path>/<run_name>.json``;
    ``sharded=True``: the layout of ``sinks.write_score_files``."""
    files = read_exported(spark, path, ("run_name", "shard")) if sharded \
        else read_whole(spark, path, "run_name", ".json")
    tall = decode_scores(files)
    names = {("preservation", "levenshtein"): "lev_pres", ("preservation", "diff"): "diff_pres",
             ("accuracy", "levenshtein"): "lev_acc", ("accuracy", "diff"): "diff_acc",
             ("accuracy", "levenshtein_baseline_normed"): "lev_acc_normed",
             ("accuracy", "diff_baseline_normed"): "diff_acc_normed",
             ("nolabel_baseline", "levenshtein"): "lev_baseline",
             ("nolabel_baseline", "diff"): "diff_baseline"}
    aggs = [F.max(F.when((F.col("family") == f) & (F.col("metric") == m), F.col("score"))).alias(c)
            for (f, m), c in names.items()]
    wide = tall.groupBy("run_name", "id", "segment").agg(*aggs)
    return (wide.withColumn("composite", (F.col("lev_acc") + F.col("diff_acc")) / 2)
            .withColumn("composite_normed", (F.col("lev_acc_normed") + F.col("diff_acc_normed")) / 2))


def labelling_requests(spark: SparkSession, raw_dir: str, runs: Sequence[LabellingRun], prompts: DataFrame,
                       ids_path: str | None = None, stage: str = "diarize",
                       summaries: DataFrame | None = None, summary_chunking: bool = True) -> DataFrame:
    """Request rows for every configured run over the raw transcripts in
    ``raw_dir``; each run cuts the transcripts into its own chunk count, a
    transcript without utterances into empty ones.  The files are decoded once;
    runs are attached by a generator over the (small) run list, not a join."""
    ids = read_ids(spark, ids_path) if ids_path else None
    files = _only_listed(read_whole(spark, raw_dir, "id", ".json"), ids).where(is_json("value", UTTERANCE_SCHEMA))
    listed = F.explode(F.array(*[F.struct(F.lit(r.run_name).alias("run_name"), F.lit(r.chunk_num).alias("chunk_num"))
                                 for r in runs])).alias("_r")
    keys = ["run_name", "chunk_num", "id"]
    utts = decode_utterances(files, ["id"], keep_empty=True).select("*", listed).select("*", "_r.*").drop("_r")
    chunks = flatten_text(utts, keys, "chunk_num", "never").select("run_name", "id", F.col("segment").alias("chunk"), "text")
    return build_requests(chunks, labelling_runs(spark, runs), prompts, stage, summaries, summary_chunking)


def raw_transcript_files(utts: DataFrame, chunk_num: int, run_name: str | None = None,
                         chunked: bool = False) -> DataFrame:
    """Raw-transcript mode, which asks no model: ``utts (id, pos, start_s, end_s,
    text)`` -> (name, txt, json), the transcript's chunks as a labelling run
    writes them.  ``name`` is the file's, ``<run_name>_<id>`` or the id alone;
    an utterance that is just a line end counts as a row of its chunk and is
    left out of the txt, not of the JSON."""
    chunks = flatten_text(utts, ["id"], chunk_num, "never").select(
        "id", F.col("segment").alias("chunk"), F.col("text").alias("answer"))
    txt = render_txt(chunks, ["id"], chunked, value_col="txt")
    js = render_chunked_json(utts, chunk_num, ["id"], value_col="json")
    return txt.join(js, "id").select(output_name(F.lit(run_name).cast("string"), "id").alias("name"), "txt", "json")


def write_raw_transcripts(spark: SparkSession, raw_dir: str, out_dir: str, chunk_num: int, run_name: str | None = None,
                          ids_path: str | None = None, chunked: bool = False) -> None:
    """Raw-transcript mode from files to files: the chunks of every transcript
    ``<raw_dir>/<id>.json`` as ``<run_name>_<id>.txt`` and ``.json`` in ``out_dir``."""
    ids = read_ids(spark, ids_path) if ids_path else None
    files = _only_listed(read_whole(spark, raw_dir, "id", ".json"), ids).where(is_json("value", UTTERANCE_SCHEMA))
    made = raw_transcript_files(decode_utterances(files, ["id"]), chunk_num, run_name, chunked)
    both = F.explode(F.array(*[F.struct(F.concat("name", F.lit(f".{c}")).alias("path"), F.col(c).alias("value"))
                               for c in ("txt", "json")]))
    write_shared(made.select(both.alias("f")).select("f.*"), out_dir)
