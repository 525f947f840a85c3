"""Named queries: each takes ``(spark, sf_dir)`` and returns a lazy DataFrame.

Every query reads the driver's tables (or files Spark derives from them) in
full; there are no id subsets or row caps.  Computed columns carry fixed
names so the oracle SQL in ``plans.oracle`` returns the same schema.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.functions.text import canonical_speaker, label_of, text_after_label
from colloquy.operators import runs as R
from colloquy.operators.requests import LabellingRun, build_requests, labelling_runs, parse_answers
from colloquy.operators.scoring import ordered_score_columns, to_tall
from colloquy.operators.segments import flatten_text, segment_of
from colloquy.operators.sentences import sentences
from colloquy.plans import inputs as I
from colloquy.plans import jobs as J
from colloquy.session import materialize
from colloquy.sources.decoders import (UTTERANCE_SCHEMA, decode_ids, decode_lines, decode_manifest_lines,
                                       decode_scores, decode_utterances, is_json, malformed_json)
from colloquy.sources.sinks import output_name, render_sentences_json, render_utterances_json, score_file_payload
from colloquy.sources.tables import RUNS, raw_utterances, runs_frame, table

Query = Callable[[SparkSession, str], DataFrame]

LEV = ("levenshtein",)
CHUNK_COUNTS = (1, 3, 6, 9)

# --- fixed values ---------------------------------------------------------
# Run selections of the comparison queries over the simulated runs.
RUN_SELECTION = [("r2", "few shot"), ("r0", "baseline"), ("r1", "summary"), ("r0", "baseline again")]
GROUP_SELECTION = [("r0", "no summary"), ("r2", "no summary"), ("r1", "summary")]
CHECKED_SELECTION = [("r1", "summary"), ("r7", "not scored"), ("r0", "baseline"), ("r9", "not scored")]
# Prompt texts of the simulated runs (a prompt table; real runs read files).
PROMPTS = [
    ("summary", "Summarise the conversation below in one paragraph."),
    ("diarize_no_summary", "Label every utterance of the transcript with its speaker."),
    ("diarize_w_summary", "Using the summary, label every utterance with its speaker."),
    ("diarize_few_shot", "Label every utterance with its speaker, as in the examples."),
]
LLAMA_INSTANCE = "llama-3.1-70b-instruct"
AZURE_DEPLOYMENT = "gpt4o-deployment"
# Labelling runs of the request queries: no prompt of its own, one model per
# stage, aliases, a served instance, an unknown model, an unanswered summary.
REQUEST_RUNS = (
    LabellingRun("r0", "claude-sonnet-3.5"),
    LabellingRun("r1", "azure", "claude-haiku-3", "diarize_w_summary", True, 3,
                 azure_deployment_diarize=AZURE_DEPLOYMENT),
    LabellingRun("r2", "llama-70b", prompt="diarize_few_shot", top_p_diarize=0.9, do_sample_diarize=False),
    LabellingRun("r3", "llama-70b", "llama-8b", None, True, 2, llama_instance=LLAMA_INSTANCE, max_tokens_summary=128,
                 temperature_summary=0.5),
    LabellingRun("r4", "other-model", prompt="diarize_few_shot"),
    LabellingRun("r5", "claude-opus-3", "azure", "no such prompt", True, 2),
)
# Run names of the experiments' score table: those of the named comparisons and more.
GIVEN_RUNS = tuple(dict.fromkeys([r for named in (R.CATALOGUE, R.GROUP_CATALOGUE) for runs in named.values() for r, _ in runs]
                                 + ["gpt4o-3-seg", "llama-70b-3-seg"]))
SCORE_FILE_SUFFIX = "-3-seg"
RAW_RUN, RAW_CHUNKS = "raw", 3
# --------------------------------------------------------------------------


def _id_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The id list a job is given, as JSONL lines (from ``labels``)."""
    lines = table(spark, sf_dir, "labels").select(
        F.to_json(F.struct(F.col("doc_id").cast("string").alias("id"))).alias("value"))
    return decode_ids(lines)


def _transcript_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_utterances(spark, sf_dir).groupBy("id").agg(
        F.count(F.lit(1)).alias("n_utterances"))


def transcript_ids(spark, sf_dir):
    """Ids of the list that have a transcript, with its utterance count."""
    return _id_list(spark, sf_dir).join(_transcript_counts(spark, sf_dir), "id", "inner")


def missing_transcripts(spark, sf_dir):
    """Ids of the list with no transcript (the reader's missing-file report)."""
    return _id_list(spark, sf_dir).join(_transcript_counts(spark, sf_dir), "id", "left_anti")


def utterances_from_json(spark, sf_dir):
    """Raw transcripts as JSON arrays -> utterance rows (round trip K3 -> S2)."""
    files = render_utterances_json(raw_utterances(spark, sf_dir), ["id"])
    return decode_utterances(files, ["id"])


def manifest_lookup(spark, sf_dir):
    """id -> transcript JSON path: first manifest line per id, ``.json`` for the
    last four characters; ids without a line get NULL (the missing report)."""
    pages = table(spark, sf_dir, "pages")
    lines = pages.select(F.col("page_id").alias("line_no"), F.concat(
        F.lit('"'), F.col("url"), F.lit('",grade,'), F.regexp_extract("url", r"/[a-z]{2}/([0-9]+)", 1))
        .alias("line"))
    manifest = decode_manifest_lines(lines, header=("path", "grade", "id"))
    first = (manifest.where(F.col("id") != "").groupBy("id")
             .agg(F.min_by("path", "line_no").alias("path")))
    json_path = F.concat(F.col("path").substr(F.lit(1), F.length("path") - 4), F.lit(".json"))
    wanted = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"))
    return wanted.join(first.select("id", json_path.alias("json_path")), "id", "left")


def lines_from_text(spark, sf_dir):
    """Plain transcripts -> physical lines (universal newlines)."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), "text")
    return decode_lines(docs, ["id"], "text")


def sentences_from_text(spark, sf_dir):
    """Plain transcripts -> one sentence per row."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), "text")
    return sentences(docs, ["id"], "text")


def sentence_utterances(spark, sf_dir):
    """Plain transcripts -> the raw transcript JSON of their sentences, read back
    as utterances; a text without a sentence is ``[]`` and has none."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), "text")
    files = render_sentences_json(sentences(docs, ["id"], "text"), transcripts=docs)
    return decode_utterances(files, ["id"]).select("id", "pos", "text", "n_rows")


def flatten_transcript(spark, sf_dir):
    """One raw text per transcript (1 chunk, as sent for labelling)."""
    return flatten_text(raw_utterances(spark, sf_dir), ["id"], 1, "never") \
        .select("id", "text", "n_utterances")


def chunk_transcript(spark, sf_dir):
    """Raw text per chunk for 1, 3, 6 and 9 chunks; empty chunks are ''."""
    utts = raw_utterances(spark, sf_dir).withColumn(
        "chunk_num", F.explode(F.array(*[F.lit(n) for n in CHUNK_COUNTS])))
    out = flatten_text(utts, ["chunk_num", "id"], "chunk_num", "never")
    return out.select("chunk_num", "id", F.col("segment").alias("chunk"), "text", "n_utterances")


def chunked_json(spark, sf_dir):
    """The chunked raw JSON (``chunk n`` -> utterances) in row form: per chunk
    its key, utterance count, first/last position and time span."""
    utts = raw_utterances(spark, sf_dir).withColumn("chunk_num", F.explode(F.array(F.lit(1), F.lit(3))))
    counts = utts.groupBy("chunk_num", "id").agg(F.count(F.lit(1)).alias("n_rows"))
    rows = utts.join(counts, ["chunk_num", "id"]) \
               .withColumn("chunk", segment_of("pos", "n_rows", "chunk_num"))
    grid = counts.select("chunk_num", "id", F.explode(F.sequence(F.lit(0), F.col("chunk_num") - 1))
                         .alias("chunk"))
    agg = rows.groupBy("chunk_num", "id", "chunk").agg(
        F.count(F.lit(1)).alias("n_utterances"), F.min("pos").alias("first_pos"),
        F.max("pos").alias("last_pos"), F.min("start_s").alias("start_s"), F.max("end_s").alias("end_s"))
    key = F.when(F.col("chunk_num") > 1, F.concat(F.lit("chunk "), F.col("chunk").cast("string")))
    return (grid.join(agg, ["chunk_num", "id", "chunk"], "left")
            .select("chunk_num", "id", "chunk", key.alias("chunk_key"),
                    F.coalesce("n_utterances", F.lit(0)).alias("n_utterances"),
                    "first_pos", "last_pos", "start_s", "end_s"))


def strip_labels_text(spark, sf_dir):
    return I.pred_segments(spark, sf_dir, with_labelled=False)


def strip_labels_json(spark, sf_dir):
    return I.pred_segments(spark, sf_dir, source="json", with_labelled=False)


def parse_labelled(spark, sf_dir):
    """Every physical line of the labelled txt split at its first colon."""
    lines = decode_lines(I.pred_txt_files(spark, sf_dir), I.RUN_KEYS)
    return lines.select("run_name", "id", "pos", label_of("line").alias("label"),
                        canonical_speaker(label_of("line")).alias("speaker"),
                        text_after_label("line").alias("text"))


def parse_model_answers(spark, sf_dir):
    return parse_answers(I.pred_answers(spark, sf_dir))


def consolidate_turns(spark, sf_dir):
    return I.pred_segments(spark, sf_dir, with_bare=False)


def consolidate_literal(spark, sf_dir):
    return I.pred_segments(spark, sf_dir, label_mode="literal", with_bare=False)


def consolidate_json(spark, sf_dir):
    return I.pred_segments(spark, sf_dir, source="json")


def render_transcript(spark, sf_dir):
    files = I.pred_txt_files(spark, sf_dir)
    return files.select(output_name("run_name", "id").alias("name"), "value")


def render_chunked(spark, sf_dir):
    files = I.pred_txt_files(spark, sf_dir, chunked=True)
    return files.select(output_name("run_name", "id").alias("name"), "value")


def _lev_scores(spark, sf_dir, n_segments=I.N_SEGMENTS, families=("preservation", "accuracy"),
                label_mode="canonical", source="txt", raw_normalise="always", segment_by="line"):
    return I.scores(spark, sf_dir, n_segments, LEV, families, label_mode, source, raw_normalise,
                    segment_by)


def preservation_lev(spark, sf_dir):
    return I.rounded(_lev_scores(spark, sf_dir, families=("preservation",)))


def nolabel_baseline_lev(spark, sf_dir):
    s = _lev_scores(spark, sf_dir, families=("accuracy",))
    return I.rounded(s.select("run_name", "id", "segment", "lev_baseline"))


def accuracy_lev(spark, sf_dir):
    s = _lev_scores(spark, sf_dir, families=("accuracy",))
    return I.rounded(s.select("run_name", "id", "segment", "lev_acc", "lev_baseline", "lev_acc_normed"))


def accuracy_lev_literal(spark, sf_dir):
    s = _lev_scores(spark, sf_dir, families=("accuracy",), label_mode="literal")
    return I.rounded(s.select("run_name", "id", "segment", "lev_acc", "lev_baseline", "lev_acc_normed"))


def scores_lev_by_turn(spark, sf_dir):
    """Txt sides segmented by turn instead of physical line."""
    s = _lev_scores(spark, sf_dir, segment_by="turn")
    return I.rounded(ordered_score_columns(s))


def preservation_by_label(spark, sf_dir):
    """Labels alone stripped, segments by turn: an unperturbed run keeps all."""
    return I.rounded(I.scores(spark, sf_dir, metrics=LEV, families=("preservation",), segment_by="turn",
                              strip_mode="label"))


def accuracy_lev_json(spark, sf_dir):
    s = _lev_scores(spark, sf_dir, source="json")
    return I.rounded(ordered_score_columns(s))


def preservation_lev_literal(spark, sf_dir):
    """One segment, raw text not whitespace-collapsed (reference-exact)."""
    s = _lev_scores(spark, sf_dir, n_segments=1, families=("preservation",), raw_normalise="literal")
    return I.rounded(s)


def diff_ratio_scores(spark, sf_dir):
    return I.rounded(ordered_score_columns(
        I.scores(spark, sf_dir, metrics=("diff",))))


def score_table(spark, sf_dir):
    """All ten score columns (both metrics, composites) per (run, id, segment)."""
    return I.rounded(ordered_score_columns(I.scores(spark, sf_dir)))


def decode_score_files(spark, sf_dir):
    """Score files written per run (sharded by id) and read back as one table;
    only files whose name contains ``seg`` are taken."""
    tall = to_tall(materialize(_lev_scores(spark, sf_dir))).withColumn(
        "run_name", F.concat("run_name", F.lit(SCORE_FILE_SUFFIX)))
    files = score_file_payload(tall)
    decoded = decode_scores(files.where(F.col("run_name").contains("seg")))
    return I.rounded(decoded)


def run_means(spark, sf_dir):
    return I.rounded(R.run_means(_lev_scores(spark, sf_dir, n_segments=1)))


def segment_means(spark, sf_dir):
    return I.rounded(R.segment_means(_lev_scores(spark, sf_dir)))


def segment_progression(spark, sf_dir):
    scored = materialize(_lev_scores(spark, sf_dir, families=("accuracy",)))
    return I.rounded(R.progression(scored, "lev_acc_normed"))


def compare_runs(spark, sf_dir):
    means = R.run_means(_lev_scores(spark, sf_dir, n_segments=1))
    return I.rounded(R.compare_runs(means, R.selection_frame(spark, RUN_SELECTION)))


def compare_groups(spark, sf_dir):
    means = R.run_means(_lev_scores(spark, sf_dir, n_segments=1))
    return I.rounded(R.compare_groups(means, R.selection_frame(spark, GROUP_SELECTION)))


def missing_runs(spark, sf_dir):
    """Selected runs that have no labelled files (the selection check)."""
    present = I.pred_txt_files(spark, sf_dir).select("run_name").distinct()
    return R.missing_runs(present, R.selection_frame(spark, CHECKED_SELECTION))


def compare_by_summary(spark, sf_dir):
    """Run means grouped by a column of the runs dimension (summary flag)."""
    means = R.run_means(_lev_scores(spark, sf_dir, n_segments=1))
    return I.rounded(R.compare_by(means, runs_frame(spark, RUNS), ["summary"]))


def _runs_dim(spark):
    return labelling_runs(spark, REQUEST_RUNS)


def _prompts(spark):
    return spark.createDataFrame(PROMPTS, "prompt_name string, text string")


def _chunks(spark, sf_dir):
    """Raw chunk texts per (run, id, chunk) in the run's chunk count.  Texts are
    shuffled once per chunk count, not per run: runs are attached afterwards."""
    counts = sorted({r.chunk_num for r in REQUEST_RUNS})
    utts = raw_utterances(spark, sf_dir).select("id", "pos", "text", F.explode(F.array(*map(F.lit, counts))).alias("chunk_num"))
    named = F.create_map(*[x for n in counts for x in (F.lit(n), F.array(*[
        F.lit(r.run_name) for r in REQUEST_RUNS if r.chunk_num == n]))])
    return flatten_text(utts, ["chunk_num", "id"], "chunk_num", "never") \
        .select(F.explode(named[F.col("chunk_num")]).alias("run_name"), "id", F.col("segment").alias("chunk"), "text")


def _flat_requests(req: DataFrame) -> DataFrame:
    return req.select(
        "run_name", "id", "chunk", "stage", "provider", "model_id",
        F.coalesce("system", F.try_element_at(F.filter("messages", lambda m: m["role"] == "system"),
                                                F.lit(1))["content"])
        .alias("system_prompt"),
        F.element_at("messages", -1)["content"].alias("user_content"),
        F.when(F.col("messages").isNotNull(), F.size("messages")).alias("n_messages"), "max_tokens", "temperature",
        "top_p", "do_sample", "frequency_penalty", "presence_penalty", "problem")


def model_requests(spark, sf_dir):
    """Summary requests (runs with summaries) and labelling requests (all runs).
    The stand-in summary of a chunk is its text; run r5 has none."""
    runs, prompts, chunks = _runs_dim(spark), _prompts(spark), _chunks(spark, sf_dir)
    summaries = chunks.where(F.col("run_name") != "r5").select("run_name", "id", "chunk", F.col("text").alias("summary"))
    summ = build_requests(chunks, runs, prompts, "summary")
    diar = build_requests(chunks, runs, prompts, "diarize", summaries=summaries)
    return _flat_requests(summ.unionByName(diar))


def summary_join(spark, sf_dir):
    """Whole-transcript summary requests, and labelling requests that carry one
    whole-transcript summary in every chunk."""
    runs, prompts, chunks = _runs_dim(spark), _prompts(spark), _chunks(spark, sf_dir)
    whole = flatten_text(raw_utterances(spark, sf_dir), ["id"], 1, "never") \
        .select("id", F.col("text").alias("summary"))
    names = [r.run_name for r in REQUEST_RUNS if r.summary]
    summaries = whole.withColumn("run_name", F.explode(F.array(*[F.lit(n) for n in names])))
    asked = build_requests(chunks, runs, prompts, "summary", summary_chunking=False)
    req = build_requests(chunks, runs.where("summary"), prompts, "diarize",
                         summaries=summaries, summary_chunking=False)
    return _flat_requests(asked.unionByName(req))


def _given_scores(spark, sf_dir) -> DataFrame:
    """A score table as experiments leave it: accuracy scores, by both metrics,
    of the simulated runs' files, under the run names of the named comparisons
    (each name stands for one of the simulated runs); every seventh transcript
    lacks its last segment, run names carry ``seg`` or not."""
    scored = I.scores(spark, sf_dir, families=("accuracy",))
    names = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), F.lit(RUNS[k % len(RUNS)].run_name).alias("run"))
                                for k, name in enumerate(GIVEN_RUNS)]))
    size = raw_utterances(spark, sf_dir).groupBy("id").agg(F.sum(F.length("text")).alias("c"))
    rows = scored.join(size, "id").where((F.col("segment") < 2) | (F.col("c") % 7 != 0)).drop("c")
    return (rows.withColumn("_n", names).where(F.col("_n.run") == F.col("run_name"))
            .withColumn("run_name", F.col("_n.name")).drop("_n"))


def composite_scores(spark, sf_dir):
    """The wide score table of a multi-segment experiment, composites included."""
    return I.rounded(ordered_score_columns(_given_scores(spark, sf_dir)))


def one_segment_means(spark, sf_dir):
    """Run means over segment 0 only, of the score files named ``seg``."""
    scores = _given_scores(spark, sf_dir).where(F.col("run_name").contains("seg"))
    return I.rounded(R.one_segment_means(scores))


def compare_best(spark, sf_dir):
    """The named comparison of the best run of each model."""
    return I.rounded(R.compare_named(R.run_means(_given_scores(spark, sf_dir)), "best_of_each"))


def compare_summary_overall(spark, sf_dir):
    """The named group comparison with and without summaries."""
    return I.rounded(R.compare_named(R.run_means(_given_scores(spark, sf_dir)), "summary_vs_none_overall"))


def compare_catalogue(spark, sf_dir):
    """Every named comparison, run by run and by group, from one set of run means."""
    return I.rounded(R.compare_catalogue(R.run_means(_given_scores(spark, sf_dir))))


def transcript_curves(spark, sf_dir):
    """Every transcript's composite curve in the order of its segments, with the
    length check (curves that lack a segment are flagged)."""
    c = R.curves(_given_scores(spark, sf_dir))
    return I.rounded(c.select("run_name", "id", "complete", F.posexplode("curve").alias("ord", "value")))


def parse_problems(spark, sf_dir):
    """Transcript JSON of every conversation as a faulty job leaves it (empty,
    truncated, an object, whole): what is reported, and the rows of the rest."""
    whole = render_utterances_json(raw_utterances(spark, sf_dir), ["id"])
    kind = F.pmod(F.col("id").cast("long"), F.lit(5))
    files = whole.select("id", F.when(kind == 0, "[]").when(kind == 1, F.substring("value", 1, 20))
                         .when(kind == 2, F.concat(F.lit('{"a":'), F.col("value"), F.lit("}")))
                         .otherwise(F.col("value")).alias("value"))
    bad = malformed_json(files, UTTERANCE_SCHEMA).select("id", F.lit("malformed").alias("state"), F.lit(None).cast("int").alias("segment"),
                                                         F.lit(None).cast("string").alias("text"))
    good = files.where(is_json("value", UTTERANCE_SCHEMA))
    parts = flatten_text(decode_utterances(good, ["id"], keep_empty=True), ["id"], 2, "never")
    return bad.unionByName(parts.select("id", F.lit("read").alias("state"), "segment", "text"))


def raw_transcript_files(spark, sf_dir):
    """The files of the raw-transcript mode, three chunks a transcript.  As in
    transcripts with pauses, some utterances are just a line end."""
    utts = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("string").alias("id"), F.col("turn").cast("int").alias("pos"),
        F.lit(None).cast("double").alias("start_s"), F.lit(None).cast("double").alias("end_s"),
        F.when((F.col("conv_id") + F.col("turn")) % 4 == 1, "\n").otherwise(F.col("text")).alias("text"))
    files = J.raw_transcript_files(utts, RAW_CHUNKS, RAW_RUN, chunked=True)
    parts = F.from_json("json", "map<string,array<struct<text:string>>>")
    return files.select("name", "txt", F.transform(F.sequence(F.lit(0), F.lit(RAW_CHUNKS - 1)), lambda k: F.size(
        parts[F.concat(F.lit("chunk "), k.cast("string"))])).cast("string").alias("json_rows"))


def flagship(spark, sf_dir):
    """Every score of every run, averaged per (run, segment)."""
    return I.rounded(R.segment_means(I.scores(spark, sf_dir)))


def queries() -> dict[str, Query]:
    return {
        "transcript_ids": transcript_ids,
        "missing_transcripts": missing_transcripts,
        "utterances_from_json": utterances_from_json,
        "manifest_lookup": manifest_lookup,
        "lines_from_text": lines_from_text,
        "sentences_from_text": sentences_from_text,
        "sentence_utterances": sentence_utterances,
        "flatten_transcript": flatten_transcript,
        "chunk_transcript": chunk_transcript,
        "chunked_json": chunked_json,
        "strip_labels_text": strip_labels_text,
        "strip_labels_json": strip_labels_json,
        "parse_labelled": parse_labelled,
        "parse_answers": parse_model_answers,
        "consolidate_turns": consolidate_turns,
        "consolidate_literal": consolidate_literal,
        "consolidate_json": consolidate_json,
        "render_transcript": render_transcript,
        "render_chunked": render_chunked,
        "preservation_lev": preservation_lev,
        "preservation_lev_literal": preservation_lev_literal,
        "nolabel_baseline_lev": nolabel_baseline_lev,
        "accuracy_lev": accuracy_lev,
        "accuracy_lev_literal": accuracy_lev_literal,
        "accuracy_lev_json": accuracy_lev_json,
        "scores_lev_by_turn": scores_lev_by_turn,
        "preservation_by_label": preservation_by_label,
        "diff_ratio_scores": diff_ratio_scores,
        "score_table": score_table,
        "decode_score_files": decode_score_files,
        "run_means": run_means,
        "segment_means": segment_means,
        "segment_progression": segment_progression,
        "compare_runs": compare_runs,
        "compare_groups": compare_groups,
        "compare_by_summary": compare_by_summary,
        "missing_runs": missing_runs,
        "model_requests": model_requests,
        "summary_join": summary_join,
        "composite_scores": composite_scores,
        "one_segment_means": one_segment_means,
        "compare_best": compare_best,
        "compare_summary_overall": compare_summary_overall,
        "compare_catalogue": compare_catalogue,
        "transcript_curves": transcript_curves,
        "parse_problems": parse_problems,
        "raw_transcript_files": raw_transcript_files,
        "flagship_segment_means": flagship,
    }
