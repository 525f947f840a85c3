"""Model requests for the labelling stage, and parsing of model answers.

The labelling stage sends one request per (run, transcript, chunk) to a hosted
or local model.  This module builds those requests as rows (provider, model
id, messages, sampling parameters) from chunk texts, the ``runs`` dimension
and a prompt table; calling the models is outside Spark.  Answers come back as
a table ``(run_name, id, chunk, answer)`` and are parsed into turns here.

Routing is by substring of the model name in a fixed order (llama, claude,
azure); a name matching none gets a NULL provider (the request is reported,
not sent).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.functions.text import ordered_concat

# --- fixed values ---------------------------------------------------------
PROVIDER_ORDER = ("llama", "claude", "azure")
# Hosted model aliases -> model ids.
CLAUDE_MODEL_IDS = {
    "claude-opus-3": "claude-3-opus-20240229",
    "claude-sonnet-3": "claude-3-sonnet-20240229",
    "claude-sonnet-3.5": "claude-3-5-sonnet-20240620",
    "claude-haiku-3": "claude-3-haiku-20240307",
}
LLAMA_MODEL_IDS = {"llama-8b": "8b-instruct", "llama-70b": "70b-instruct"}
# Prefixes of the user message per stage.
TRANSCRIPT_PREFIX = "transcript: "
SUMMARY_PREFIX = "summary: "
BLOCK_SEPARATOR = "\n\n"
# Default sampling parameters per stage.
STAGE_DEFAULTS = {
    "summary": {"max_tokens": 256, "temperature": 1.0, "top_p": 1.0, "do_sample": True},
    "diarize": {"max_tokens": 4096, "temperature": 1.0, "top_p": 1.0, "do_sample": True},
}
# Default prompt names by the run's summary flag.
DEFAULT_DIARIZE_PROMPT = {True: "diarize_w_summary", False: "diarize_no_summary"}
SUMMARY_PROMPT = "summary"
# --------------------------------------------------------------------------


def provider_of(model) -> Column:
    m = F.col(model) if isinstance(model, str) else model
    expr = None
    for p in PROVIDER_ORDER:
        expr = F.when(m.contains(p), p) if expr is None else expr.when(m.contains(p), p)
    return expr.otherwise(F.lit(None).cast("string"))


def _alias(model: Column, ids: dict[str, str]) -> Column:
    return F.create_map(*[x for kv in ids.items() for x in map(F.lit, kv)])[model]


def model_id_of(model, provider, llama_instance: Column, azure_deployment: Column) -> Column:
    """Concrete model id: claude alias table, the llama instance that is served
    or else the llama alias table, the azure deployment of the stage.  An
    unknown alias gives NULL."""
    m = F.col(model) if isinstance(model, str) else model
    p = F.col(provider) if isinstance(provider, str) else provider
    return (F.when(p == "claude", _alias(m, CLAUDE_MODEL_IDS))
            .when(p == "llama", F.coalesce(llama_instance, _alias(m, LLAMA_MODEL_IDS)))
            .when(p == "azure", azure_deployment))


@dataclass(frozen=True)
class LabellingRun:
    """One configured labelling run.  Settings left None take the stage's default."""
    run_name: str
    model_diarize: str
    model_summary: str | None = None
    prompt: str | None = None
    summary: bool = False
    chunk_num: int = 1
    llama_instance: str | None = None
    azure_deployment_summary: str | None = None
    azure_deployment_diarize: str | None = None
    max_tokens_summary: int | None = None
    max_tokens_diarize: int | None = None
    temperature_summary: float | None = None
    temperature_diarize: float | None = None
    top_p_summary: float | None = None
    top_p_diarize: float | None = None
    do_sample_summary: bool | None = None
    do_sample_diarize: bool | None = None

    def override(self, chunk_num: int | None = None, model_summary: str | None = None,
                 model_diarize: str | None = None, prompt: str | None = None) -> "LabellingRun":
        """The run with every setting that is given replaced."""
        given = {"chunk_num": chunk_num, "model_summary": model_summary,
                 "model_diarize": model_diarize, "prompt": prompt}
        return replace(self, **{k: v for k, v in given.items() if v is not None})


_RUN_TYPES = {"summary": "boolean", "chunk_num": "int", **{f"{n}_{s}": t for s in ("summary", "diarize") for n, t in (
    ("max_tokens", "int"), ("temperature", "double"), ("top_p", "double"), ("do_sample", "boolean"))}}


def labelling_runs(spark: SparkSession, runs: Sequence[LabellingRun]) -> DataFrame:
    """The runs as a table, one column per setting."""
    names = list(asdict(runs[0]) if runs else LabellingRun.__dataclass_fields__)
    return spark.createDataFrame([tuple(asdict(r).values()) for r in runs],
                                 ", ".join(f"{n} {_RUN_TYPES.get(n, 'string')}" for n in names))


def default_prompt(summary_flag, override=None) -> Column:
    """The explicit prompt wins; otherwise by the run's summary flag."""
    s = F.col(summary_flag) if isinstance(summary_flag, str) else summary_flag
    dflt = F.when(s, F.lit(DEFAULT_DIARIZE_PROMPT[True])).otherwise(F.lit(DEFAULT_DIARIZE_PROMPT[False]))
    if override is None:
        return dflt
    o = F.col(override) if isinstance(override, str) else override
    return F.coalesce(o, dflt)


def _msg(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def build_requests(chunks: DataFrame, runs: DataFrame, prompts: DataFrame, stage: str,
                   summaries: DataFrame | None = None, summary_chunking: bool = True) -> DataFrame:
    """Requests per (run, id, chunk) for ``stage`` in {summary, diarize}.

    ``chunks (run_name, id, chunk, text)``; ``runs`` is ``labelling_runs`` (or
    any table with run_name, ``model_<stage>`` or ``model``, summary and,
    optionally, prompt, llama_instance, azure_deployment_<stage> and sampling
    settings per stage); ``prompts (prompt_name, text)``;
    ``summaries (run_name, id, chunk, summary)`` are the summary answers,
    joined by (run, id, chunk), or by (run, id) and reused for every chunk
    when ``summary_chunking`` is false.

    The summary stage has requests of runs with summaries only; without
    ``summary_chunking`` one per transcript (``chunk`` NULL) over its chunks,
    each followed by a blank line.  ``problem`` says why a request cannot be
    sent (its messages are NULL then, or its model id)."""
    if stage not in STAGE_DEFAULTS:
        raise ValueError("stage must be summary or diarize")
    d = STAGE_DEFAULTS[stage]

    def opt(name: str, default) -> Column:
        c = f"{name}_{stage}"
        return F.coalesce(F.col(c), F.lit(default)) if c in runs.columns else F.lit(default)

    run_cols = runs.select(
        "run_name", F.col(f"model_{stage}" if f"model_{stage}" in runs.columns else "model").alias("_model"),
        F.coalesce("summary", F.lit(False)).alias("_summary"),
        (F.lit(SUMMARY_PROMPT) if stage == "summary" else
         default_prompt("summary", "prompt" if "prompt" in runs.columns else None)).alias("_prompt"),
        (F.col("llama_instance") if "llama_instance" in runs.columns else F.lit(None).cast("string"))
        .alias("_llama"),
        opt("azure_deployment", None).cast("string").alias("_azure"),
        opt("max_tokens", d["max_tokens"]).cast("int").alias("max_tokens"),
        opt("temperature", d["temperature"]).cast("double").alias("temperature"),
        opt("top_p", d["top_p"]).cast("double").alias("top_p"),
        opt("do_sample", d["do_sample"]).cast("boolean").alias("do_sample"))
    if stage == "summary":
        run_cols = run_cols.where("_summary")
        if not summary_chunking:
            whole = F.concat(F.col("text"), F.lit(BLOCK_SEPARATOR))
            chunks = (chunks.select("run_name", "id", "chunk", whole.alias("_w")).groupBy("run_name", "id")
                      .agg(ordered_concat("_w", "chunk", "").alias("text"))
                      .select("run_name", "id", F.lit(None).cast("int").alias("chunk"), "text"))
    # runs and prompts are as small as a person typed them; the optimizer sees that
    df = chunks.join(run_cols, "run_name")
    df = df.join(prompts.select(F.col("prompt_name").alias("_prompt"), F.col("text").alias("_ptext")),
                 "_prompt", "left")
    use_summary = F.lit(False)
    summary_text = F.lit(None).cast("string")
    if stage == "diarize":
        if summaries is not None:
            on = ["run_name", "id", "chunk"] if summary_chunking else ["run_name", "id"]
            df = df.join(summaries.select(*on, F.col("summary").alias("_s")), on, "left")
            summary_text = F.col("_s")
        use_summary = F.col("_summary")
    provider = provider_of("_model")
    chunk = F.col("text")
    if stage == "summary":
        user = chunk
        azure_user = F.concat(F.col("_ptext"), F.lit(BLOCK_SEPARATOR), F.lit(TRANSCRIPT_PREFIX),
                              F.lit(BLOCK_SEPARATOR), chunk)
    else:
        user = F.when(use_summary, F.concat(F.lit(SUMMARY_PREFIX), summary_text, F.lit(BLOCK_SEPARATOR),
                                            F.lit(TRANSCRIPT_PREFIX), chunk)) \
                .otherwise(F.concat(F.lit(TRANSCRIPT_PREFIX), chunk))
        azure_user = F.when(use_summary, F.concat(F.col("_ptext"), F.lit(BLOCK_SEPARATOR + "summary:"),
                                                  summary_text, F.lit(BLOCK_SEPARATOR),
                                                  F.lit(TRANSCRIPT_PREFIX), chunk)) \
                      .otherwise(F.concat(F.col("_ptext"), F.lit(BLOCK_SEPARATOR),
                                          F.lit(TRANSCRIPT_PREFIX), chunk))
    messages = (F.when(provider == "llama", F.array(_msg("system", F.col("_ptext")), _msg("user", user)))
                .when(provider == "claude", F.array(_msg("user", user)))
                .when(provider == "azure", F.array(_msg("user", azure_user))))
    model_id = model_id_of("_model", provider, F.col("_llama"), F.col("_azure"))
    problem = (F.when(provider.isNull(), "unknown model").when(model_id.isNull(), "no model id")
               .when(F.col("_ptext").isNull(), "no prompt")
               .when(use_summary & summary_text.isNull(), "no summary"))
    return df.select(
        "run_name", "id", "chunk", F.lit(stage).alias("stage"), provider.alias("provider"),
        model_id.alias("model_id"),
        F.when(provider == "claude", F.col("_ptext")).alias("system"),
        messages.alias("messages"), "max_tokens", "temperature",
        F.when(provider != "claude", F.col("top_p")).alias("top_p"),
        F.when(provider == "llama", F.col("do_sample")).alias("do_sample"),
        F.when(provider == "azure", F.lit(0.0)).alias("frequency_penalty"),
        F.when(provider == "azure", F.lit(0.0)).alias("presence_penalty"), problem.alias("problem"))


def parse_answers(answers: DataFrame, keys: Sequence[str] = ("run_name", "id"),
                  answer_col: str = "answer") -> DataFrame:
    """Model answers per chunk -> turns ``(keys, chunk, block, speaker, text)``.

    An answer splits on blank lines; a block without a colon is dropped; the
    speaker is the text before the first colon and the text what follows it,
    both untrimmed."""
    keys = list(keys)
    blocks = answers.select(*keys, "chunk", F.posexplode(F.split(F.col(answer_col), BLOCK_SEPARATOR, -1))
                            .alias("block", "_b"))
    idx = F.instr(F.col("_b"), ":")
    return (blocks.where(idx > 0)
            .select(*keys, "chunk", "block",
                    F.col("_b").substr(F.lit(1), idx - 1).alias("speaker"),
                    F.col("_b").substr(idx + 1, F.length("_b") + 1).alias("text")))
