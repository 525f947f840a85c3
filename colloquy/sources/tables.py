"""Transcript inputs derived from the driver's parquet tables.

``conversations(conv_id, turn, role, text)`` stands for the raw and labelled
transcripts: a conversation is a transcript (id = conv_id as a string, the way
id lists carry ids), a turn is an utterance, its position is ``turn``.

* raw utterances: the turn texts, with synthetic timestamps (4 s per turn);
* gold labelling: the role mapped to a lower-case speaker label, as gold files
  are written (``patient:``/``student:``/``instructions:``);
* labelling runs: a small fixed dimension of simulated model runs.  Each run
  relabels some turns (the two parties swapped, Instructions read as Patient)
  and drops some words, by a deterministic rule on (conv_id, turn) and the
  run's rates, and writes title-case labels as models do.

Runs are attached with a generator (``explode`` of a literal array), not a
join: every conversation row yields one row per run and nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values ---------------------------------------------------------
# role -> gold label (lower-case, as in gold files) and model label (title-case)
GOLD_LABEL = {"user": "patient", "assistant": "student", "system": "instructions"}
MODEL_LABEL = {"user": "Patient", "assistant": "Student", "system": "Instructions"}
# a relabelled turn gets the other party; instructions are read as Patient
SWAPPED_LABEL = {"user": "Student", "assistant": "Patient", "system": "Patient"}
SECONDS_PER_TURN = 4.0
# --------------------------------------------------------------------------


@dataclass(frozen=True)
class Run:
    """A simulated labelling run (one row of the ``runs`` dimension)."""
    run_name: str
    swap_every: int          # relabel turn when (conv_id*5 + turn*11 + 1) % swap_every == 0
    drop_every: int          # drop " the " when (conv_id + turn) % drop_every == 1
    chunk_num: int = 1       # chunks the transcript was labelled in
    model: str = "claude-sonnet-3.5"
    prompt: str = "diarize_no_summary"
    summary: bool = False


RUNS: tuple[Run, ...] = (
    Run("r0", 1000003, 1000003, 1, "claude-sonnet-3.5", "diarize_no_summary", False),
    Run("r1", 7, 7, 3, "azure", "diarize_w_summary", True),
    Run("r2", 3, 3, 1, "llama-70b", "diarize_few_shot", False),
)


# key column per table, used to spread a scan that yields too few splits
TABLE_KEYS = {"conversations": "conv_id", "documents": "doc_id", "pages": "page_id",
              "labels": "doc_id"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read a driver table.  A scan that yields fewer splits than the cluster
    has cores (a single-row-group file) is hash-spread on the table key, so
    the per-row text work after it is not confined to one task; a large input
    arrives in many splits and is left as read (no extra shuffle)."""
    return spread_scan(spark.read.parquet(f"{sf_dir}/{name}.parquet"), TABLE_KEYS.get(name))


def spread_scan(df: DataFrame, key: str | None) -> DataFrame:
    if key is None:
        return df
    try:
        cores = df.sparkSession.sparkContext.defaultParallelism
        splits = df.rdd.getNumPartitions()     # planning only, no job
    except Exception:  # noqa: BLE001 - no RDD access (Spark Connect): leave as read
        return df
    return df if splits >= cores else df.repartition(cores, key)


def _map(col: Column, mapping: dict[str, str], default: str) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = (F.when(col == k, v) if expr is None else expr.when(col == k, v))
    return expr.otherwise(default)


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    return c.select(F.col("conv_id").cast("string").alias("id"), "conv_id", "turn",
                    F.col("turn").cast("int").alias("pos"), "role", "text")


def raw_utterances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, pos, start_s, end_s, text)`` per turn."""
    c = conversations(spark, sf_dir)
    start = (F.col("turn") * F.lit(SECONDS_PER_TURN)).cast("double")
    return c.select("id", "pos", start.alias("start_s"),
                    (start + F.lit(SECONDS_PER_TURN)).alias("end_s"), "text")


def gold_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, pos, speaker, text)``; lower-case labels."""
    c = conversations(spark, sf_dir)
    return c.select("id", "pos", _map(F.col("role"), GOLD_LABEL, "instructions").alias("speaker"),
                    "text")


def runs_frame(spark: SparkSession, runs: Sequence[Run] = RUNS) -> DataFrame:
    """The ``runs`` dimension as a DataFrame (fixed, a handful of rows)."""
    return spark.createDataFrame(
        [(r.run_name, r.model, r.prompt, r.chunk_num, r.summary, r.swap_every, r.drop_every)
         for r in runs],
        "run_name string, model string, prompt string, chunk_num int, summary boolean, "
        "swap_every long, drop_every long")


def runs_array(runs: Sequence[Run] = RUNS) -> Column:
    """The runs dimension as a literal array of structs, for ``explode``."""
    return F.array(*[F.struct(F.lit(r.run_name).alias("run_name"),
                              F.lit(r.swap_every).cast("long").alias("swap_every"),
                              F.lit(r.drop_every).cast("long").alias("drop_every"),
                              F.lit(r.chunk_num).alias("chunk_num"),
                              F.lit(r.model).alias("model"),
                              F.lit(r.prompt).alias("prompt"),
                              F.lit(r.summary).alias("summary"))
                     for r in runs])


def predicted_turns(spark: SparkSession, sf_dir: str, runs: Sequence[Run] = RUNS) -> DataFrame:
    """``(run_name, id, pos, chunk_num, speaker, text)``: one labelling per run."""
    c = conversations(spark, sf_dir).withColumn("_r", F.explode(runs_array(runs)))
    swap = ((F.col("conv_id") * 5 + F.col("turn") * 11 + 1) % F.col("_r.swap_every")) == 0
    drop = ((F.col("conv_id") + F.col("turn")) % F.col("_r.drop_every")) == 1
    speaker = F.when(swap, _map(F.col("role"), SWAPPED_LABEL, "Patient")) \
               .otherwise(_map(F.col("role"), MODEL_LABEL, "Instructions"))
    text = F.when(drop, F.replace(F.col("text"), F.lit(" the "), F.lit(" "))).otherwise(F.col("text"))
    return c.select(F.col("_r.run_name").alias("run_name"), "id", "pos",
                    F.col("_r.chunk_num").alias("chunk_num"), speaker.alias("speaker"),
                    text.alias("text"))
