"""Score labelled transcripts as their files land in a folder.

Streaming is not a reference feature; this is the same scoring operator fed
by Structured Streaming's file source instead of a one-off read.  Labelled txt
files arrive as ``<root>/<run_name>/<id>.txt``; each micro-batch is decoded,
segmented, consolidated and scored against the (static) gold and raw
segments, and written as its own folder ``batch_id=<n>`` of a parquet table
(overwritten on a replay of that batch, so a restarted query does not
duplicate rows).  The checkpoint lives under the session's shared
``spark.checkpoint.dir`` unless a location is given.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from colloquy.operators.consolidate import segment_texts_from_lines
from colloquy.operators.scoring import METRICS, score_segments
from colloquy.sources.decoders import decode_lines

KEYS = ["run_name", "id"]


def stream_files(spark: SparkSession, root: str, suffix: str = ".txt",
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming ``(run_name, id, value)``: one row per whole file; the run is
    the parent folder's name, the id the file name minus ``suffix``."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = reader.text(f"{root}/*/*{suffix}", wholetext=True)
    path = F.url_decode(F.col("_metadata.file_path"))
    parts = F.split(path, "/")
    name = F.element_at(parts, -1)
    return df.select(F.element_at(parts, -2).alias("run_name"),
                     name.substr(F.lit(1), F.length(name) - len(suffix)).alias("id"),
                     F.col("value"))


def score_stream(spark: SparkSession, root: str, gold: DataFrame, raw: DataFrame, out_path: str,
                 n_segments: int = 3, label_mode: str = "canonical",
                 metrics: Sequence[str] = METRICS, families=("preservation", "accuracy"),
                 checkpoint: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Start the stream.  ``gold (id, segment, labelled)`` and ``raw (id, segment,
    text)`` are segment tables built once with the same ``n_segments``."""
    if checkpoint is None:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            raise ValueError("set spark.checkpoint.dir (a shared folder) or pass checkpoint=")
        checkpoint = f"{base.rstrip('/')}/colloquy-score-stream"

    def score_batch(files: DataFrame, batch_id: int) -> None:
        lines = decode_lines(files, KEYS)
        pred = segment_texts_from_lines(lines, n_segments, KEYS, files.select(*KEYS), label_mode)
        scores = score_segments(pred, gold, raw, metrics=metrics, families=families)
        scores.write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    writer = (stream_files(spark, root).writeStream.foreachBatch(score_batch)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
