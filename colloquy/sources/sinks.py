"""Renderers and writers (the sinks).

Renderers turn row tables back into the file formats (txt / JSON per
transcript) as a column, so a plan can write them, hash them, or feed them
to the decoders again.  Writers lay output out as tables partitioned by run,
not as one small file per transcript.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colloquy.functions.text import ordered_concat
from colloquy.operators.segments import segment_of
from colloquy.sources.files import write_shared

# --- fixed values ---------------------------------------------------------
TURN_SEPARATOR = "\n\n"          # between turns of an answer, after every chunk
IDS_PER_SHARD = 2000
CHUNK_HEADING = "chunk {j}:\n\n"  # heading per chunk when output is chunked
# --------------------------------------------------------------------------


def output_name(run_name, id_) -> Column:
    """``run_name + "_" + id``, or ``id`` alone when the run has no name."""
    return F.concat_ws("_", F.col(run_name) if isinstance(run_name, str) else run_name,
                       F.col(id_) if isinstance(id_, str) else id_)


def write_named_files(files: DataFrame, root: str, suffix: str = ".txt", value_col: str = "value",
                      folders: bool = False) -> None:
    """Write ``files (run_name, id, value)`` as text files: ``<run_name>_<id><suffix>``
    (``output_name``), or ``<run_name>/<id><suffix>`` with ``folders``, the tree
    that ``plans.jobs.score_runs`` reads.  Written and committed by
    ``sources.files``; the folder must be one that all nodes share."""
    name = F.concat_ws("/", "run_name", "id") if folders else output_name("run_name", "id")
    write_shared(files.select(F.concat(name, F.lit(suffix)).alias("path"), F.col(value_col).alias("value")), root)


def turn_line(speaker="speaker", text="text", sep: str = ": ") -> Column:
    return F.concat(F.col(speaker), F.lit(sep), F.col(text))


def model_answers(turns: DataFrame, chunk_num, keys: Sequence[str] = ("run_name", "id")) -> DataFrame:
    """Labelled turns -> one answer text per chunk, as a labelling model
    returns it: ``Speaker: text`` blocks joined by a blank line.  Turns are
    cut into ``chunk_num`` chunks like the utterances they label; a chunk
    with no turns has the answer ``''``.  ``chunk_num`` is an int or a column
    of ``turns`` (constant per transcript).

    One exchange on the transcript key serves everything up to the rendered
    file: the row count and first-row flag are windows over the clustered
    transcript, the empty-chunk placeholders are generated from its first
    row, and the per-chunk aggregation (and ``render_txt`` after it) is
    clustered by a superset of the key.  A transcript is one output value,
    so it is one task's unit here."""
    keys = list(keys)
    extra = [chunk_num] if isinstance(chunk_num, str) else []
    n_seg = F.col(chunk_num) if isinstance(chunk_num, str) else F.lit(chunk_num)
    t = turns.select(*keys, *extra, "pos", turn_line().alias("_block")).repartition(*keys)
    w = Window.partitionBy(*keys)
    t = (t.withColumn("n_rows", F.count(F.lit(1)).over(w))
         .withColumn("_first", F.row_number().over(w.orderBy("pos")) == 1))
    own = F.array(F.lit(-1))
    slots = F.when(F.col("_first"), F.concat(own, F.sequence(F.lit(0), n_seg - 1))).otherwise(own)
    x = t.select(*keys, *extra, "pos", "_block", "n_rows", F.explode(slots).alias("_g"))
    real = F.col("_g") == -1
    x = x.select(*keys, F.when(real, segment_of("pos", "n_rows", chunk_num)).otherwise(F.col("_g"))
                 .cast("int").alias("chunk"),
                 "pos", F.when(real, F.col("_block")).alias("_block"))
    return x.groupBy(*keys, "chunk").agg(
        F.coalesce(ordered_concat("_block", "pos", TURN_SEPARATOR), F.lit("")).alias("answer"))


def render_txt(answers: DataFrame, keys: Sequence[str] = ("run_name", "id"),
               chunked: bool = False, value_col: str = "value") -> DataFrame:
    """Answers per chunk -> one txt text per transcript: every chunk followed
    by a blank line, optionally headed ``chunk j:``."""
    keys = list(keys)
    body = F.concat(F.col("answer"), F.lit(TURN_SEPARATOR))
    if chunked:
        body = F.concat(F.lit("chunk "), F.col("chunk").cast("string"), F.lit(":\n\n"), body)
    return (answers.select(*keys, "chunk", body.alias("_piece"))
            .groupBy(*keys).agg(F.coalesce(ordered_concat("_piece", "chunk", ""), F.lit(""))
                                .alias(value_col)))


def render_gold_txt(turns: DataFrame, keys: Sequence[str] = ("id",),
                    value_col: str = "value") -> DataFrame:
    """Gold standard txt: ``speaker: text`` turns, a blank line between turns,
    no final line end."""
    keys = list(keys)
    return (turns.select(*keys, "pos", turn_line().alias("_t"))
            .groupBy(*keys).agg(ordered_concat("_t", "pos", TURN_SEPARATOR).alias(value_col)))


def _with_empty(rendered: DataFrame, transcripts: DataFrame | None, keys: list[str], value_col: str) -> DataFrame:
    """``[]`` for the transcripts that had no row to render."""
    if transcripts is None:
        return rendered
    return (transcripts.select(*keys).distinct().join(rendered, keys, "left")
            .select(*keys, F.coalesce(value_col, F.lit("[]")).alias(value_col)))


def render_json(turns: DataFrame, keys: Sequence[str] = ("run_name", "id"),
                order: Sequence[str] = ("chunk", "pos"), value_col: str = "value",
                transcripts: DataFrame | None = None) -> DataFrame:
    """Turns -> JSON array ``[{chunk, speaker, text}]`` per transcript, in order.
    ``transcripts (keys)`` names those that get ``[]`` if they have no turn."""
    keys = list(keys)
    entry = F.struct(*[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)],
                     F.struct(F.col("chunk").cast("int").alias("chunk"), "speaker", "text").alias("t"))
    arr = F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["t"])
    return _with_empty(turns.groupBy(*keys).agg(F.to_json(arr).alias(value_col)), transcripts, keys, value_col)


def render_utterances_json(utts: DataFrame, keys: Sequence[str] = ("id",),
                           value_col: str = "value", transcripts: DataFrame | None = None) -> DataFrame:
    """Utterances -> raw transcript JSON ``[{timestamp: [start, end], text}]``."""
    keys = list(keys)
    entry = F.struct(F.col("pos").alias("_o"), F.struct(
        F.array(F.col("start_s"), F.col("end_s")).alias("timestamp"), F.col("text")).alias("u"))
    arr = F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["u"])
    return _with_empty(utts.groupBy(*keys).agg(F.to_json(arr).alias(value_col)), transcripts, keys, value_col)


def render_chunked_json(utts: DataFrame, chunk_num: int, keys: Sequence[str] = ("id",),
                        value_col: str = "value") -> DataFrame:
    """Raw utterances -> the chunked JSON of the raw-transcript mode: for one
    chunk the bare utterance array, otherwise ``{"chunk 0": [...], ...}`` with
    every chunk (empty ones as ``[]``) in chunk order.  ``utts`` carries
    ``pos, start_s, end_s, text`` and, optionally, ``n_rows``."""
    keys = list(keys)
    if chunk_num == 1:
        return render_utterances_json(utts, keys, value_col)
    if "n_rows" not in utts.columns:
        counts = utts.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
        utts = utts.join(counts, keys)
    rows = utts.withColumn("chunk", segment_of("pos", "n_rows", chunk_num))
    entry = F.struct(F.col("pos").alias("_o"), F.struct(
        F.array(F.col("start_s"), F.col("end_s")).alias("timestamp"), F.col("text")).alias("u"))
    per_chunk = rows.groupBy(*keys, "chunk").agg(
        F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["u"]).alias("arr"))
    slots = (utts.select(*keys).distinct()
             .select(*keys, F.explode(F.sequence(F.lit(0), F.lit(chunk_num - 1))).alias("chunk")))
    full = slots.join(per_chunk, keys + ["chunk"], "left")
    item = F.struct(F.col("chunk").alias("_o"), F.concat(F.lit("chunk "), F.col("chunk").cast("string")).alias("k"),
                    F.coalesce("arr", F.array().cast(per_chunk.schema["arr"].dataType)).alias("v"))
    pairs = F.transform(F.array_sort(F.collect_list(item)), lambda e: F.struct(e["k"], e["v"]))
    return full.groupBy(*keys).agg(F.to_json(F.map_from_entries(pairs)).alias(value_col))


def render_sentences_json(sentences: DataFrame, keys: Sequence[str] = ("id",),
                          value_col: str = "value", transcripts: DataFrame | None = None) -> DataFrame:
    """Sentence rows ``(keys, pos, sentence)`` -> the utterance JSON a raw
    transcript file holds: ``[{"text": sentence}, ...]`` in order."""
    keys = list(keys)
    entry = F.struct(F.col("pos").alias("_o"), F.struct(F.col("sentence").alias("text")).alias("u"))
    arr = F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["u"])
    return _with_empty(sentences.groupBy(*keys).agg(F.to_json(arr).alias(value_col)), transcripts, keys, value_col)


def write_transcripts(df: DataFrame, path: str, value_col: str = "value",
                      mode: str = "overwrite") -> None:
    """Rendered transcripts as a parquet table ``(run_name, id, value)``
    partitioned by run: one row per transcript, any size of text, readable by
    every decoder (they take ``(keys, value)`` frames)."""
    cols = [c for c in ("run_name",) if c in df.columns]
    df.write.mode(mode).partitionBy(*cols).parquet(path)


def write_score_files(payload: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Score-file texts from ``score_file_payload`` as files
    ``<path>/run_name=<run>/shard=<k>/part-*.txt``, byte for byte."""
    export_files(payload, path, keys=("run_name", "shard"), mode=mode)


def export_files(df: DataFrame, path: str, keys: Sequence[str] = ("run_name", "id"),
                 value_col: str = "value", mode: str = "overwrite") -> None:
    """One text file per transcript (``<path>/run_name=../id=../part-*.txt``)
    for tools that expect files.  The text writer ends every value with a line
    end, so one trailing line end is taken off first: a value that ends with
    one is written byte for byte, one that does not gains a final line end
    (which reads back to the same lines)."""
    keys = [k for k in keys if k in df.columns]
    body = F.regexp_replace(F.col(value_col), r"\n\z", "")
    df.select(*keys, body.alias(value_col)).write.mode(mode).partitionBy(*keys).text(path)


def write_json_and_txt(txt: DataFrame, js: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Both formats side by side, as files under ``path/text`` and ``path/json``
    that ``decoders.read_exported`` and ``jobs.score_runs`` read."""
    export_files(txt, f"{path}/text", mode=mode)
    export_files(js, f"{path}/json", mode=mode)


def write_scores(scores: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The score table as parquet partitioned by run (the scalable store)."""
    scores.write.mode(mode).partitionBy("run_name").parquet(path)


def score_file_payload(tall: DataFrame, shards: int | None = None) -> DataFrame:
    """Tall scores ``(run_name, family, metric, id, segment, score)`` -> score-file
    JSON texts ``[ids, {family: {metric: {id: {segment: score}}}}]``.

    Built bottom-up with map aggregations (segment -> id -> metric -> family),
    each a partial-aggregatable collect.  ``shards > 1`` splits a run's file by
    a hash of the id into that many valid score files (``run_name``, ``shard``);
    the decoder reads a directory of them as one table.  By default each run has
    as many shards as keep about ``IDS_PER_SHARD`` ids in a file, so no value
    grows with the run; ``shards=1`` is one file per run (the original layout)."""
    if shards is None:
        sizes = tall.groupBy("run_name").agg(F.approx_count_distinct("id").alias("_ids"))
        tall = tall.join(sizes, "run_name")
        shard = F.pmod(F.xxhash64("id"), F.ceil(F.col("_ids") / IDS_PER_SHARD).cast("long"))
    else:
        shard = F.pmod(F.xxhash64("id"), F.lit(shards)) if shards > 1 else F.lit(0)
    t = tall.withColumn("shard", shard.cast("int"))
    k = ["run_name", "shard"]
    lvl1 = (t.groupBy(*k, "family", "metric", "id")
            .agg(F.map_from_entries(F.collect_list(F.struct(F.col("segment").cast("string"),
                                                             F.col("score")))).alias("m")))
    lvl2 = (lvl1.groupBy(*k, "family", "metric")
            .agg(F.map_from_entries(F.collect_list(F.struct("id", "m"))).alias("m")))
    lvl3 = (lvl2.groupBy(*k, "family")
            .agg(F.map_from_entries(F.collect_list(F.struct("metric", "m"))).alias("m")))
    lvl4 = lvl3.groupBy(*k).agg(F.map_from_entries(F.collect_list(F.struct("family", "m")))
                                .alias("m"))
    # the id list comes from the first level (already one row per id and
    # metric), so the scored input is read once: a second read of ``tall``
    # would recompute everything above its last exchange (the kernels)
    ids = (lvl1.select(*k, "id").distinct().groupBy(*k)
           .agg(F.array_sort(F.collect_list("id")).alias("ids")))
    return (lvl4.join(ids, k)
            .select(*k, F.concat(F.lit("["), F.to_json("ids"), F.lit(","),
                                 F.to_json("m"), F.lit("]")).alias("value")))
