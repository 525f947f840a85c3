"""Positional segmentation (chunks of utterances, segments of lines/turns).

A transcript of ``n`` rows cut into ``N`` parts: ``size = n div N``; part ``k``
holds positions ``[k*size, (k+1)*size)``, the last part runs to the end.  When
``size`` is 0 every row falls into part ``N-1`` and parts ``0..N-2`` are empty.
Empty parts are real rows with text ``''``: they are scored too.

Rows are never collected per transcript to do this; the part number is a
per-row expression of ``pos``, ``n`` and ``N``, and so are the empty parts: they
come from a transcript's first row (``padded_segments``), in the same pass.  ``n`` comes from the decoder
(array size) when the input is a file, or from a map-side-combined count
joined back (AQE broadcasts it when small, splits skewed keys otherwise).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.functions.text import col_, collapse_ws, ordered_concat
from colloquy.session import work_parallelism


def segment_of(pos, n_rows, n_segments) -> Column:
    """Part index of row ``pos`` in a list of ``n_rows`` cut into ``n_segments``."""
    pos, n_rows = col_(pos).cast("long"), col_(n_rows).cast("long")
    n_seg = (F.lit(n_segments) if isinstance(n_segments, int) else col_(n_segments)).cast("long")
    size = F.floor(n_rows / n_seg)
    last = n_seg - 1
    return F.when(size == 0, last).otherwise(F.least(F.floor(pos / size), last)).cast("int")


def with_row_count(rows: DataFrame, keys: Sequence[str], name: str = "n_rows") -> DataFrame:
    """Attach the number of rows per ``keys`` (partial aggregate + join back)."""
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return rows.join(counts, list(keys), "inner")


def assign_segments(rows: DataFrame, n_segments, keys: Sequence[str],
                    pos_col: str = "pos", count_col: str = "n_rows",
                    seg_col: str = "segment") -> DataFrame:
    """Add ``segment`` (0-based) to positioned rows; counts rows when needed."""
    if count_col not in rows.columns:
        rows = with_row_count(rows, keys, count_col)
    return rows.withColumn(seg_col, segment_of(pos_col, count_col, n_segments))


def padded_segments(rows: DataFrame, n_segments, value_cols: Sequence[str], unit_col: str = "pos",
                    count_col: str = "n_rows", seg_col: str = "segment") -> DataFrame:
    """Add ``segment`` to positioned rows; every segment of a transcript gets a row.

    Only a transcript with fewer rows than segments has segments without a row.
    Its row 0 (or the row with NULL ``pos`` that the decoders keep for a transcript
    of no rows) also gives a placeholder for each: NULL ``pos`` and ``value_cols``.
    No second read of the transcripts, no union, no join.  ``unit_col`` and
    ``count_col`` are what is cut: rows by default, or turns of several rows."""
    n_seg = F.lit(n_segments) if isinstance(n_segments, int) else col_(n_segments)
    own = segment_of(unit_col, count_col, n_segments)
    lone = F.col("pos").isNull() | ((F.col("pos") == 0) & (F.col(count_col) < n_seg))
    rows = rows.withColumn(seg_col, F.explode(F.when(lone, F.sequence(F.lit(0), n_seg.cast("int") - 1)).otherwise(F.array(own))))
    real = F.col(seg_col) == own
    return rows.withColumns({c: F.when(real, F.col(c)) for c in (*value_cols, "pos")})


def opens_segment(n_segments: int, unit_col: str = "pos", count_col: str = "n_rows") -> Column:
    """True for the first row of a segment and for placeholders: a filter that
    keeps these keeps every segment."""
    size = F.floor(F.col(count_col) / n_segments)
    return F.col("pos").isNull() | (F.col("pos") == 0) | (F.col(unit_col) == F.col("segment") * size)


def segment_grid(transcripts: DataFrame, n_segments, keys: Sequence[str],
                 seg_col: str = "segment") -> DataFrame:
    """Every ``(keys, segment)`` for segment 0..N-1 of every transcript."""
    n_seg = F.lit(n_segments) if isinstance(n_segments, int) else col_(n_segments)
    return transcripts.select(*keys, F.explode(F.sequence(F.lit(0), n_seg - 1)).alias(seg_col))


def pad_with_grid(rows: DataFrame, transcripts: DataFrame, n_segments,
                  keys: Sequence[str], seg_col: str = "segment") -> DataFrame:
    """Union one NULL placeholder row per (transcript, segment) into ``rows``.

    A later aggregation by (keys, segment) then yields every segment, empty
    ones included, without a join against a grid (a union, no extra shuffle).
    Placeholders carry NULL in every other column; ordered concatenation skips
    NULLs."""
    grid = segment_grid(transcripts, n_segments, keys, seg_col)
    return rows.unionByName(grid, allowMissingColumns=True)


def flatten_text(utterances: DataFrame, keys: Sequence[str], n_segments=1,
                 normalise: str = "always", pos_col: str = "pos", text_col: str = "text",
                 transcripts: DataFrame | None = None, out_col: str = "text") -> DataFrame:
    """Raw transcript text per (keys, segment): ``' ' + text`` of every utterance
    whose text is not exactly ``"\\n"``, in order.

    Without ``transcripts``, the utterances name every transcript (as the decoders
    do with ``keep_empty``) and are read once; else those of no utterance come from it.

    ``normalise='always'`` collapses whitespace; ``'literal'`` keeps the
    single-segment text uncollapsed (the reference's 1-segment raw text) and
    collapses only when ``N > 1``; ``'never'`` keeps the chunk text as the
    labelling stage sends it."""
    if "n_rows" not in utterances.columns:
        utterances = with_row_count(utterances, keys)
    rows = utterances.select(*keys, F.col(pos_col).alias("pos"), F.col(text_col).alias("_text"), "n_rows")
    if transcripts is None:
        rows = padded_segments(rows, n_segments, ["_text"])
    else:
        rows = assign_segments(rows, n_segments, keys)
    rows = rows.select(*keys, "segment", "pos",
                       F.when(F.col("_text") != "\n", F.concat(F.lit(" "), F.col("_text"))).alias("_piece"))
    if transcripts is not None:
        rows = pad_with_grid(rows, transcripts, n_segments, keys)
    if "id" in keys:
        rows = cluster_by_segment(rows)
    agg = rows.groupBy(*keys, "segment").agg(
        F.coalesce(ordered_concat("_piece", "pos"), F.lit("")).alias("_raw"),
        F.count("pos").alias("n_utterances"))
    n_seg = F.lit(n_segments) if isinstance(n_segments, int) else col_(n_segments)
    if normalise == "always":
        text = collapse_ws("_raw")
    elif normalise == "literal":
        text = F.when(n_seg > 1, collapse_ws("_raw")).otherwise(F.col("_raw"))
    elif normalise == "never":
        text = F.col("_raw")
    else:
        raise ValueError(f"normalise must be always|literal|never, not {normalise!r}")
    return agg.select(*keys, "segment", text.alias(out_col), "n_utterances")


def cluster_by_segment(rows: DataFrame) -> DataFrame:
    """One exchange for all segment-level work: hash on (id, segment) into a
    fixed, work-sized partition count.

    Every side of a transcript (each run, gold, raw) is clustered the same
    way, so windows and aggregations by (keys, segment) and the later joins on
    (id, segment) reuse this partitioning with no further shuffle; a long
    transcript is still spread over its segments.  The count is fixed (not
    left to AQE's byte-based coalescing) because the scoring kernels downstream
    cost time per character pair, not per byte."""
    spark = rows.sparkSession
    return rows.repartition(work_parallelism(spark), "id", "segment")
