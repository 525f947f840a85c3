"""Labelled transcript -> per-segment ``labelled`` and ``bare`` texts.

Consolidation merges consecutive turns of one speaker inside a segment (it
restarts at every segment start).  Instead of numbering islands (lag + running
sum + group + second aggregation) the labelled text is built in one ordered
concatenation: a row that starts an island contributes ``speaker:text``, any
other row just ``text``.  The only window is ``lag`` (plus ``last`` for
inherited speakers) over the same (keys, segment) partition the aggregation
uses, so window and aggregation share one exchange.

Two label modes:

``canonical`` (default, the evident intent)
    speakers normalised (Student / Patient / other capitalised), blank lines
    dropped after segmentation, an unlabelled line continues the previous
    speaker of its segment (``Unknown`` at a segment start), pieces joined by
    one space.
``literal`` (reference-exact)
    every speaker becomes ``Student``; one island per segment; txt pieces keep
    their line breaks (blank lines included), JSON pieces are glued together.

``bare`` is the text with labels removed: txt lines lose their first
space-separated token, JSON turns contribute their ``text``; both collapsed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from colloquy.functions.text import (LITERAL_SPEAKER, UNKNOWN, canonical_speaker, collapse_ws,
                                     colon_index, label_of, ordered_concat, strip_first_token,
                                     text_after_label)
from colloquy.operators.segments import (assign_segments, cluster_by_segment, opens_segment, pad_with_grid,
                                         padded_segments, segment_of)

LABEL_MODES = ("canonical", "literal")
STRIP_MODES = ("first_token", "label")


def _island_pieces(rows: DataFrame, part: Sequence[str], speaker_col: str, text_col: str) -> DataFrame:
    """Add ``_piece``: ``speaker:text`` at an island start, ``text`` elsewhere.

    An unlabelled row (NULL speaker) continues the previous speaker of its
    segment, ``Unknown`` at a segment start.  Grid placeholder rows (NULL
    ``pos``) sort first and carry a NULL speaker, so they never join an island."""
    w = Window.partitionBy(*part).orderBy("pos")
    filled = F.last(speaker_col, ignorenulls=True).over(
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = rows.withColumn("_spk", F.when(F.col("pos").isNotNull(),
                                          F.coalesce(filled, F.lit(UNKNOWN))))
    prev = F.lag("_spk").over(w)
    starts = prev.isNull() | (prev != F.col("_spk"))
    return rows.withColumn(
        "_piece", F.when(starts, F.concat(F.col("_spk"), F.lit(":"), F.col(text_col)))
        .otherwise(F.col(text_col)))


def _segment_texts(rows: DataFrame, transcripts: DataFrame | None, n_segments, keys: list[str],
                   label_mode: str, labelled_sep: str, literal_sep: str,
                   with_labelled: bool, with_bare: bool) -> DataFrame:
    """Shared tail: pad the grid of ``transcripts`` (None: ``rows`` are padded),
    one exchange on (id, segment), island pieces, one ordered aggregation per
    (keys, segment)."""
    part = keys + ["segment"]
    if transcripts is not None:
        rows = pad_with_grid(rows, transcripts.select(*keys), n_segments, keys)
    rows = cluster_by_segment(rows)
    aggs = []
    if with_labelled:
        if label_mode == "canonical":
            rows = _island_pieces(rows, part, "_sp", "_tx")
            lab = ordered_concat("_piece", "pos", labelled_sep)
        else:
            lab = F.concat(F.lit(LITERAL_SPEAKER + ":"), ordered_concat("_tx", "pos", literal_sep))
        aggs.append(F.coalesce(lab, F.lit("")).alias("_l"))
    if with_bare:
        aggs.append(F.coalesce(ordered_concat("_bare", "pos", ""), F.lit("")).alias("_b"))
    agg = rows.groupBy(*part).agg(*aggs)
    out_cols = []
    if with_labelled:
        out_cols.append(collapse_ws("_l").alias("labelled"))
    if with_bare:
        out_cols.append(collapse_ws("_b").alias("bare"))
    return agg.select(*part, *out_cols)


def turn_numbers(lines: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number the turns of labelled txt lines: a turn starts at a non-blank
    line with a colon; continuation and blank lines belong to the turn before
    them (lines before the first label to turn 0).  Adds ``turn`` and
    ``n_turns``.  The windows span one file, which one task reads anyway."""
    keys = list(keys)
    starts = ((colon_index("line") > 0) & (F.length(collapse_ws("line")) > 0)).cast("int")
    file_w = Window.partitionBy(*keys)
    run_w = file_w.orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = lines.withColumn("_start", starts)
    return (rows.withColumn("turn", F.greatest(F.sum("_start").over(run_w) - 1, F.lit(0)))
            .withColumn("n_turns", F.coalesce(F.sum("_start").over(file_w), F.lit(0)).cast("long"))
            .drop("_start"))


def segment_texts_from_lines(lines: DataFrame, n_segments, keys: Sequence[str],
                             transcripts: DataFrame | None = None, label_mode: str = "canonical",
                             with_labelled: bool = True, with_bare: bool = True,
                             segment_by: str = "line", strip_mode: str = "first_token") -> DataFrame:
    """Physical lines ``(keys, pos, line[, n_rows])`` -> ``(keys, segment, labelled, bare)``.

    ``transcripts`` lists every (keys) file, so files with no lines still get
    their (empty) segments.  Without it, ``lines`` hold a row of NULL ``pos`` for
    these (``decode_lines(keep_empty=True)``) and nothing is read twice.  ``segment_by='line'`` cuts by physical lines,
    blank ones included (the reference's rule); ``'turn'`` cuts by turns, so
    segment borders agree with a side segmented by utterance or JSON turn.
    ``strip_mode='first_token'`` takes the first word of every line for a label
    (the reference's rule); ``'label'`` takes what stands before a colon, and
    nothing from lines that continue a turn."""
    if strip_mode not in STRIP_MODES:
        raise ValueError(f"strip_mode must be one of {STRIP_MODES}")
    if label_mode not in LABEL_MODES:
        raise ValueError(f"label_mode must be one of {LABEL_MODES}")
    keys = list(keys)
    if segment_by == "turn":
        cut = ("turn", "n_turns")
        rows = turn_numbers(lines.select(*keys, "pos", "line"), keys)
        rows = (padded_segments(rows, n_segments, ["line"], *cut) if transcripts is None
                else rows.withColumn("segment", segment_of(*cut, n_segments)))
    elif segment_by == "line":
        cut = ("pos", "n_rows")
        rows = (padded_segments(lines, n_segments, ["line"], *cut) if transcripts is None
                else assign_segments(lines, n_segments, keys))
    else:
        raise ValueError("segment_by must be line or turn")
    filled = F.length(collapse_ws("line")) > 0
    if with_labelled and label_mode == "canonical" and transcripts is None:
        # a blank line stays only where it may be all that its segment has, as a placeholder
        rows = (rows.where(filled | opens_segment(n_segments, *cut))
                .withColumns({c: F.when(filled, F.col(c)) for c in ("pos", "line")}))
    rows = rows.select(*keys, "segment", "pos", "line",
                       (strip_first_token("line") if strip_mode == "first_token" else
                        F.concat(F.lit(" "), text_after_label("line"))).alias("_bare"),
                       text_after_label("line").alias("_tx"),
                       canonical_speaker(label_of("line")).alias("_sp"))
    if with_labelled and label_mode == "canonical" and transcripts is not None:
        # blank lines are dropped after numbering; they carry no bare text either
        rows = rows.where(filled)
    return _segment_texts(rows.drop("line"), transcripts, n_segments, keys, label_mode,
                          " ", "\n", with_labelled, with_bare)


def segment_texts_from_turns(turns: DataFrame, n_segments, keys: Sequence[str],
                             transcripts: DataFrame | None = None, label_mode: str = "canonical",
                             with_labelled: bool = True, with_bare: bool = True) -> DataFrame:
    """Labelled JSON turns ``(keys, pos, speaker, text[, n_rows])`` ->
    ``(keys, segment, labelled, bare)``; ``transcripts`` as for the lines."""
    if label_mode not in LABEL_MODES:
        raise ValueError(f"label_mode must be one of {LABEL_MODES}")
    keys = list(keys)
    rows = (padded_segments(turns, n_segments, ["speaker", "text"]) if transcripts is None
            else assign_segments(turns, n_segments, keys))
    rows = rows.select(*keys, "segment", "pos", F.col("text").alias("_bare"),
                       F.col("text").alias("_tx"), canonical_speaker("speaker").alias("_sp"))
    return _segment_texts(rows, transcripts, n_segments, keys, label_mode,
                          " ", "", with_labelled, with_bare)
