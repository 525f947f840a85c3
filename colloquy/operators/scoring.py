"""Scoring of labelled transcripts (preservation, no-label baseline, accuracy).

Per (run, id, segment):

* preservation  = sim(raw text, bare prediction)
* baseline      = sim(bare prediction, labelled gold)
* accuracy      = sim(labelled gold, labelled prediction)
* normed        = (accuracy - baseline) / (1 - baseline)   (NULL when baseline = 1)
* composite     = (lev_acc + diff_acc) / 2, likewise for the normed pair

for ``sim`` in {normalised Levenshtein, diff ratio}.  Argument order is part of
the definition (the diff ratio is not symmetric).

All inputs are clustered on (id, segment) by ``segments.cluster_by_segment``
with the same partition count, so the joins below are co-partitioned sort-merge
(or AQE broadcast) joins without another exchange.

The kernels run once per distinct pair of texts.  Every row names its pairs by
128-bit hashes; the pairs are grouped by hash with a map-side combine (copies
from many runs and transcripts become one row), scored, and joined back by
hash.  A pair that very many rows share is one kernel call, and its rows are
dealt over ``SALTS`` join keys.  Pairs that need no kernel (equal texts, an
empty side, a missing side) are settled in the JVM and join nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.functions.similarity import diff_ratio, lev_similarity, normed_gain
from colloquy.session import work_parallelism

METRICS = ("levenshtein", "diff")
FAMILIES = ("preservation", "accuracy")
SCORE_COLUMNS = ("lev_pres", "diff_pres", "lev_acc", "lev_acc_normed", "diff_acc",
                 "diff_acc_normed", "composite", "composite_normed", "lev_baseline",
                 "diff_baseline")
PREFIX = {"levenshtein": "lev", "diff": "diff"}


# join keys that the rows of one pair are dealt over
SALTS = 8


def _settled(a: Column, b: Column) -> Column:
    """Similarity, the same in both metrics, of pairs that need no kernel; NULL
    where a side is missing, whatever the other is."""
    return F.when(a == b, F.lit(1.0)).when((F.length(a) == 0) & b.isNotNull() | (F.length(b) == 0) & a.isNotNull(),
                                           F.lit(0.0))


def _pair(name: str, a: Column, b: Column, row: Sequence[Column]) -> Column:
    """struct(name, settled, h1, h2, salt, a, b); the texts and h2 are NULL where
    no kernel is needed, and h1 then only spreads the rows."""
    open_ = a.isNotNull() & b.isNotNull() & _settled(a, b).isNull()
    return F.struct(F.lit(name).alias("name"), _settled(a, b).alias("settled"),
                    F.when(open_, F.xxhash64(a, b)).otherwise(F.xxhash64(*row)).alias("h1"),
                    F.when(open_, F.xxhash64(F.lit(1), b, a)).alias("h2"),
                    F.pmod(F.xxhash64(*row), F.lit(SALTS)).cast("int").alias("salt"),
                    F.when(open_, a).alias("a"), F.when(open_, b).alias("b"))


def score_pairs(pairs: DataFrame, metrics: Sequence[str] = METRICS, autojunk: bool = True) -> DataFrame:
    """``pairs (h1, h2, a, b)``, repeated at will -> ``(h1, h2, <metric>...)``,
    each distinct pair scored once; rows without texts are left out."""
    once = (pairs.where(F.col("h2").isNotNull()).groupBy("h1", "h2")
            .agg(F.first("a").alias("a"), F.first("b").alias("b")))
    # by work, not by bytes: the kernels cost time per character pair
    spread = once.repartition(work_parallelism(pairs.sparkSession), "h1", "h2")
    kernel = {"levenshtein": lambda: lev_similarity("a", "b"), "diff": lambda: diff_ratio("a", "b", autojunk=autojunk)}
    return spread.select("h1", "h2", *[kernel[m]().alias(m) for m in metrics])


def score_segments(pred: DataFrame, gold: DataFrame | None = None, raw: DataFrame | None = None,
                   metrics: Sequence[str] = METRICS, families: Sequence[str] = FAMILIES,
                   keys: Sequence[str] = ("run_name",), autojunk: bool = True) -> DataFrame:
    """``pred (keys, id, segment, labelled, bare)``, ``gold (id, segment, labelled)``,
    ``raw (id, segment, text)`` -> one row per pred segment with the score
    columns the metric/family switches ask for (disabled ones are not built)."""
    for m in metrics:
        if m not in METRICS:
            raise ValueError(f"unknown metric {m!r}")
    keys = list(keys)
    df = pred.alias("p")
    want_pres = "preservation" in families
    want_acc = "accuracy" in families
    if want_pres:
        if raw is None:
            raise ValueError("preservation needs the raw side")
        df = df.join(raw.select("id", "segment", F.col("text").alias("_raw")).alias("r"),
                     ["id", "segment"], "left")
    if want_acc:
        if gold is None:
            raise ValueError("accuracy needs the gold side")
        df = df.join(gold.select("id", "segment", F.col("labelled").alias("_gold")).alias("g"),
                     ["id", "segment"], "left")
    row = [*keys, "id", "segment"]
    texts = {"pres": ("_raw", "p.bare"), "baseline": ("p.bare", "_gold"), "acc": ("_gold", "p.labelled")}
    names = ["pres"] * want_pres + ["baseline", "acc"] * want_acc
    if not names or not metrics:
        return df.select(*row)
    pairs = df.select(*row, F.explode(F.array(*[
        _pair(n, F.col(texts[n][0]), F.col(texts[n][1]), [F.col(c) for c in row]) for n in names])).alias("_p"))
    known = score_pairs(pairs.select("_p.h1", "_p.h2", "_p.a", "_p.b"), metrics, autojunk).withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    tall = pairs.select(*row, "_p.name", "_p.settled", "_p.h1", "_p.h2", "_p.salt").join(known, ["h1", "h2", "salt"], "left")
    scored = tall.groupBy(*row).agg(*[
        F.max(F.when(F.col("name") == n, F.coalesce("settled", m))).alias(f"{PREFIX[m]}_{n}")
        for m in metrics for n in names])
    if want_acc:
        for m in metrics:
            pre = PREFIX[m]
            scored = scored.withColumn(f"{pre}_acc_normed",
                                       normed_gain(f"{pre}_acc", f"{pre}_baseline"))
        if set(metrics) == set(METRICS):
            scored = composite(scored)
    return scored


def composite(scores: DataFrame) -> DataFrame:
    """Add ``composite`` and ``composite_normed`` (mean of the two metrics)."""
    return (scores
            .withColumn("composite", (F.col("lev_acc") + F.col("diff_acc")) / 2)
            .withColumn("composite_normed", (F.col("lev_acc_normed") + F.col("diff_acc_normed")) / 2))


def ordered_score_columns(df: DataFrame, keys: Sequence[str] = ("run_name", "id", "segment")) -> DataFrame:
    """Keys first, then the score columns present, in the wide-table order."""
    present = [c for c in SCORE_COLUMNS if c in df.columns]
    return df.select(*keys, *present)


def to_tall(scores: DataFrame, keys: Sequence[str] = ("run_name", "id", "segment")) -> DataFrame:
    """Wide score columns -> ``(keys, family, metric, score)`` rows, named as in
    the score-file format (family preservation / accuracy / nolabel_baseline)."""
    names = {
        "lev_pres": ("preservation", "levenshtein"), "diff_pres": ("preservation", "diff"),
        "lev_acc": ("accuracy", "levenshtein"), "diff_acc": ("accuracy", "diff"),
        "lev_acc_normed": ("accuracy", "levenshtein_baseline_normed"),
        "diff_acc_normed": ("accuracy", "diff_baseline_normed"),
        "lev_baseline": ("nolabel_baseline", "levenshtein"),
        "diff_baseline": ("nolabel_baseline", "diff"),
    }
    present = [c for c in names if c in scores.columns]
    entries = F.array(*[F.struct(F.lit(names[c][0]).alias("family"),
                                 F.lit(names[c][1]).alias("metric"),
                                 F.col(c).cast("double").alias("score")) for c in present])
    return (scores.select(*keys, F.explode(entries).alias("_e"))
            .select(*keys, "_e.family", "_e.metric", "_e.score"))
