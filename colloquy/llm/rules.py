"""Quality rules as a learned decision list.

``features`` counts, per whole text, what the rules may test.  ``learn`` grows
an ordered list of threshold conjunctions by sequential covering: a rule gains
one condition at a time (best information gain over the rows not yet covered),
is cut back on rows it was not grown on, and is kept while it is precise there;
the rows it covers leave the training set and the next rule starts.  ``verdict``
turns the list into one ordered Spark ``CASE WHEN`` expression, so judging is
an ordinary projection.

Rows that fail the fixed base rules teach nothing.  The list is learnt from at most ``max_rows`` labelled rows (those with the
smallest hash of their id); counts and verdicts cover every row.  Null text has
no words and no lines.  Labels other than 0 and 1 and labels without an id are
ignored; repeated labels of an id count as the worst.  Without both kinds of
label the list is empty and every row is kept.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.llm.common import fresh, ship, text_bytes, windows_of, word_hashes

_SPACE = b" \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_upper", "n_bangs", "n_echoes")
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
MAX_ROWS = 8000


def _without(text: bytes, drop: bytes) -> int:
    return len(text) - len(text.translate(None, drop))


def count_one(text: bytes) -> tuple[int, ...]:
    """The COUNTS of one text.

    n_dup_lines: lines with a word that equal an earlier line.  n_repeat_words:
    words inside some run of eight words that the text has more than once.
    n_echoes: words equal to the word before."""
    words = text.split()
    chars = len(text) if text.isascii() else len(text.decode())
    seen: set[bytes] = set()
    dup = lines = 0
    for line in text.split(b"\n"):
        if line.strip(_SPACE):
            lines += 1
            dup += line in seen
            seen.add(line)
    repeated = 0
    if len(words) >= WINDOW:
        runs = windows_of(word_hashes(words), WINDOW)
        ordered = np.sort(runs)
        again = ordered[1:][ordered[1:] == ordered[:-1]]
        if len(again):
            starts = np.flatnonzero(np.isin(runs, again))
            edge = np.zeros(len(words) + 1, np.int64)
            np.add.at(edge, starts, 1)
            np.add.at(edge, starts + WINDOW, -1)
            repeated = int(np.count_nonzero(np.cumsum(edge)))
    return (len(words), chars - _without(text, _SPACE), _without(text, _SYMBOLS), dup, repeated,
            lines, _without(text, _UPPER), _without(text, b"!"), sum(map(eq, words, words[1:])))


def features(df: DataFrame, text_col: str = "text", out_col: str = "counts") -> DataFrame:
    """``df`` with a struct of COUNTS (long) of every whole text."""
    ship(df.sparkSession)

    @F.arrow_udf("struct<" + ",".join(f"{c}:bigint" for c in COUNTS) + ">")
    def count(texts: pa.Array) -> pa.Array:
        rows = np.array([count_one(t) for t in text_bytes(texts)], np.int64).reshape(-1, len(COUNTS))
        return pa.StructArray.from_arrays([pa.array(rows[:, k]) for k in range(len(COUNTS))], list(COUNTS))

    return df.withColumn(out_col, count.asNondeterministic()(F.col(text_col)))


def ratios(c: Column) -> dict[str, Column]:
    """What a rule may test, from the counts."""
    words, chars = F.greatest(c["n_words"], F.lit(1)), F.greatest(c["word_chars"], F.lit(1))
    return {
        "n_words": c["n_words"].cast("double"),
        "mean_word": c["word_chars"] / words,
        "symbols_per_word": c["n_symbols"] / words,
        "bangs_per_word": c["n_bangs"] / words,
        "upper_share": c["n_upper"] / chars,
        "dup_line_share": c["n_dup_lines"] / F.greatest(c["n_lines"], F.lit(1)),
        "repeat_share": c["n_repeat_words"] / words,
        "echo_share": c["n_echoes"] / words,
        "words_per_line": c["n_words"] / F.greatest(c["n_lines"], F.lit(1)),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool          # feature > threshold, else feature <= threshold
    threshold: float

    def holds(self, value):
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


DecisionList = list[tuple[Condition, ...]]  # each rule rejects; the rest is kept


def _covers(rule, x: dict[str, np.ndarray]) -> np.ndarray:
    out = np.ones(len(next(iter(x.values()))), bool)
    for c in rule:
        out &= c.holds(x[c.feature])
    return out


def _gain(p0: float, n0: float, p: np.ndarray, n: np.ndarray) -> np.ndarray:
    """First-order information gain of narrowing (p0, n0) to (p, n)."""
    with np.errstate(divide="ignore", invalid="ignore"):
        g = p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0)))
    return np.where(p > 0, g, -np.inf)


def _cuts(v: np.ndarray, y: np.ndarray, cuts: int) -> np.ndarray:
    """Values to cut after: quantiles of all rows and of the bad ones, and the
    values just below the latter, so that a rare extreme is not missed."""
    at = np.linspace(0, 1, cuts)
    values = np.unique(v)
    some = np.quantile(v[y], at, method="lower")
    below = values[np.maximum(np.searchsorted(values, some) - 1, 0)]
    return np.setdiff1d(np.concatenate([np.quantile(v, at, method="lower"), some, below]), values[-1:])


def _grow(x: dict[str, np.ndarray], bad: np.ndarray, max_conditions: int, cuts: int) -> list[Condition]:
    rule: list[Condition] = []
    inside = np.ones(len(bad), bool)
    while len(rule) < max_conditions and (inside & ~bad).any() and (inside & bad).any():
        best, choice = 1e-9, None
        p0, n0 = (inside & bad).sum(), (inside & ~bad).sum()
        for name, values in x.items():
            v, y = values[inside], bad[inside]
            for t in _cuts(v, y, cuts):
                for above in (True, False):
                    hit = v > t if above else v <= t
                    g = float(_gain(p0, n0, np.float64((hit & y).sum()), np.float64((hit & ~y).sum())))
                    if g > best:
                        # half way to the next value that occurs
                        best, choice = g, Condition(name, above, float((t + v[v > t].min()) / 2))
        if choice is None:
            break
        rule.append(choice)
        inside &= choice.holds(x[choice.feature])
    return rule


def _worth(rule, x, bad) -> float:
    hit = _covers(rule, x)
    p, n = (hit & bad).sum(), (hit & ~bad).sum()
    return (p - n) / (p + n) if p + n else -1.0


def learn_arrays(x: dict[str, np.ndarray], bad: np.ndarray, hold: np.ndarray, min_precision: float = 0.95,
                 min_cover: int = 8, max_rules: int = 12, max_conditions: int = 4, cuts: int = 33) -> DecisionList:
    """Sequential covering.  ``hold`` marks the rows kept for pruning; a rule
    must cover ``min_cover`` bad rows in all and be precise on the held ones."""
    out: DecisionList = []
    left = np.ones(len(bad), bool)
    pick = lambda mask: {k: v[mask] for k, v in x.items()}
    while len(out) < max_rules and (left & ~hold & bad).sum() >= 3:
        rule = _grow(pick(left & ~hold), bad[left & ~hold], max_conditions, cuts)
        pruning = left & hold
        rule = max((rule[:k] for k in range(len(rule), 0, -1)),
                   key=lambda r: _worth(r, pick(pruning), bad[pruning]), default=[])
        if not rule:
            break
        hit = _covers(rule, x) & left
        p, n = (hit & hold & bad).sum(), (hit & hold & ~bad).sum()
        if p == 0 or p / (p + n) < min_precision or (hit & bad).sum() < min_cover:
            break
        out.append(tuple(rule))
        left &= ~hit
    return out


def learn(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", max_rows: int = MAX_ROWS, **settings) -> DecisionList:
    """A decision list that rejects what ``label_col`` marks 0."""
    truth = (labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("y"))
             .filter("id IS NOT NULL AND y IN (0, 1)").groupBy("id").agg(F.min("y").alias("y"))
             .orderBy(F.xxhash64("id"), "id").limit(max_rows))
    # the sample is max_rows small rows at most, so it may be broadcast
    rows = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = features(rows.join(F.broadcast(truth), "id")).filter(~base_failed(F.col("counts")))
    got = (found.select("id", "y", *(v.alias(k) for k, v in ratios(F.col("counts")).items()),
                        (F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(3)) == 0).alias("hold"))
           .toPandas())
    if got.empty or got["y"].nunique() < 2:
        return []
    got = got.sort_values([*got.columns])
    names = [c for c in got.columns if c not in ("id", "y", "hold")]
    return learn_arrays({c: got[c].to_numpy(float) for c in names}, (got["y"] == 0).to_numpy(),
                        got["hold"].to_numpy(bool), **settings)


def verdict(rules: DecisionList, counts: Column) -> tuple[Column, Column]:
    """(kept, number of the first rule that fires or null) as CASE WHEN."""
    values = ratios(counts)
    kept, fired = F.lit(True), F.lit(None).cast("int")
    for k, rule in reversed(list(enumerate(rules))):
        cond = F.lit(True)
        for c in rule:
            cond = cond & c.holds(values[c.feature])
        kept, fired = F.when(cond, False).otherwise(kept), F.when(cond, k).otherwise(fired)
    return kept, fired


def base_failed(counts: Column) -> Column:
    return ((counts["n_words"] < MIN_WORDS)
            | (100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * counts["n_words"]))


def filter_documents(docs: DataFrame, rules: DecisionList, text_col: str = "text") -> DataFrame:
    """The rows that pass the base rules and the list; columns as they were."""
    counts = fresh(docs, "_counts")
    found = features(docs, text_col, counts)
    kept, _ = verdict(rules, F.col(counts))
    return found.filter(~base_failed(F.col(counts)) & kept).drop(counts)


def op10_quality_rules(documents: DataFrame, labels: DataFrame) -> DataFrame:
    rules = learn(documents, labels)
    found = features(documents.select("doc_id", "text"))
    c = F.col("counts")
    kept, fired = verdict(rules, c)
    return found.select("doc_id", *(c[n].alias(n) for n in COUNTS[:5]),
                        base_failed(c).alias("base_failed"), (~base_failed(c) & kept).alias("kept"),
                        fired.alias("rule_no"))
