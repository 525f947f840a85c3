"""Sentence split of plain transcripts into utterance rows.

Rule-based and written with built-in regular expressions, so it runs in the
JVM per row: abbreviations are protected, a sentence ends at ``.``, ``!`` or
``?`` (a run of them) followed by whitespace, pieces are trimmed and empty
pieces dropped.  Not identical to a trained sentence model; the rule and the
abbreviation list are the definition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values ---------------------------------------------------------
ABBREVIATIONS = ("Mr", "Mrs", "Ms", "Dr", "Prof", "Sr", "Jr", "St", "vs", "etc", "e.g", "i.e")
PROTECT = "\ue000"   # stands in for the dot of an abbreviation
BREAK = "\ue001"     # marks a sentence end
SPACE = r"[ \t\n\r\f\x0B]"
SENTENCE_END = r"([.!?]+)" + SPACE + "+"
# --------------------------------------------------------------------------


def abbreviation_pattern() -> str:
    alts = "|".join(a.replace(".", r"\.") for a in ABBREVIATIONS)
    # an explicit ASCII boundary instead of \b: the same in every regex engine
    return r"(^|[^A-Za-z])(" + alts + r")\."


def sentences(docs: DataFrame, keys: Sequence[str] = ("id",), text_col: str = "text") -> DataFrame:
    """``(keys, text)`` -> ``(keys, pos, sentence)``; pos is 0-based."""
    keys = list(keys)
    protected = F.regexp_replace(F.col(text_col), abbreviation_pattern(), "$1$2" + PROTECT)
    marked = F.regexp_replace(protected, SENTENCE_END, "$1" + BREAK)
    parts = F.split(marked, BREAK, -1)
    edge_space = "^" + SPACE + "+|" + SPACE + "+$"
    cleaned = F.filter(
        F.transform(parts, lambda p: F.regexp_replace(F.replace(p, F.lit(PROTECT), F.lit(".")),
                                                      F.lit(edge_space), F.lit(""))),
        lambda p: F.length(p) > 0)
    return (docs.select(*keys, F.posexplode(cleaned).alias("pos", "sentence")))
