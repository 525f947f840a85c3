"""Column expressions for transcript text shaping.

Everything here returns a ``Column`` built from built-in Spark functions, so it
stays inside whole-stage codegen.  No Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values ---------------------------------------------------------
# Python's ``str.split()`` whitespace: Unicode White_Space plus the four
# information separators U+001C..U+001F.  Java's \s under (?U) is White_Space.
WHITESPACE_RUN = r"(?U)[\x1c-\x1f\s]+"
# Canonical speaker names and the substrings that select them, checked in this
# order (a label naming both ends up as Student).
STUDENT, PATIENT, UNKNOWN = "Student", "Patient", "Unknown"
# The label every speaker becomes in the reference-exact (literal) mode.
LITERAL_SPEAKER = "Student"
# Formatting marks tolerated around a label (bold / italics / headings).
LABEL_MARKS = r"[*_#]"
# --------------------------------------------------------------------------


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def collapse_ws(c) -> Column:
    """``" ".join(s.split())``: one space between words, none at the ends."""
    return F.trim(F.regexp_replace(col_(c), WHITESPACE_RUN, " "))


def strip_first_token(line) -> Column:
    """Drop the first space-separated token of a line, keep the rest from the
    first space on (``' '.join(line.split(' ')[1:])`` with its leading space).
    A line without a space vanishes; a line starting with a space keeps all."""
    return F.regexp_replace(col_(line), r"^[^ ]*", "")


def colon_index(line) -> Column:
    """1-based position of the first colon, 0 when there is none."""
    return F.instr(col_(line), ":")


def label_of(line) -> Column:
    """Text before the first colon (untrimmed); NULL when there is no colon."""
    line = col_(line)
    idx = colon_index(line)
    return F.when(idx > 0, line.substr(F.lit(1), idx - 1))


def text_after_label(line) -> Column:
    """Text after the first colon (untrimmed); the whole line without one."""
    line = col_(line)
    idx = colon_index(line)
    return F.when(idx > 0, line.substr(idx + 1, F.length(line) + 1)).otherwise(line)


def canonical_speaker(speaker) -> Column:
    """Student / Patient by substring (any case, marks tolerated); any other
    label is kept, stripped of marks and capitalised; NULL stays NULL."""
    sp = col_(speaker)
    low = F.lower(sp)
    bare = F.trim(F.regexp_replace(sp, LABEL_MARKS, ""))
    other = F.concat(F.upper(bare.substr(1, 1)), F.lower(bare.substr(F.lit(2), F.length(bare) + 1)))
    return (F.when(sp.isNull(), F.lit(None).cast("string"))
            .when(low.contains("student"), F.lit(STUDENT))
            .when(low.contains("patient"), F.lit(PATIENT))
            .otherwise(other))


def split_lines(value) -> Column:
    """Physical lines of a whole text, as ``readlines`` yields them minus the
    line ends: an empty text has no lines, a final line end opens none.

    CR LF and CR become LF first (only when a CR occurs), one final line end
    is cut off with a substring, and the split is on the literal LF: a
    single-character split takes the JVM's fast path, where a three-way
    newline regex would run the regex engine over every text."""
    value = col_(value)
    norm = F.when(value.contains("\r"), F.regexp_replace(value, "\r\n?", "\n")).otherwise(value)
    body = F.when(norm.endswith("\n"), norm.substr(F.lit(1), F.length(norm) - 1)).otherwise(norm)
    return F.when(value == "", F.array().cast("array<string>")).otherwise(F.split(body, "\n", -1))


def ordered_concat(value, order, sep: str = "") -> Column:
    """Aggregate: ``value`` strings joined by ``sep`` in ``order`` order.

    ``string_agg ... WITHIN GROUP`` is a partial-aggregatable collect: it
    combines map-side before the shuffle.  NULL values are skipped."""
    v = value if isinstance(value, str) else None
    o = order if isinstance(order, str) else None
    if v is None or o is None:
        raise TypeError("ordered_concat takes column names")
    sep_sql = sep.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n")
    return F.expr(f"string_agg(`{v}`, '{sep_sql}') WITHIN GROUP (ORDER BY `{o}`)")
