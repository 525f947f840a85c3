"""Token counts attributed to sections through character offsets.

A whole text is encoded once; each token's bytes give its character span; the
spans are joined to the section intervals (a sorted interval join within the
row), so no section is ever encoded on its own.  A token that crosses a border
is allocated by an explicit rule:

``first``  the section of its first character (default),
``last``   the section of its last character,
``most``   the section with most of its bytes, of equal ones the first,
``share``  every section by its part of the token's bytes (see ``share``).

Whatever the rule, ``n_inside`` counts tokens wholly inside, ``n_crossing``
those that reach in or out, and ``share`` is the byte-weighted count; each adds
up over a text to its tokens.  Characters outside all sections are left out.
A null text counts as empty; an empty text is one empty line.

Sections may have any borders.  They are clipped to the text (a null start is
its begin, a null end its end, a null section is empty) and returned so, in the
given order.  A section whose end is not after its start is empty and counts
nothing.  The others, in order of start and of equal ones as given, end at the
latest where the next begins.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.llm.bpe import codec, default_path
from colloquy.llm.common import ship

RULES = ("first", "last", "most", "share")


def line_spans(text: str) -> list[tuple[str, int, int]]:
    """A section per line, its line break included: (number, start, end) in
    code points.  An empty text is one empty line."""
    out, at = [], 0
    lines = text.split("\n")
    for k, line in enumerate(lines):
        end = at + len(line) + (k + 1 < len(lines))
        out.append((str(k), at, end))
        at = end
    return out


def fields(columns: list[str], glue: str = "\n") -> tuple[Column, Column]:
    """(text, sections) of several columns glued into one text, each a section
    named after its column, the glue belonging to the field before it."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    sections, at = [], F.lit(0)
    for k, (name, part) in enumerate(zip(columns, parts)):
        end = at + F.length(part) + (len(glue) if k + 1 < len(columns) else 0)
        sections.append(F.struct(F.lit(name).alias("name"), at.alias("start"), end.alias("end")))
        at = end
    return F.concat_ws(glue, *parts), F.array(*sections)


def allocate(lengths: np.ndarray, starts: np.ndarray, ends: np.ndarray, rule: str):
    """Per section: tokens by the rule, wholly inside, crossing, byte share.

    ``lengths``: bytes of each token, in order; ``starts``/``ends``: the byte
    intervals of sections that are in order and do not overlap."""
    after = np.cumsum(lengths)
    before = after - lengths
    total = int(after[-1]) if len(after) else 0
    n = len(starts)
    # cut the token axis at the section borders: each cut piece has one token and one section
    cuts = np.unique(np.concatenate([before, [total], starts, ends]).clip(0, total))
    low, high = cuts[:-1], cuts[1:]
    token = np.searchsorted(after, low, "right")
    section = np.searchsorted(starts, low, "right") - 1
    # of sections that start together all but the last are empty
    inside = (section >= 0) & (low < ends[np.maximum(section, 0)]) if n else np.zeros(len(low), bool)
    token, section, size = token[inside], section[inside], (high - low)[inside]
    share = np.bincount(section, size / lengths[token], minlength=n) if n else np.zeros(0)
    whole = size == lengths[token]
    n_inside = np.bincount(section[whole], minlength=n)
    n_crossing = np.bincount(section[~whole], minlength=n)
    if rule == "share":
        return share, n_inside, n_crossing, share
    if rule == "first":
        own = before[token] == low[inside]
    elif rule == "last":
        own = after[token] == high[inside]
    else:
        order = np.lexsort((np.arange(len(token)), -size, token))
        own = np.zeros(len(token), bool)
        own[order[np.unique(token[order], return_index=True)[1]]] = True
    return np.bincount(section[own], minlength=n), n_inside, n_crossing, share


def section_bounds(sections: list, length: int) -> list[tuple[str | None, int, int]]:
    """(name, start, end) of sections clipped to a text of ``length`` characters."""
    out = []
    for s in sections:
        name, start, end = (s["name"], s["start"], s["end"]) if s else (None, 0, 0)
        low = min(max(start or 0, 0), length)
        out.append((name, low, max(low, length if end is None else min(max(end, 0), length))))
    return out


def in_order(edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(section, its start and end) of the sections that hold a character, in
    order, each cut where the next begins."""
    own = np.flatnonzero(edges[:, 1] > edges[:, 0])
    own = own[np.argsort(edges[own, 0], kind="stable")]
    cut = edges[own]
    cut[:-1, 1] = np.minimum(cut[:-1, 1], cut[1:, 0])
    some = cut[:, 1] > cut[:, 0]
    return own[some], cut[some]


def _byte_at(text: str, raw: bytes, points: np.ndarray) -> np.ndarray:
    """Byte offsets of code point offsets."""
    if len(text) == len(raw):
        return points
    heads = np.flatnonzero(np.frombuffer(raw, np.uint8) & 0xC0 != 0x80)
    return np.append(heads, len(raw))[points]


def attribute(df: DataFrame, sections: Column | None = None, text_col: str = "text", out_col: str = "sections",
              rule: str = "first", path: str | None = None) -> DataFrame:
    """``df`` with ``array<struct<name,start,end,n_tokens,n_inside,n_crossing,share>>``
    for ``sections``, an ``array<struct<name,start,end>>`` in code points, or
    for the lines of the text if there is none."""
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    path = path or default_path()
    ship(df.sparkSession)
    kinds = [("name", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
             ("n_tokens", pa.float64() if rule == "share" else pa.int64()), ("n_inside", pa.int64()),
             ("n_crossing", pa.int64()), ("share", pa.float64())]

    def in_sections(texts: pa.Array, spans: pa.Array) -> pa.Array:
        return count(texts, spans.to_pylist())

    def in_lines(texts: pa.Array) -> pa.Array:
        return count(texts, None)

    def count(texts: pa.Array, spans: list | None) -> pa.Array:
        c = codec(path)
        values: list[list] = [[] for _ in kinds]
        offsets = [0]
        for k, text in enumerate(texts.to_pylist()):
            text = text or ""
            own = line_spans(text) if spans is None else section_bounds(spans[k] or (), len(text))
            raw = text.encode()
            edges = _byte_at(text, raw, np.array([s[1:] for s in own], np.int64).reshape(-1, 2))
            lengths = c.lengths[c.encode(text)]
            if spans is None:
                got = allocate(lengths, edges[:, 0], edges[:, 1], rule)
            else:
                holders, cut = in_order(edges)
                got = []
                for numbers in allocate(lengths, cut[:, 0], cut[:, 1], rule):
                    got.append(np.zeros(len(own), numbers.dtype))
                    got[-1][holders] = numbers
            for column in range(3):
                values[column] += [s[column] for s in own]
            for column, numbers in enumerate(got, 3):
                values[column] += numbers.tolist()
            offsets.append(len(values[0]))
        rows = pa.StructArray.from_arrays([pa.array(v, kind) for v, (_, kind) in zip(values, kinds)],
                                          [name for name, _ in kinds])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rows)

    number = "double" if rule == "share" else "bigint"
    kind = (f"array<struct<name:string,start:int,end:int,n_tokens:{number},n_inside:bigint,"
            "n_crossing:bigint,share:double>>")
    if sections is None:
        return df.withColumn(out_col, F.arrow_udf(in_lines, kind).asNondeterministic()(F.col(text_col)))
    return df.withColumn(out_col, F.arrow_udf(in_sections, kind).asNondeterministic()(F.col(text_col), sections))


def op4_attribution(documents: DataFrame) -> DataFrame:
    """Tokens of every line of every document."""
    docs = documents.select("doc_id", "text")
    got = attribute(docs)
    return got.select("doc_id", F.explode("sections").alias("s")).select(
        "doc_id", F.col("s.name").cast("int").alias("line"), F.col("s.start").alias("start"),
        F.col("s.end").alias("end"), F.col("s.n_tokens").alias("n_tokens"),
        F.col("s.n_inside").alias("n_inside"), F.col("s.n_crossing").alias("n_crossing"),
        F.round("s.share", 6).alias("share"))
