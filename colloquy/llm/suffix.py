"""Removal of repeated byte strings by suffix arrays.

Every byte that is covered by a string of LENGTH bytes which also starts
earlier (in a document of smaller id, or earlier in the same one) is removed;
strings are judged on the input, overlaps count, matches never cross documents.

Suffixes are sorted by linear grouping construction (``gsaca``), but only where
sorting can decide something.  Every string of LENGTH bytes is owned by the
least of its KMER-byte words (by hash, the first of equal ones); equal strings
have equal owners at equal places.  So strings whose owner occurs once in the
corpus are not repeated; the others are compared within the rows of one owner.
The text around an owner (a segment: all strings it owns there) is reduced to
the distinct ones per owner, and only the first occurrence of each is looked at
again.  Owners with one distinct segment are settled by that: its first
occurrence stays.  For the rest, the parts of segments that a rolling hash sees
twice are collapsed, and where different parts of one owner overlap they are
sorted into one suffix array, in which equal strings are neighbours and are
compared byte by byte.

Scale.  Owners are rows, so no document or passage is one task's work; copies
collapse by map-side combined minimums.  Owners with more than LARGE distinct
segments are not gathered: their strings are compared by a 128-bit hash in a
grouped minimum.

Null text counts as empty; a null id sorts before all others.  Rows that share
an id but not the text are documents of their own, in the order of a 64-bit hash
of their texts; rows equal in id and text count as one document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm.common import checkpoint, mix64, release, ship, text_bytes
from colloquy.llm.gsaca import suffix_array

LENGTH = 100
KMER = 16
LARGE = 20_000
_FIRST = -(1 << 63)
_ODD = 0x9E3779B97F4A7C15
_OWNED = "array<struct<h:bigint,seg:bigint,lo:int,hi:int>>"


def _words(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The first and last eight bytes of each word of KMER bytes."""
    at = np.lib.stride_tricks.as_strided(np.frombuffer(text, np.uint8), (len(text) - 7, 8), (1, 1))
    half = np.ascontiguousarray(at).view(np.uint64).ravel()
    return half[:-8], half[8:]


def owners(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, first start, end of starts) of every run of strings of LENGTH
    bytes that the same word owns, the word as a 64-bit hash."""
    span = LENGTH - KMER + 1
    if len(text) < LENGTH:
        none = np.empty(0, np.int64)
        return none, none, none
    first, last = _words(text)
    rank = first * np.uint64(_ODD) ^ last * np.uint64(0xC2B2AE3D27D4EB4F)
    rank ^= rank >> np.uint64(29)
    rank *= np.uint64(0xBF58476D1CE4E5B9)
    # 32 bits of hash, then the place: the least is the first of equal words
    rank >>= np.uint64(32)
    rank <<= np.uint64(32)
    rank |= np.arange(len(rank), dtype=np.uint64)
    # least word of each window of ``span`` words: block-wise minimums from both ends
    pad = np.full(-len(rank) % span, np.iinfo(np.uint64).max, np.uint64)
    block = np.concatenate([rank, pad]).reshape(-1, span)
    ahead = np.minimum.accumulate(block, axis=1).ravel()
    back = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(text) - LENGTH + 1
    least = np.minimum(back[:n], ahead[span - 1:span - 1 + n])
    change = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    place = (least[change] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    return mix64(mix64(first[place]) + last[place]).view(np.int64), change, np.append(change[1:], n)


def _owner_words(texts: pa.Array) -> pa.Array:
    found = [owners(t)[0] for t in text_bytes(texts)]
    offsets = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.empty(0, np.int64), *found])))


def _segments(texts: pa.Array) -> pa.Array:
    h, seg, lo, hi, offsets = [], [], [], [], [0]
    for text in text_bytes(texts):
        hashes, first, end = owners(text)
        starts, ends = first.tolist(), end.tolist()
        h.append(hashes)
        lo.append(first)
        hi.append(end)
        seg += [xxhash.xxh64_intdigest(text[a:b + LENGTH - 1]) for a, b in zip(starts, ends)]
        offsets.append(offsets[-1] + len(starts))
    flat = lambda parts, kind: pa.array(np.concatenate(parts).astype(kind) if parts else np.empty(0, kind))
    rows = pa.StructArray.from_arrays(
        [flat(h, np.int64), pa.array(np.array(seg, np.uint64).view(np.int64)), flat(lo, np.int32), flat(hi, np.int32)],
        ["h", "seg", "lo", "hi"])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rows)


def _rolling(text: bytes) -> np.ndarray:
    """Hash of every string of LENGTH bytes (a filter only: equal strings have
    equal hashes, and what looks equal is compared later)."""
    n = len(text)
    powers = np.full(n, _ODD, np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers)
    inverse = np.full(n, pow(_ODD, -1, 1 << 64), np.uint64)
    inverse[0] = 1
    inverse = np.cumprod(inverse)
    total = np.concatenate([np.zeros(1, np.uint64),
                            np.cumsum((np.frombuffer(text, np.uint8).astype(np.uint64) + np.uint64(1)) * powers)])
    return (total[LENGTH:] - total[:-LENGTH]) * inverse[:n - LENGTH + 1]


def _seen_twice(groups: np.ndarray, segments: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment, from, to) of the runs of strings, by their start within the
    segment, that look equal to another string of the same group."""
    sizes = np.array([len(s) for s in segments], np.int64)
    begin = np.cumsum(sizes) - sizes
    strings = sizes - LENGTH + 1
    owner = np.repeat(np.arange(len(segments)), strings)
    start = np.arange(len(owner)) - np.repeat(np.cumsum(strings) - strings, strings)
    key = mix64(_rolling(b"".join(segments))[begin[owner] + start]
                + mix64(groups.astype(np.int64).view(np.uint64))[owner])
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    at = np.flatnonzero(twice)
    if not len(at):
        return at, at, at
    cut = np.flatnonzero((np.diff(at) > 1) | (np.diff(owner[at]) > 0)) + 1
    low, high = at[np.concatenate([[0], cut])], at[np.concatenate([cut - 1, [len(at) - 1]])]
    return owner[low], start[low], start[high] + 1


def _repeated_in_group(places: list[tuple[int, int, int]], runs: list[tuple[int, int, bytes]]) -> dict[int, list[tuple[int, int]]]:
    """Of one owner: the runs (from, to) of strings that it has earlier, by
    segment.  ``places``: (id, text key, start) of each segment; ``runs``: (segment,
    from, bytes) of the candidates.  Equal candidates are one part; different
    parts are sorted into one suffix array, where equal strings are neighbours."""
    parts: dict[bytes, list[tuple[int, int]]] = {}
    for k, a, part in runs:
        parts.setdefault(part, []).append((k, a))
    position = lambda k, a: (*places[k][:2], places[k][2] + a)
    distinct = list(parts)
    if len(distinct) == 1:
        own, n = sorted(parts[distinct[0]], key=lambda x: position(*x)), len(distinct[0]) - LENGTH + 1
        out: dict[int, list[tuple[int, int]]] = {}
        for k, a in own[1:]:
            out.setdefault(k, []).append((a, a + n))
        return out
    text = b"\xff".join(distinct)  # no UTF-8 text has this byte
    begin, owner = 0, {}
    for p, part in enumerate(distinct):
        for w in range(len(part) - LENGTH + 1):
            owner[begin + w] = (p, w)
        begin += len(part) + 1
    gone: dict[int, set[int]] = {}
    last, same = None, []
    for at in [*suffix_array(text), -1]:
        string = text[at:at + LENGTH] if at in owner else None
        if at == -1 or (string is not None and string != last):
            for _, k, w in sorted((position(k, a + w), k, a + w) for p, w in same for k, a in parts[distinct[p]])[1:]:
                gone.setdefault(k, set()).add(w)
            last, same = string, []
        if string is not None:
            same.append(owner[at])
    out = {}
    for k, starts in gone.items():
        s = np.array(sorted(starts), np.int64)
        out[k] = [(int(c[0]), int(c[-1]) + 1) for c in np.split(s, np.flatnonzero(np.diff(s) > 1) + 1)]
    return out


_RUNS = pa.schema([("h", pa.int64()), ("seg", pa.int64()),
                   ("runs", pa.list_(pa.struct([("f", pa.int32()), ("t", pa.int32())])))])


def _settle(rows: pa.Table) -> pa.RecordBatch:
    """Whole groups (h, seg, id, tk, lo, bytes), sorted by h -> (h, seg, runs)."""
    h, seg = rows["h"].to_numpy(), rows["seg"].to_numpy()
    segments = rows["bytes"].to_pylist()
    places = list(zip(rows["id"].to_pylist(), rows["tk"].to_pylist(), rows["lo"].to_pylist()))
    who, low, high = _seen_twice(h, segments)
    found: list[dict] = []
    for own in np.split(np.arange(len(who)), np.flatnonzero(np.diff(h[who])) + 1) if len(who) else ():
        runs = [(k, a, segments[k][a:b + LENGTH - 1])
                for k, a, b in zip(who[own].tolist(), low[own].tolist(), high[own].tolist())]
        for k, spans in _repeated_in_group(places, runs).items():
            found.append({"h": int(h[k]), "seg": int(seg[k]), "runs": [{"f": a, "t": b} for a, b in spans]})
    return pa.RecordBatch.from_pylist(found, _RUNS)


def _settle_groups(batches):
    """Batches sorted by h; a batch's last group waits for the next batch."""
    rest = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        rest = t if rest is None else pa.concat_tables([rest, t])
        h = rest["h"].to_numpy()
        whole = int(np.flatnonzero(h == h[-1])[0]) if len(h) else 0
        if whole:
            yield _settle(rest.slice(0, whole))
            rest = rest.slice(whole)
    if rest is not None and rest.num_rows:
        yield _settle(rest)


def _cut(texts: pa.Array, wanted: pa.Array) -> pa.Array:
    """The wanted segments of each text, where the text has them."""
    out = []
    for text, spans in zip(text_bytes(texts), wanted.to_pylist()):
        rows = []
        for s in spans:
            part = text[s["lo"]:s["hi"] + LENGTH - 1]
            if xxhash.xxh64_intdigest(part) == s["seg"] & (1 << 64) - 1:
                rows.append({"h": s["h"], "seg": s["seg"], "segments": s["segments"], "lo": s["lo"], "bytes": part})
        out.append(rows)
    return pa.array(out, pa.list_(pa.struct([("h", pa.int64()), ("seg", pa.int64()), ("segments", pa.int64()),
                                             ("lo", pa.int32()), ("bytes", pa.binary())])))


def _strings(segments: pa.Array) -> pa.Array:
    """Two 64-bit hashes of every string of a segment, in order."""
    out = []
    for s in segments.to_pylist():
        digests = (xxhash.xxh128_intdigest(s[a:a + LENGTH]) for a in range(len(s) - LENGTH + 1))
        out.append([{"x": (d >> 64) - (1 << 63), "y": (d & (1 << 64) - 1) - (1 << 63)} for d in digests])
    return pa.array(out, pa.list_(pa.struct([("x", pa.int64()), ("y", pa.int64())])))


def _keyed(df: DataFrame, id_col: str, text_col: str, unique: bool) -> DataFrame:
    """(shown, id, tk, text): the id as given, and with null as the least long; the
    text key ``tk`` tells rows of one id apart, and is 0 where no two share an id."""
    text = F.col(text_col)
    tk = F.lit(0).cast("long") if unique else F.xxhash64(F.coalesce(text, F.lit("")))
    return df.select(F.col(id_col).alias("shown"), F.coalesce(F.col(id_col), F.lit(_FIRST)).alias("id"),
                     tk.alias("tk"), text.alias("text"))


def _unique_ids(df: DataFrame, id_col: str) -> bool:
    ids = df.select(F.coalesce(F.col(id_col), F.lit(_FIRST)).alias("id"))
    return ids.groupBy("id").count().filter("count > 1").isEmpty()


def repeated_ranges(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", unique: bool | None = None) -> DataFrame:
    """(id, tk, ranges) of the documents that hold repeated strings: array of
    struct(f, t), byte ranges to be removed, which may overlap.  ``unique``: no
    two rows share an id (looked up if not given)."""
    ship(df.sparkSession)
    unique = _unique_ids(df, id_col) if unique is None else unique
    docs = _keyed(df, id_col, text_col, unique)
    spark = df.sparkSession
    again = _shared_owners(docs)
    release(spark)
    first = (again.groupBy("h", "seg")
             .agg(F.min(F.struct("id", "tk", "lo")).alias("at"), F.max(F.expr("hi - lo")).alias("n")))
    pieces = _pieces(docs, first, unique)
    release(spark)
    runs = _mixed_runs(pieces)
    release(spark)
    known = first.join(runs, ["h", "seg"], "left").select("h", "seg", "at", "runs")
    here = F.struct("id", "tk", "lo")
    whole = F.array(F.struct(F.lit(0).alias("f"), (F.col("hi") - F.col("lo")).alias("t")))
    spans = again.join(known, ["h", "seg"]).select(
        "id", "tk", "lo", F.explode(F.when(here != F.col("at"), whole).otherwise(F.col("runs"))).alias("r"))
    # equal rows give equal ranges, of which a document needs one
    gather = F.collect_list if unique else F.collect_set
    return spans.groupBy("id", "tk").agg(gather(F.struct(
        (F.col("lo") + F.col("r.f")).alias("f"), (F.col("lo") + F.col("r.t") + LENGTH - 1).alias("t"))).alias("ranges"))


def _shared_owners(docs: DataFrame) -> DataFrame:
    """(id, tk, h, seg, lo, hi) of the runs of strings whose owner occurs again."""
    word = F.arrow_udf(_owner_words, "array<bigint>")
    shared = docs.select(F.explode(word("text")).alias("h")).groupBy("h").agg(F.count("*").alias("c")).filter("c > 1")
    owned = docs.select("id", "tk", F.explode(F.arrow_udf(_segments, _OWNED)("text")).alias("o")).select("id", "tk", "o.*")
    return checkpoint(owned.join(shared.select("h"), "h"))


def _pieces(docs: DataFrame, first: DataFrame, unique: bool) -> DataFrame:
    """(id, tk, h, seg, segments, lo, bytes) of the first occurrences of
    segments, of owners with several."""
    per = first.groupBy("h").agg(F.count("*").alias("segments")).filter("segments > 1")
    mixed = first.join(per, "h").select("h", "seg", "segments", "at.id", "at.tk", "at.lo",
                                        (F.col("at.lo") + F.col("n")).alias("hi"))
    wanted = mixed.groupBy("id", "tk").agg(F.collect_list(F.struct("h", "seg", "segments", "lo", "hi")).alias("wanted"))
    fetch = F.arrow_udf(_cut, "array<struct<h:bigint,seg:bigint,segments:bigint,lo:int,bytes:binary>>")
    pieces = checkpoint(docs.join(wanted, ["id", "tk"]).select("id", "tk", F.explode(fetch("text", "wanted")).alias("p"))
                        .select("id", "tk", "p.*"))
    return pieces if unique else pieces.dropDuplicates(["h", "seg"])  # equal rows give a segment each


def _mixed_runs(once: DataFrame) -> DataFrame:
    """(h, seg, runs) of the segments whose strings partly occur earlier in
    another segment."""
    small = (once.filter(F.col("segments") <= LARGE).repartition("h").sortWithinPartitions("h")
             .select("h", "seg", "id", "tk", "lo", "bytes")
             .mapInArrow(_settle_groups, "h long, seg long, runs array<struct<f:int,t:int>>"))
    strings = (once.filter(F.col("segments") > LARGE)
               .select("h", "seg", "id", "tk", "lo",
                       F.posexplode(F.arrow_udf(_strings, "array<struct<x:bigint,y:bigint>>")("bytes")).alias("w", "s"))
               .select("h", "seg", "w", "s.x", "s.y", F.struct("id", "tk", (F.col("lo") + F.col("w")).alias("p")).alias("at")))
    least = strings.groupBy("h", "x", "y").agg(F.min("at").alias("least"))
    large = (strings.join(least, ["h", "x", "y"]).filter("at <> least")
             .groupBy("h", "seg").agg(F.collect_list(F.struct(F.col("w").alias("f"), (F.col("w") + 1).alias("t"))).alias("runs")))
    return checkpoint(small.unionByName(large))


def _remove(texts: pa.Array, ranges: pa.Array) -> pa.Array:
    kept, n_bytes, n_removed, n_spans = [], [], [], []
    for text, own in zip(text_bytes(texts), ranges.to_pylist()):
        edge = np.zeros(len(text) + 1, np.int32)
        for r in own or ():
            if r["f"] < len(text):
                edge[r["f"]] += 1
                edge[min(r["t"], len(text))] -= 1
        gone = np.cumsum(edge[:-1]) > 0
        n_bytes.append(len(text))
        n_removed.append(int(gone.sum()))
        n_spans.append(int(np.count_nonzero(gone[1:] & ~gone[:-1]) + (gone[:1].sum())))
        kept.append(np.frombuffer(text, np.uint8)[~gone].tobytes())
    return pa.StructArray.from_arrays([pa.array(kept, pa.binary()), pa.array(n_bytes, pa.int64()),
                                       pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64())],
                                      ["kept", "n_bytes", "n_removed", "n_spans"])


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", out_col: str = "deduped") -> DataFrame:
    """(id, struct<kept: binary, n_bytes, n_removed, n_spans>) of every row."""
    unique = _unique_ids(df, id_col)
    ranges = checkpoint(repeated_ranges(df, id_col, text_col, unique)).select(
        F.col("id").alias("owner"), F.col("tk").alias("owner_tk"), "ranges")
    release(df.sparkSession)
    docs = _keyed(df, id_col, text_col, unique)
    run = F.arrow_udf(_remove, "struct<kept:binary,n_bytes:bigint,n_removed:bigint,n_spans:bigint>")
    joined = docs.join(ranges, (F.col("id") == F.col("owner")) & (F.col("tk") == F.col("owner_tk")), "left")
    return joined.select(F.col("shown").alias("id"), run.asNondeterministic()("text", "ranges").alias(out_col))


def op6_suffix_dedup(documents: DataFrame) -> DataFrame:
    d = remove_repeats(documents.select("doc_id", "text"))
    return d.select(F.col("id").alias("doc_id"), "deduped.n_bytes", "deduped.n_removed", "deduped.n_spans",
                    F.sha2("deduped.kept", 256).alias("kept_sha256"))
