"""Near-duplicate documents by circulant MinHash.

A document's set holds its distinct 5-word shingles.  Two permutations make
all coordinates of the signature: the first places every shingle on a circle
of 2**32 positions; the second ranks the positions; coordinate k is the least
rank after the circle is shifted by k.  Bands of the signature bring candidate
pairs together, and every link is confirmed by the exact Jaccard similarity of
the full sets.

Scale.  Documents with equal sets are one node (by a 64-bit hash), so copies
never meet.  Nodes meet in blocks of bounded size inside a task (clusters.py):
first each with its nearest pivot, then those of a bucket whose components
still differ; a block returns a spanning forest of its links, never all pairs,
and nothing is capped.  A candidate pair is dropped before the exact check only
if its signatures agree in fewer coordinates than LEAST_AGREEING, 5 standard
deviations below what a similarity of 0.75 gives.  48 bands of 5 coordinates
miss a pair at exactly 0.75 with a probability of 2.3e-6.

Defined results.  Null or word-less text: set size 0, linked with nothing.
Nodes are sets: rows that share an id but not the text stay apart, and every
row has one row in the result.  A row without an id belongs to the component
of the texts it is linked with; where none has an id, component_id is null and
the row is kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm.clusters import Bits, groups_of, rows_with_components
from colloquy.llm.common import fresh, materialized, mix64, shingle_set, ship, text_bytes

WIDTH = 5            # words per shingle
PERCENT = 75         # least similarity of a link
BANDS, ROWS = 48, 5
COORDINATES = BANDS * ROWS
_SPREAD = (0.75 * 0.25 / COORDINATES) ** 0.5
LEAST_AGREEING = int((0.75 - 5 * _SPREAD) * COORDINATES)
_SLICE = 2048        # shingles ranked at a time, to stay in a core's cache


def _first_permutation(shingles: np.ndarray) -> np.ndarray:
    """Position of each shingle on the circle of 2**32 positions."""
    return (mix64(shingles ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(32)).astype(np.uint32)


def _second_permutation(x: np.ndarray) -> np.ndarray:
    """Rank of a position: a bijection of 32 bits, in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


_SHIFTS = np.arange(COORDINATES, dtype=np.uint32)[:, None]


def signature(shingles: np.ndarray) -> np.ndarray:
    places = _first_permutation(shingles)
    best = np.full(COORDINATES, np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(places), _SLICE):
        ranks = _second_permutation(places[None, at:at + _SLICE] + _SHIFTS)
        np.minimum(best, ranks.min(axis=1), out=best)
    return best


def _band_keys(sig: np.ndarray) -> np.ndarray:
    acc = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in sig.reshape(BANDS, ROWS).T:
        acc = mix64((acc + column.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15))
    return acc.view(np.int64)


def _signed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, th, n, node, keys, low): hash of the text, set size, hash of the set,
    band keys, low byte of every coordinate."""
    @F.arrow_udf("struct<n:bigint,node:bigint,keys:array<bigint>,low:binary>")
    def sign(texts: pa.Array) -> pa.Array:
        n, node, keys, low = [], [], [], []
        for text in text_bytes(texts):
            s = shingle_set(text, WIDTH)
            n.append(len(s))
            if not len(s):
                node.append(None), keys.append(None), low.append(None)
                continue
            sig = signature(s)
            node.append(xxhash.xxh64_intdigest(s.tobytes()) - (1 << 63))
            keys.append(_band_keys(sig))
            low.append(sig.astype(np.uint8).tobytes())
        return pa.StructArray.from_arrays(
            [pa.array(n, pa.int64()), pa.array(node, pa.int64()), pa.array(keys, pa.list_(pa.int64())),
             pa.array(low, pa.binary())], ["n", "node", "keys", "low"])

    return (df.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("th"),
                      sign.asNondeterministic()(F.col(text_col)).alias("s")).select("id", "th", "s.*"))


def _packed(texts: pa.Array) -> pa.Array:
    return pa.array([shingle_set(t, WIDTH).tobytes() for t in text_bytes(texts)], pa.binary())


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """100 * |a and b| >= PERCENT * |a or b|, exactly."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= PERCENT * (len(a) + len(b) - both)


def forest(sets: list[np.ndarray], low: np.ndarray, labels: np.ndarray, sides: np.ndarray) -> list[tuple[int, int]]:
    """Links (positions) that join the components ``labels``: sets of side 0
    against those of side 1, or against each other if there is no side 1.
    Signatures choose what is compared, the likeliest first; full sets decide."""
    size = np.array([len(s) for s in sets])
    component = np.unique(labels, return_inverse=True)[1]
    crossed = sides.any()
    other, edges = np.flatnonzero(sides == 1), []
    for i in np.flatnonzero(sides == 0).tolist():
        js = other if crossed else np.arange(i + 1, len(sets))
        js = js[component[js] != component[i]]
        js = js[100 * np.minimum(size[js], size[i]) >= PERCENT * np.maximum(size[js], size[i])]
        if not len(js):
            continue
        agree = (low[js] == low[i]).sum(axis=1)
        for j in js[np.argsort(-agree, kind="stable")][:np.count_nonzero(agree >= LEAST_AGREEING)].tolist():
            if component[i] != component[j] and similar(sets[i], sets[j]):
                edges.append((i, j))
                component[component == component[j]] = component[i]
    return edges


def _band_join(batches):
    for t in groups_of(batches, "block"):
        if t.num_rows < 2:
            continue
        node = t["node"].to_numpy()
        sets = [np.frombuffer(b, np.uint64) for b in t["set"].to_pylist()]
        low = np.frombuffer(b"".join(t["low"].to_pylist()), np.uint8).reshape(-1, COORDINATES)
        edges = forest(sets, low, t["lab"].to_numpy(), t["side"].to_numpy())
        if edges:
            yield pa.RecordBatch.from_arrays([pa.array(node[list(e)]) for e in zip(*edges)], ["a", "b"])


def _rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    ship(df.sparkSession)
    signed = materialized(_signed(df, id_col, text_col))
    return rows_with_components(df, id_col, text_col, signed, _packed, _band_join, ["low"])


def components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n, component): one row per row of ``df``; component is the smallest
    id that links reach, the row's own where nothing is linked."""
    return _rows(df, id_col, text_col).select("id", "n", "component")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group (that of the smallest id);
    columns as they were.  Rows without an id stay.  Of rows that repeat both
    the id and the text one stays; other texts of an id are documents of their own."""
    found = materialized(_rows(docs, id_col, text_col).filter("id IS NOT NULL"))
    texts = found.groupBy("id", "th").agg(F.first("n").alias("n"), F.first("component").alias("component"),
                                          F.count("*").alias("rows"))
    # of a group, the smallest id's text; of several texts of that id, one
    best = (texts.filter("n > 0 AND component = id").groupBy("component").agg(F.min("th").alias("best")))
    judged = materialized(texts.join(best, "component", "left")
                        .select("id", "th", "rows", ((F.col("n") > 0) & ((F.col("component") != F.col("id"))
                                                                         | (F.col("th") != F.col("best")))).alias("gone"))
                        .filter("gone OR rows > 1"))
    touched = Bits(judged.select(F.xxhash64("id", "th").alias("hash")))
    own = docs.withColumn(h := fresh(docs, "_th"), F.xxhash64(text_col))
    maybe = F.col(id_col).isNotNull() & touched.hold(id_col, h)
    gone = judged.filter("gone").select(F.col("id").alias("_gone_id"), F.col("th").alias("_gone_th"))
    left = (own.filter(maybe)
            .join(gone, (F.col(id_col) == F.col("_gone_id")) & (F.col(h) == F.col("_gone_th")), "left_anti")
            .dropDuplicates([id_col, h]))
    return own.filter(~maybe).unionByName(left).drop(h)


def op2_minhash(documents: DataFrame) -> DataFrame:
    return components(documents.select("doc_id", "text")).select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.col("component").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"))
