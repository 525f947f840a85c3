"""Jaccard join of n-gram sets by prefix trees.

A document's set holds its distinct 4-word shingles.  Sets are written in one
global order (ascending 64-bit shingle hashes) and stored in a path-compressed
trie, so equal beginnings are one path.  A probe walks the trie level by level;
the overlap with a path counts once for all sets below it, and a subtree goes
as soon as the lengths that remain, of the probe and of the sets below, cannot
bring the overlap to the one a link needs.  Subtrees whose sets are all in the
probe's component go too.

Which sets meet in a trie is decided exactly, without sampling or frequencies:
two sets linked at 0.85 differ in at most 3/37 of their sizes' sum.  With the
shingles dealt to more parts than that (by hash; the number depends on the size
class), one part is the same in both, so each set has a key per part.  Keys of
equal parts are far rarer than shared shingles: a passage that a third of the
documents holds makes two of them meet only if it fills a whole part.  Equal
sets are one node from the start.

Sets that share a key are mostly not linked.  Before the sets are built, such
nodes meet by sketches, parities of the shingles at a few places: these differ
in no more places than the sets do in shingles, so what differs in too many is
no link, exactly.  Only nodes with a partner that remains go on to the tries.

Defined results.  Null or word-less text: set size 0, linked with nothing.
Nodes are sets, so rows that share an id but not the text stay apart; a
component's id is the smallest id of its rows, null if none has one.  Shingles
and sets are told apart by 64-bit hashes.  Other columns play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm.clusters import groups_of, rows_with_components
from colloquy.llm.common import materialized, mix64, shingle_set, ship, text_bytes

WIDTH = 4         # words per shingle
PERCENT = 85      # least similarity of a link
_DEALS = 6        # ways of dealing shingles to parts, tried until few parts are empty


# ---- parts: sets that are linked share a key --------------------------------

def _classes(top: int = 1 << 40) -> np.ndarray:
    """Least sizes of the size classes: linked sets are in the same or the next one."""
    starts = [1]
    while starts[-1] < top:
        starts.append(starts[-1] * 100 // PERCENT + 1)
    return np.array(starts)


_STARTS = _classes()


def most_different(sizes: int) -> int:
    """Shingles in which two linked sets can differ, given the sum of their sizes."""
    return (100 - PERCENT) * sizes // (100 + PERCENT)


def part_keys(shingles: np.ndarray) -> np.ndarray:
    """The keys of a set, for pairs in its own size class and in the next.

    Parts without a shingle have no key: where more parts than can differ have
    one, an equal part with a shingle exists.  Where not, the shingles are dealt
    another way as well, and at last the empty parts count."""
    own = int(np.searchsorted(_STARTS, len(shingles), "right")) - 1
    keys = []
    for tag in (own, own + 1):
        differ = most_different(2 * (int(_STARTS[tag + 1]) - 1))
        if not differ:
            continue  # linked with equal sets only, and these are one node
        parts = differ + 2 + differ // 16
        for deal in range(_DEALS):
            dealt = mix64(shingles + np.uint64(0x2545F4914F6CDD1D * (deal + 1) & (2 ** 64 - 1)))
            part = ((dealt >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
            sums = np.zeros(parts, np.uint64)
            np.add.at(sums, part, mix64(dealt))
            full = np.bincount(part.astype(np.int64), minlength=parts) > 0
            enough = full.sum() > differ
            if deal == _DEALS - 1 and not enough:
                full[:] = True
            which = np.flatnonzero(full).astype(np.uint64)
            seed = np.uint64(((tag << 8) | deal) * 0x9E3779B97F4A7C15 & (2 ** 64 - 1))
            keys.append(mix64(mix64(which + seed) ^ sums[full]))
            if enough:
                break
    return np.unique(np.concatenate(keys)).view(np.int64) if keys else np.empty(0, np.int64)


# ---- sketches ---------------------------------------------------------------

def sketch(shingles: np.ndarray) -> bytes:
    """Of each of 2 to 4 places a shingle (a power of two), whether the number of
    shingles there is odd.  The halves' exclusive or is the sketch at half the places."""
    places = max(64, 1 << (2 * len(shingles) - 1).bit_length())
    counts = np.bincount((shingles & np.uint64(places - 1)).astype(np.int64), minlength=places)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def near(sketches: list[bytes], sizes: np.ndarray, labels: np.ndarray, sides: np.ndarray) -> list[tuple[int, int]]:
    """As ``forest``, of the pairs whose sketches differ in no more places than
    linked sets of their sizes can: all links, and few others."""
    component = np.unique(labels, return_inverse=True)[1]
    order = np.argsort(sizes, kind="stable")
    size, side, component = sizes[order], sides[order], component[order]
    stops = np.searchsorted(size, 100 * size // PERCENT, "right")
    crossed, edges = sides.any(), []
    width = np.array([len(sketches[k]) for k in order])
    for w in np.unique(width).tolist():  # grows with the size; linked sets have the same or the next
        first, end, last = np.searchsorted(width, [w, w + 1, 2 * w + 1]).tolist()
        read = lambda a, b: np.frombuffer(b"".join(sketches[k] for k in order[a:b]), np.uint64)
        own, twice = read(first, end).reshape(-1, w // 8), read(end, last).reshape(-1, 2, w // 8)
        bits = np.concatenate([own, twice[:, 0] ^ twice[:, 1]])
        for i in range(first, end):
            meets = component[i + 1:stops[i]] != component[i]
            if crossed:
                meets &= side[i + 1:stops[i]] != side[i]
            js = i + 1 + np.flatnonzero(meets)
            differ = np.bitwise_count(bits[js - first] ^ bits[i - first]).sum(axis=1, dtype=np.int64)
            for j in js[differ <= most_different(size[i] + size[js])].tolist():
                if component[i] != component[j]:
                    edges.append((int(order[i]), int(order[j])))
                    component[component == component[j]] = component[i]
    return edges


# ---- the trie ---------------------------------------------------------------

class Trie:
    """Path-compressed trie of sorted sets, its nodes in breadth-first order.

    Node k continues its parent's path with the shingles flat[label[k]:label[k + 1]],
    to depth end[k]; below it are the sets first[k] to last[k] of ``order``."""

    def __init__(self, sets: list[np.ndarray]):
        self.order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u4").tobytes())
        s = [sets[i] for i in self.order]
        common = np.array([0, *map(_common, s, s[1:])])
        ranges, start, end, children = [(0, len(s) - 1)], [0], [], []
        for f, l in ranges:  # grows while it is read
            k = len(end)
            if f == l:
                end.append(len(s[f]))
                children.append((0, 0))
                continue
            part = common[f + 1:l + 1]
            end.append(int(part.min()))
            cuts = [f, *(f + 1 + np.flatnonzero(part == end[k])).tolist(), l + 1]
            children.append((len(ranges), len(cuts) - 1))
            ranges.extend((a, b - 1) for a, b in zip(cuts, cuts[1:]))
            start.extend([end[k]] * (len(cuts) - 1))
        self.first, self.last = np.array(ranges).T
        self.end, self.children = np.array(end), np.array(children)
        labels = [s[f][a:b] for (f, _), a, b in zip(ranges, start, end)]
        self.flat = np.concatenate(labels)
        self.label = np.cumsum([0, *map(len, labels)])
        self.final = np.array([int(s[f][b - 1]) if b else -1 for (f, _), b in zip(ranges, end)])  # last of the path
        sizes = np.array([len(x) for x in s])
        bounds = np.stack([self.first, self.last + 1], 1).ravel()
        padded = np.append(sizes, sizes[-1:])
        self.least = np.minimum.reduceat(padded, bounds)[::2]
        self.most = np.maximum.reduceat(padded, bounds)[::2]

    def uniform(self, component: np.ndarray) -> np.ndarray:
        """Per node the component of all sets below it, -1 if they differ."""
        c = component[self.order]
        run = np.cumsum(np.append(0, c[1:] != c[:-1]))
        return np.where(run[self.first] == run[self.last], c[self.first], -1)

    def linked(self, x: np.ndarray, mask: np.ndarray, skip: np.ndarray) -> np.ndarray:
        """Places in ``order`` of the sets linked with x, but for subtrees of
        which ``skip``.  ``mask`` is an array of zeros over all shingles."""
        mask[x] = 1
        out, at, overlap = [], np.zeros(1, np.int64), np.zeros(1, np.int64)
        while len(at):
            some = ~skip[at]
            at, overlap = at[some], overlap[some]
            begin, size = self.label[at], self.label[at + 1] - self.label[at]
            ends = np.cumsum(size)
            places = np.arange(ends[-1] if len(at) else 0) + np.repeat(begin - (ends - size), size)
            sums = np.append(0, np.cumsum(mask[self.flat[places]], dtype=np.int64))
            overlap = overlap + sums[ends] - sums[ends - size]
            # what can be added: the set's rest below this node, the probe's rest
            rest = len(x) - np.searchsorted(x, self.final[at], "right")
            best = np.clip(self.end[at] + rest, self.least[at], self.most[at])
            reach = overlap + np.minimum(best - self.end[at], rest)
            some = (100 + PERCENT) * reach >= PERCENT * (len(x) + best)
            at, overlap = at[some], overlap[some]
            begin, size = self.children[at].T
            out.append(self.first[at[size == 0]])
            ends = np.cumsum(size)
            at = np.arange(ends[-1] if len(at) else 0) + np.repeat(begin - (ends - size), size)
            overlap = np.repeat(overlap, size)
        mask[x] = 0
        return np.concatenate(out) if out else np.empty(0, np.int64)


def _common(a: np.ndarray, b: np.ndarray) -> int:
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    return int(differ[0]) if len(differ) else n


def forest(sets: list[np.ndarray], labels: np.ndarray, sides: np.ndarray) -> list[tuple[int, int]]:
    """Links (positions) that join the components ``labels``: sets of side 0
    against those of side 1, or against each other if there is no side 1."""
    values, inverse = np.unique(np.concatenate(sets), return_inverse=True)
    cuts = np.cumsum([len(s) for s in sets])[:-1]
    sets = np.split(inverse.astype(np.uint32), cuts)
    component = np.unique(labels, return_inverse=True)[1]
    stored = np.flatnonzero(sides == 1) if sides.any() else np.arange(len(sets))
    probes = np.flatnonzero(sides == 0)
    trie, mask, edges = Trie([sets[i] for i in stored]), np.zeros(len(values), np.int64), []
    below = trie.uniform(component[stored])
    for i in probes.tolist():
        for j in stored[np.array(trie.order)[trie.linked(sets[i], mask, below == component[i])]].tolist():
            if component[i] != component[j]:
                edges.append((i, j))
                component[component == component[j]] = component[i]
                below = None
        if below is None:
            below = trie.uniform(component[stored])
            if (component == component[0]).all():
                break
    return edges


def _joined(batches, edges_of):
    for t in groups_of(batches, "block"):
        if t.num_rows < 2:
            continue
        node = t["node"].to_numpy()
        edges = edges_of(t, t["lab"].to_numpy(), t["side"].to_numpy())
        if edges:
            yield pa.RecordBatch.from_arrays([pa.array(node[list(e)]) for e in zip(*edges)], ["a", "b"])


def _trie_join(batches):
    yield from _joined(batches, lambda t, *how: forest([np.frombuffer(b, np.uint64) for b in t["set"].to_pylist()], *how))


def _sift(batches):
    yield from _joined(batches, lambda t, *how: near(t["set"].to_pylist(), t["n"].to_numpy(), *how))


# ---- on Spark ---------------------------------------------------------------

def _signed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, th, n, node, keys, sketch): hash of the text, set size, hash of the
    set, keys, sketch."""
    @F.arrow_udf("struct<n:bigint,node:bigint,keys:array<bigint>,sketch:binary>")
    def sign(texts: pa.Array) -> pa.Array:
        n, node, keys, sketches = [], [], [], []
        for text in text_bytes(texts):
            s = shingle_set(text, WIDTH)
            n.append(len(s))
            node.append(xxhash.xxh64_intdigest(s.tobytes()) - (1 << 63) if len(s) else None)
            keys.append(part_keys(s) if len(s) else None)
            sketches.append(sketch(s) if len(s) else None)
        return pa.StructArray.from_arrays(
            [pa.array(n, pa.int64()), pa.array(node, pa.int64()), pa.array(keys, pa.list_(pa.int64())),
             pa.array(sketches, pa.binary())], ["n", "node", "keys", "sketch"])

    return (df.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("th"),
                      sign.asNondeterministic()(F.col(text_col)).alias("s")).select("id", "th", "s.*"))


def _packed(texts: pa.Array) -> pa.Array:
    return pa.array([shingle_set(t, WIDTH).tobytes() for t in text_bytes(texts)], pa.binary())


def components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n, component): one row per row of ``df``; component is the smallest
    id that links reach."""
    ship(df.sparkSession)
    signed = materialized(_signed(df, id_col, text_col))
    return rows_with_components(df, id_col, text_col, signed, _packed, _trie_join,
                                sift=_sift).select("id", "n", "component")


def op13_ngram_join(documents: DataFrame) -> DataFrame:
    return components(documents.select("doc_id", "text")).select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))
