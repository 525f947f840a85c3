"""Matching characters of two texts, as the diff ratio counts them.

The longest common run of characters is taken first (of equal ones the
earliest in ``a``, then in ``b``), then the same is done with what is left on
either side of it.  A character that makes up more than 1 % of a ``b`` of 200
or more characters is popular (autojunk): it starts no run, it only prolongs
one.  A part without any run still matches in the characters that its two texts
begin with.

All runs of the pair are found once, as numpy arrays of diagonals: the places
of ``b`` are indexed by character, each place of ``a`` fetches its equals, and
neighbours on a diagonal are one run.  A part of the pair then only clips the
runs that reach into it.  Pairs with more than ``MAX_POINTS`` equal places are
swept row by row instead, in memory that grows with ``b`` alone; the blocks
are the same.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_POINTS, PART_POINTS = 4_000_000, 250_000
# fixed values of the diff ratio's autojunk rule
_JUNK_FROM, _JUNK_PART = 200, 100


def _codes(s: str) -> np.ndarray:
    return np.frombuffer(s.encode("utf-32-le", "surrogatepass"), np.uint32)


class _Places:
    """The places of ``b`` by character, popular characters left out."""

    def __init__(self, b: np.ndarray, autojunk: bool):
        codes, inverse, counts = np.unique(b, return_inverse=True, return_counts=True)
        places = np.argsort(inverse, kind="stable")
        if autojunk and len(b) >= _JUNK_FROM:
            rare = counts <= len(b) // _JUNK_PART + 1
            places = places[rare[inverse[places]]]
            codes, counts = codes[rare], counts[rare]
        self.codes, self.counts, self.places = codes, counts, places
        self.begin = np.cumsum(counts) - counts

    def of(self, a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per character of ``a``: first index into ``places``, and how many."""
        if not len(self.codes):
            return np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
        at = np.searchsorted(self.codes, a).clip(max=len(self.codes) - 1)
        known = self.codes[at] == a
        return np.where(known, self.begin[at], 0), np.where(known, self.counts[at], 0)


def _joined(first: np.ndarray, end: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs in order of diagonal and place, those that continue each other as one."""
    if not len(first):
        return first, end, d
    order = np.argsort(d.astype(np.int64) << 32 | first)
    first, end, d = first[order], end[order], d[order]
    fresh = np.concatenate([[True], (d[1:] != d[:-1]) | (first[1:] != end[:-1])])
    last = np.concatenate([np.flatnonzero(fresh)[1:] - 1, [len(first) - 1]])
    return first[fresh], end[last], d[fresh]


def _diagonal_runs(begin: np.ndarray, count: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, end, diagonal) of the maximal runs, by their places in ``a``; found
    for parts of ``a`` of about ``PART_POINTS`` equal places, then joined."""
    total = np.cumsum(count)
    cuts = np.searchsorted(total, np.arange(0, int(total[-1]) if len(total) else 0, PART_POINTS), "right")
    found = []
    for lo, hi in zip(cuts, [*cuts[1:], len(count)]):
        n = count[lo:hi]
        i = np.repeat(np.arange(lo, hi, dtype=np.int32), n)
        j = places[np.arange(len(i)) - np.repeat(np.cumsum(n) - n - begin[lo:hi], n)].astype(np.int32)
        found.append(_joined(i, i + np.int32(1), j - i))
    if not found:
        return (np.empty(0, np.int32),) * 3
    return found[0] if len(found) == 1 else _joined(*(np.concatenate(part) for part in zip(*found)))


def _longest_clipped(runs, alo: int, ahi: int, blo: int, bhi: int):
    """The part's runs, and (length, place in a, place in b) of its longest."""
    first, end, d = runs
    low = np.maximum(np.maximum(first, alo), blo - d)
    size = np.minimum(np.minimum(end, ahi), bhi - d) - low
    inside = size > 0
    own = first[inside], end[inside], d[inside]
    low, size = low[inside], size[inside]
    if not len(size):
        return own, (0, alo, blo)
    n = int(size.max())
    x, y = min((int(low[k]), int(low[k]) + int(own[2][k])) for k in np.flatnonzero(size == n))
    return own, (n, x, y)


def _longest_swept(begin, count, places, alo: int, ahi: int, blo: int, bhi: int) -> tuple[int, int, int]:
    """As ``_longest_clipped``, a place of ``a`` at a time: lengths of the runs
    that end there, from those that ended one place before."""
    best = (0, alo, blo)
    ends = lengths = np.empty(0, np.int64)
    for i in range(alo, ahi):
        here = places[begin[i]:begin[i] + count[i]]
        here = here[np.searchsorted(here, blo):np.searchsorted(here, bhi)]
        n = np.ones(len(here), np.int64)
        if len(ends) and len(here):
            at = np.searchsorted(ends, here - 1).clip(max=len(ends) - 1)
            n += np.where(ends[at] == here - 1, lengths[at], 0)
        if len(n):
            k = int(n.argmax())
            if n[k] > best[0]:
                best = (int(n[k]), i + 1 - int(n[k]), int(here[k]) + 1 - int(n[k]))
        ends, lengths = here, n
    return best


def matching_blocks(a: str, b: str, autojunk: bool = True, max_points: int | None = None) -> list[tuple[int, int, int]]:
    """(place in a, place in b, length) of the matching blocks, in order."""
    if not a or not b:
        return []
    index = _Places(_codes(b), autojunk)
    begin, count = index.of(_codes(a))
    swept = int(count.sum()) > (MAX_POINTS if max_points is None else max_points)
    runs = None if swept else _diagonal_runs(begin, count, index.places)
    blocks = []
    parts = [(0, len(a), 0, len(b), runs)]
    while parts:
        alo, ahi, blo, bhi, runs = parts.pop()
        if swept:
            n, i, j = _longest_swept(begin, count, index.places, alo, ahi, blo, bhi)
        else:
            runs, (n, i, j) = _longest_clipped(runs, alo, ahi, blo, bhi)
        end_a, end_b = i + n, j + n
        while i > alo and j > blo and a[i - 1] == b[j - 1]:
            i, j = i - 1, j - 1
        while end_a < ahi and end_b < bhi and a[end_a] == b[end_b]:
            end_a, end_b = end_a + 1, end_b + 1
        if end_a == i:
            continue
        blocks.append((i, j, end_a - i))
        if alo < i and blo < j:
            parts.append((alo, i, blo, j, runs))
        if end_a < ahi and end_b < bhi:
            parts.append((end_a, ahi, end_b, bhi, runs))
    return sorted(blocks)


def ratio(a: str, b: str, autojunk: bool = True) -> float:
    """Twice the matching characters over all characters; 1.0 for two empty texts."""
    if not a and not b:
        return 1.0
    return 2.0 * sum(n for _, _, n in matching_blocks(a, b, autojunk)) / (len(a) + len(b))
