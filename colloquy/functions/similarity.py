"""String similarities used for scoring.

* normalised Levenshtein similarity ``1 - lev(a, b) / max(len a, len b)``,
  1.0 when the strings are equal (both empty included); code points.
* diff ratio: ``2 M / (len a + len b)``, M the characters in matching blocks
  (``colloquy.functions.matching``), autojunk on by default; equal to the
  standard library's ``SequenceMatcher(None, a, b).ratio()``.

Levenshtein runs JVM-side (``F.levenshtein``) for short pairs.  Its cost is
quadratic, so for long pairs an Arrow-batched kernel takes over whose cost goes
with the distance: labelled texts differ in few places, whatever their length.
The pairs of a batch are stepped together, a distance at a time, over the
furthest places that each diagonal reaches (Ukkonen 1985), in numpy.  Pairs
still open after ``_diagonal_steps`` steps go on to a bit-parallel kernel (Myers
1999 / Hyyro 2003) within a band of diagonals: together, in 64-bit words, or one
by one, on Python integers used as bit vectors, where texts are very long.  What
the widest band does not hold gets whole bit vectors.  Every result is the exact
distance.  ``F.when`` does not keep rows away from a
Python UDF, so short pairs are sent to the kernel as NULLs and the two results
are merged with ``coalesce``.

The diff ratio has no Spark built-in either; its kernel is numpy per pair.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colloquy.functions.matching import ratio
from colloquy.functions.text import col_

# The kernels travel with the task (pickled by value), so executors need not
# have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Pairs with len(a) * len(b) above this go to the Arrow kernel.
LEVENSHTEIN_NATIVE_MAX_CELLS = 4096


def _trim_affixes(a: str, b: str) -> tuple[str, str]:
    """Drop the common prefix and suffix (they never change the distance);
    found by halving with C-level slice compares."""
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[:mid] == b[:mid]:
            lo = mid
        else:
            hi = mid - 1
    a, b = a[lo:], b[lo:]
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[len(a) - mid:] == b[len(b) - mid:]:
            lo = mid
        else:
            hi = mid - 1
    return a[:len(a) - lo], b[:len(b) - lo]


def edit_distance(a: str, b: str) -> int:
    """Levenshtein distance (unit costs) by bit-parallel dynamic programming,
    one Python integer per bit vector."""
    if a == b:
        return 0
    a, b = _trim_affixes(a, b)
    if len(a) > len(b):
        a, b = b, a
    m = len(a)
    if m == 0:
        return len(b)
    match: dict[str, int] = {}
    bit = 1
    for ch in a:
        match[ch] = match.get(ch, 0) | bit
        bit <<= 1
    full = bit - 1
    top = bit >> 1
    pv, mv, dist = full, 0, m
    get = match.get
    for ch in b:
        eq = get(ch, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (full ^ (xh | pv))   # a carry bit above m may survive here; masked below
        mh = pv & xh
        if ph & top:
            dist += 1
        elif mh & top:
            dist -= 1
        ph = ((ph << 1) | 1) & full
        pv = ((mh << 1) & full) | (full ^ (xv | ph))
        mv = ph & xv
    return dist


def banded_distance(a: str, b: str, k: int) -> int | None:
    """Levenshtein distance if it is at most ``k``, else None: as
    ``edit_distance``, on the ``2 k + 1`` diagonals about the main one only.
    Bit ``r`` of a vector at place ``j`` of ``b`` is place ``j - k + r`` of ``a``,
    so the vectors move down by one place per step."""
    if len(a) > len(b):
        a, b = b, a
    m, n = len(a), len(b)
    if n - m > k:
        return None
    if 2 * k + 1 >= m:
        d = edit_distance(a, b)
        return d if d <= k else None
    width = 2 * k + 1
    full, top = (1 << width) - 1, 1 << (width - 1)
    # places above the text's beginning: as in the first column, no step downwards counts
    pv, mv = full ^ ((1 << k) - 1), 0
    seen: dict[str, tuple[int, int]] = {}
    for i in range(min(k, m)):
        bits, _ = seen.get(a[i], (0, 0))
        seen[a[i]] = (bits | 1 << (k + i), 0)
    dist = k                              # at the band's lowest place
    get = seen.get
    for j in range(n):
        if j + k < m:
            ch = a[j + k]
            bits, at = get(ch, (0, j))
            seen[ch] = (bits >> (j - at) | top, j)
        bits, at = get(b[j], (0, j))
        eq = bits >> (j - at)
        x = eq | mv
        d0 = ((((x & pv) + pv) ^ pv) | x) & full
        hp = mv | (full ^ (d0 | pv))
        hn = d0 & pv
        if j + k < m:                     # down the lowest diagonal of the band
            dist += not d0 & top
        else:                             # along the last place of a
            bit = 1 << (m - 1 - j + k)
            dist += bool(hp & bit) - bool(hn & bit)
        d0 >>= 1
        pv = hn | (full ^ (d0 | hp))
        mv = d0 & hp
    return dist if dist <= k else None


def _diagonal_steps(longest: int) -> int:
    """Distance up to which stepping diagonals is the cheaper kernel."""
    return 20 + int(1.75 * longest ** 0.5)


# pairs and characters stepped together, and places that a step looks ahead
_TOGETHER, _CHARACTERS, _LOOKS = 256, 2_000_000, (16, 256)
# texts from this length on are taken one by one, and so are fewer than _FEWEST pairs
_BANDED_FROM, _FEWEST = 16384, 16
# entries of the table of character places that go together
_TABLE = 1_000_000


def _small_distances(pairs: list[tuple[str, str]]) -> list[int | None]:
    """Distances of up to ``_diagonal_steps`` of pairs stepped together; None for
    larger ones.  ``far[p, d]`` is how far pair p gets into its first text on
    diagonal d (place in the first less place in the second) in e edits."""
    ahead = _LOOKS[-1]
    la, lb = (np.array([len(p[k]) for p in pairs]) for k in (0, 1))
    # texts one after another, each followed by an end mark that equals nothing of the other side
    parts = []
    starts = []
    place = 0
    for k, mark in ((0, -1), (1, -2)):
        first = []
        for p in pairs:
            codes = np.frombuffer(p[k].encode("utf-32-le", "surrogatepass"), np.int32)
            parts += [codes, np.full(1, mark, np.int32)]
            first.append(place)
            place += len(codes) + 1
        parts.append(np.full(ahead, mark, np.int32))
        place += ahead
        starts.append(np.array(first))
    text = np.concatenate(parts)
    windows = [np.lib.stride_tricks.sliding_window_view(text, size) for size in _LOOKS]
    (sa, sb) = starts
    steps = _diagonal_steps(int(max(la.max(), lb.max())))
    out: list[int | None] = [None] * len(pairs)
    live = np.flatnonzero(np.abs(la - lb) <= steps)
    width = 2 * steps + 3                          # diagonal d in column d + steps + 1
    far = np.full((len(live), width), -2, np.int64)
    for e in range(steps + 1):
        lo, hi = steps + 1 - e, steps + 2 + e
        d = np.arange(-e, e + 1)
        if e == 0:
            i = np.zeros((len(live), 1), np.int64)
        else:
            i = np.maximum(far[:, lo:hi] + 1, far[:, lo - 1:hi - 1] + 1)   # replaced, dropped from the first
            np.maximum(i, far[:, lo + 1:hi + 1], out=i)                    # put into it
        na, nb = la[live][:, None], lb[live][:, None]
        np.minimum(i, np.minimum(na, nb + d), out=i)
        valid = (i >= 0) & (i >= d)
        i[~valid] = -2
        x, y = (sa[live][:, None] + i)[valid], (sb[live][:, None] + i - d)[valid]
        reach = np.zeros(len(x), np.int64)
        on = np.flatnonzero(text[x] == text[y])
        view, size = windows[0], _LOOKS[0]
        while len(on):
            differ = view[x[on] + reach[on]] != view[y[on] + reach[on]]
            same = differ.argmax(1)
            same[~differ.any(1)] = size
            reach[on] += same
            on = on[same == size]
            view, size = windows[1], _LOOKS[1]
        i[valid] += reach
        far[:, lo:hi] = i
        goal = la - lb
        at = goal[live] + steps + 1
        done = far[np.arange(len(live)), at] >= la[live]
        if done.any():
            for p in live[done].tolist():
                out[p] = e
            live, far = live[~done], far[~done]
            if not len(live):
                break
    return out


def _banded_distances(pairs: list[tuple[str, str]], k: int) -> list[int | None]:
    """Distances of at most ``k`` of pairs of like length, None for larger ones.

    The first texts are cut into words of 64 places; word w takes place t - w of
    the second text at step t, so the words of all pairs go together and hand
    the step along their last place down.  Only words that the band of ``k``
    diagonals crosses are taken; what enters it from outside is an upper bound.
    A common beginning, which changes no distance, brings the first texts to one
    length."""
    pairs = [(a, b) if len(a) <= len(b) else (b, a) for a, b in pairs]
    la, lb = (np.array([len(p[side]) for p in pairs]) for side in (0, 1))
    count, words = len(pairs), -(-int(la.max()) // 64)
    pad = 64 * words - la
    ends = lb + pad
    codes = np.frombuffer("".join(a + b for a, b in pairs).encode("utf-32-le", "surrogatepass"), np.uint32)
    number = np.zeros(int(codes.max()) + 1, np.int64)
    number[codes] = 1
    number = number.cumsum()
    ids, kinds = number[codes], int(number[-1]) + 1               # 0: the beginning
    first = np.zeros((count, 64 * words), np.int64)
    second = np.zeros((int(ends.max()), count), np.int64)
    at = 0
    for p in range(count):
        first[p, pad[p]:] = ids[at:at + la[p]]
        second[pad[p]:ends[p], p] = ids[at + la[p]:at + la[p] + lb[p]]
        at += la[p] + lb[p]
    lane = np.arange(words)[:, None] * count + np.arange(count)
    places = np.zeros(words * count * kinds, np.uint64)
    spot = np.arange(64 * words)
    np.add.at(places, (lane[spot // 64].T * kinds + first).ravel(),
              np.tile(np.uint64(1) << (spot % 64).astype(np.uint64), count))
    lane *= kinds
    one, last = np.uint64(1), np.uint64(63)
    pv, mv = np.full((words, count), ~np.uint64(0)), np.zeros((words, count), np.uint64)
    score = np.repeat(64 * np.arange(1, words + 1)[:, None], count, 1)
    # the step along the last place of the word before: up, down
    up, down = np.ones((words + 1, count), np.uint64), np.zeros((words + 1, count), np.uint64)
    ending: dict[int, list[int]] = {}
    for p in range(count):
        ending.setdefault(int(ends[p]), []).append(p)
    out: list[int | None] = [None] * count
    steps, entered = len(second), 0
    for t in range(steps + words - 1):
        lo = max(0, t - steps + 1, -((63 + k - t) // 65))
        hi = min(words - 1, t, (t + k) // 65)
        if hi > entered:
            entered = hi
            score[hi] = score[hi - 1] - (up[hi].astype(np.int64) - down[hi].astype(np.int64)) + 64
        if lo > hi:                       # the band has left the texts
            break
        w = slice(lo, hi + 1)
        eq = places.take(lane[w] + second[t - hi:t - lo + 1][::-1])
        p_, m_, more, less = pv[w], mv[w], up[w], down[w]
        xv = eq | m_
        eq |= less
        xh = eq & p_
        xh += p_
        xh ^= p_
        xh |= eq
        ph = m_ | ~(xh | p_)
        mh = p_ & xh
        up_next, down_next = ph >> last, mh >> last
        ph <<= one
        mh <<= one
        ph |= more
        mh |= less
        np.bitwise_or(mh, ~(xv | ph), out=pv[w])
        np.bitwise_and(ph, xv, out=mv[w])
        up[lo + 1:hi + 2], down[lo + 1:hi + 2] = up_next, down_next
        up[lo], down[lo] = 1, 0
        score[w] += up_next.view(np.int64)
        score[w] -= down_next.view(np.int64)
        if hi == words - 1:
            for p in ending.get(t - hi + 1, ()):
                if score[hi, p] <= k:
                    out[p] = int(score[hi, p])
    return out


def _large_distance(a: str, b: str) -> int:
    """The distance of a pair that ``_small_distances`` left open."""
    longest = max(len(a), len(b))
    k = max(2 * _diagonal_steps(longest), abs(len(a) - len(b)))   # no distance is smaller
    while longest >= _BANDED_FROM and 8 * k < longest:
        dist = banded_distance(a, b, k)
        if dist is not None:
            return dist
        k *= 2
    return edit_distance(a, b)


def edit_distances(a_list, b_list) -> list:
    """Distances for a batch of pairs (None where a side is None)."""
    out = [None if (a is None or b is None) else 0 for a, b in zip(a_list, b_list)]
    # texts of like length have like numbers of steps; trimmed copies are made a part at a time
    order = sorted((p for p, a in enumerate(a_list) if out[p] is not None and a != b_list[p]),
                   key=lambda p: len(a_list[p]) + len(b_list[p]))
    lo, rest = 0, []
    while lo < len(order):
        part, size = [], 0
        while lo < len(order) and len(part) < _TOGETHER and (not part or size < _CHARACTERS):
            part.append(_trim_affixes(a_list[order[lo]], b_list[order[lo]]))
            size += len(part[-1][0]) + len(part[-1][1])
            lo += 1
        for p, dist in zip(order[lo - len(part):lo], _small_distances(part)):
            out[p] = dist
            if dist is None:
                rest.append(p)
    lo = 0
    while lo < len(rest):
        found = _together([_trim_affixes(a_list[p], b_list[p]) for p in rest[lo:lo + _TOGETHER]])
        for p, dist in zip(rest[lo:lo + len(found)], found):
            out[p] = dist
        lo += len(found)
    return out


def _together(pairs: list[tuple[str, str]]) -> list[int]:
    """Distances of the first of these pairs that ``_small_distances`` left open:
    as many as are of like length, through the word kernel if that pays."""
    least, hi, kinds = sum(map(len, pairs[0])), 0, set()
    while hi < len(pairs) and sum(map(len, pairs[hi])) <= 1.4 * least:
        more = kinds.union(*pairs[hi])
        if hi and (hi + 1) * (max(map(len, pairs[hi])) // 64 + 1) * (len(more) + 1) > _TABLE:
            break
        hi, kinds = hi + 1, more
    part = pairs[:hi]
    longest = max(len(text) for pair in part for text in pair)
    found: list[int | None] = [None] * hi
    if hi >= _FEWEST and longest < _BANDED_FROM:
        found = _banded_distances(part, 4 * _diagonal_steps(longest))
    return [_large_distance(a, b) if dist is None else dist for (a, b), dist in zip(part, found)]


def lev_similarity_py(a: str, b: str) -> float:
    """Reference semantics in plain Python (used by tests and kernels)."""
    if a == b:
        return 1.0
    longest = max(len(a), len(b))
    return 1.0 - edit_distance(a, b) / longest


@F.pandas_udf(T.LongType())
def _edit_distance_kernel(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(edit_distances(a.tolist(), b.tolist()), dtype="Int64")


@F.pandas_udf(T.DoubleType())
def _diff_ratio_kernel(a: pd.Series, b: pd.Series) -> pd.Series:
    out = [None if (x is None or y is None) else ratio(x, y, True) for x, y in zip(a, b)]
    return pd.Series(out, dtype="float64")


@F.pandas_udf(T.DoubleType())
def _diff_ratio_kernel_nojunk(a: pd.Series, b: pd.Series) -> pd.Series:
    out = [None if (x is None or y is None) else ratio(x, y, False) for x, y in zip(a, b)]
    return pd.Series(out, dtype="float64")


def edit_distance_col(a, b, native_max_cells: int = LEVENSHTEIN_NATIVE_MAX_CELLS) -> Column:
    """Levenshtein distance: JVM built-in for short pairs, Arrow kernel above."""
    a, b = col_(a), col_(b)
    la, lb = F.length(a), F.length(b)
    cells = la.cast("long") * lb.cast("long")
    long_pair = (cells > F.lit(native_max_cells)) & (a != b)
    kernel = _edit_distance_kernel(F.when(long_pair, a), F.when(long_pair, b))
    native = F.when(~long_pair, F.levenshtein(a, b).cast("long"))
    return F.coalesce(native, kernel)


def lev_similarity(a, b, native_max_cells: int = LEVENSHTEIN_NATIVE_MAX_CELLS) -> Column:
    """``1 - lev(a,b)/max(len a, len b)``; 1.0 for equal strings; NULL if a side is NULL."""
    a, b = col_(a), col_(b)
    longest = F.greatest(F.length(a), F.length(b)).cast("double")
    dist = edit_distance_col(a, b, native_max_cells).cast("double")
    return F.when(a == b, F.lit(1.0)).otherwise(F.lit(1.0) - dist / longest)


def diff_ratio(a, b, autojunk: bool = True) -> Column:
    """Diff ratio of ``a`` and ``b``; the argument order matters."""
    a, b = col_(a), col_(b)
    kernel = _diff_ratio_kernel if autojunk else _diff_ratio_kernel_nojunk
    # equal strings (both empty included): 1.0; one side empty: 0.0 -- stays in the JVM
    trivial = (a == b) | (F.length(a) == 0) | (F.length(b) == 0)
    shortcut = F.when(trivial, F.when(a == b, 1.0).otherwise(0.0))
    return F.coalesce(shortcut, kernel(F.when(~trivial, a), F.when(~trivial, b)))


def normed_gain(acc, base) -> Column:
    """Baseline-normed accuracy ``(acc - base) / (1 - base)``; NULL when base = 1."""
    acc, base = col_(acc), col_(base)
    return F.try_divide(acc - base, F.lit(1.0) - base)
