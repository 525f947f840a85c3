"""Suffix array by linear grouping construction.

Suffixes are grouped by their first symbol.  Groups are taken in descending
order; every member's previous-smaller pointer (the nearest suffix before it in
a smaller group) is found by following the pointers of the greater groups
already done, and the suffixes pointed at leave their group for a new one right
behind it, those with more pointers farther behind.  At the end the groups
stand in the order of their Lyndon prefixes, and one pass over the array emits
each suffix into its group along the pointers, without renaming or recursion.
"""

from __future__ import annotations


def suffix_array(text: bytes) -> list[int]:
    """Starts of the suffixes of ``text`` in lexicographic order."""
    n = len(text)
    symbols = [b + 1 for b in text]
    symbols.append(0)
    members: dict[int, list[int]] = {}
    buckets: list[list[int]] = [[] for _ in range(257)]
    for i, c in enumerate(symbols):
        buckets[c].append(i)
    group = [0] * (n + 1)       # a group is named by its first place in the order
    size: dict[int, int] = {}
    begin_at_end: dict[int, int] = {}
    at = 0
    for own in buckets:
        if own:
            for i in own:
                group[i] = at
            members[at], size[at] = own, len(own)
            begin_at_end[at + len(own)] = at
            at += len(own)
    prev = [-1] * (n + 1)
    end = n + 1
    while end > 0:
        g = begin_at_end[end]
        own = [i for i in members.pop(g) if group[i] == g]
        own.sort()
        pointers: dict[int, int] = {}
        for i in own:
            p = i - 1
            while p >= 0 and group[p] >= g:
                p = prev[p]
            prev[i] = p
            if p >= 0:
                pointers[p] = pointers.get(p, 0) + 1
        by_count: dict[int, dict[int, list[int]]] = {}
        for p, k in pointers.items():
            by_count.setdefault(k, {}).setdefault(group[p], []).append(p)
        for k in sorted(by_count, reverse=True):
            for old, moved in by_count[k].items():
                left = size[old] - len(moved)
                if left:
                    new = old + left
                    begin_at_end[old + size[old]] = new
                    begin_at_end[new] = old
                    size[old], size[new] = left, len(moved)
                    members[new] = moved
                    for p in moved:
                        group[p] = new
        end = g
    order = [0] * (n + 1)
    free: dict[int, int] = {}
    placed = bytearray(n + 1)
    order[0] = n
    placed[n] = 1
    for i in range(n + 1):
        j = order[i] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            at = free.get(g, g)
            order[at] = j
            free[g] = at + 1
            placed[j] = 1
            j = prev[j]
    return order[1:]
