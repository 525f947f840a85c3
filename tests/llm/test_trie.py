"""Prefix-tree join against all pairs."""

import random
import re
import tracemalloc

import numpy as np
import pytest
import xxhash

from colloquy.llm import clusters, common, trie

SCHEMA = "doc_id long, text string, node long, keys int"
ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII))
    return frozenset(tuple(w[i:i + 4]) for i in range(max(1, len(w) - 3))) if w else frozenset()


def by_definition(rows):
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= 85 * len(a | sets[j]):
                up[root(i)] = root(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        least.setdefault(root(k), []).append(i)
    least = {r: min((i for i in ids if i is not None), default=None) for r, ids in least.items()}
    return sorted(((i, len(s), least[root(k)]) for k, ((i, _), s) in enumerate(zip(rows, sets))), key=str)


def copies(seed, groups=14, edits=4):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(3))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "One two"), (6, "one two three"), (6, "one two three"),
            (7, "two one"), (8, "x " * 4000), (8, "another text of the same id, not like it"), (9, "X " * 4000)]
    line = [word() for _ in range(20)]
    n = 10
    for g in range(groups):
        base = [word() for _ in range(rng.choice([6, 9, 12, 30, 60, 200]))]
        if g % 3 == 0:
            base += line
        for _ in range(rng.randint(1, 14)):
            w = list(base)
            for _ in range(rng.randint(0, edits)):
                at = rng.randrange(len(w))
                w[at:at + rng.randint(0, 1)] = [word()] * rng.randint(0, 1)
            rows.append((rng.choice([n, n, n, None]), " ".join(w)))
            n += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [1024, 3])
def test_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(clusters, "BLOCK", block)
    rows = copies(block)
    got = trie.op13_ngram_join(spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA).repartition(4)).collect()
    assert sorted(map(tuple, got), key=str) == by_definition(rows)
    assert len({r.component_id for r in got}) < len(got) - 20


def test_empty_table(spark):
    assert trie.op13_ngram_join(spark.createDataFrame([], SCHEMA)).collect() == []


def test_linked_sets_share_a_key():
    rng = np.random.default_rng(3)
    new = lambda n: rng.integers(0, 1 << 63, n, np.uint64)
    for n in [*range(1, 40), 100, 333, 1000] * 3:
        a = np.unique(new(n))
        for gone in range(n + 1):  # the furthest link that this allows
            more = max(0, (100 * (n - gone) // 85) - n)
            if 100 * (n - gone) >= 85 * (n + more) and gone <= n // 6:
                b = np.unique(np.concatenate([a[gone:], new(more)]))
                if not np.array_equal(a, b) and 100 * (n - gone) >= 85 * (n + len(b) - n + gone):
                    assert set(trie.part_keys(a)) & set(trie.part_keys(b)), (n, gone, more)


def test_trie_finds_all_links():
    rng = np.random.default_rng(1)
    base = [np.unique(rng.integers(0, 60, rng.integers(1, 50))) for _ in range(12)]
    sets = [np.unique(np.where(rng.random(len(b)) < 0.05, rng.integers(0, 60, len(b)), b)).astype(np.uint32)
            for b in base for _ in range(8)]
    tree = trie.Trie(sets)
    mask = np.zeros(60, np.int64)
    for x in sets:
        got = sorted(np.array(tree.order)[tree.linked(x, mask, np.zeros(len(tree.end), bool))].tolist())
        assert got == [j for j, y in enumerate(sets)
                       if 100 * len(np.intersect1d(x, y)) >= 85 * len(np.union1d(x, y))]
    assert not mask.any()
    assert len(tree.flat) < sum(map(len, sets))  # equal beginnings are stored once


def linked(a, b):
    return 100 * len(np.intersect1d(a, b)) >= 85 * len(np.union1d(a, b))


@pytest.mark.parametrize("crossed", [False, True])
def test_sketches_lose_no_link(crossed):
    """Each pair by itself, at and beyond the furthest link, across widths of sketches."""
    rng = np.random.default_rng(4)
    new = lambda n: rng.integers(0, 1 << 63, n, np.uint64)
    left = dropped = 0
    for n in [*range(1, 70), 120, 128, 129, 500, 1023, 1024, 1025] * 2:
        a = np.unique(new(n))
        for gone, more in [(0, 0), (0, n * 15 // 85), (n * 15 // 100, 0), (n * 3 // 40, n * 3 // 40), (n // 20, n // 20), (n // 3, n // 3), (n // 5, n)]:
            b = np.unique(np.concatenate([a[gone:], new(more)]))
            got = trie.near([trie.sketch(a), trie.sketch(b)], np.array([len(a), len(b)]), np.array([5, 9]), np.array([0, int(crossed)]))
            if linked(a, b):
                assert len(got) == 1 and sorted(got[0]) == [0, 1], (n, gone, more)
            left, dropped = left + len(got), dropped + (not got)
    assert left > 300 and dropped > 150


def test_sketches_join_what_links_join():
    """In a block of many, of one or two sides: who is linked comes to be in one group."""
    rng = np.random.default_rng(5)
    base = [rng.integers(0, 1 << 63, n, np.uint64) for n in (3, 9, 30, 62, 66, 130, 260, 1030) * 2]
    sets = [np.unique(np.where(rng.random(len(b)) < 0.04, rng.integers(0, 1 << 63, len(b), np.uint64), b)) for b in base for _ in range(6)]
    labels = rng.integers(0, 70, len(sets))
    for sides in (np.zeros(len(sets), int), rng.integers(0, 2, len(sets))):
        edges = trie.near([trie.sketch(x) for x in sets], np.array([len(x) for x in sets]), labels, sides)
        group = labels.copy()
        for i, j in edges:
            assert group[i] != group[j]  # a forest
            assert not sides.any() or sides[i] != sides[j]
            group[group == group[j]] = group[i]
        for i, x in enumerate(sets):
            for j in range(i):
                if (not sides.any() or sides[i] != sides[j]) and linked(x, sets[j]):
                    assert group[i] == group[j]


def test_sets_are_built_only_of_nodes_that_may_be_linked(spark, monkeypatch):
    """Texts of one passage share keys; three of them are linked, the others far from it."""
    built, rng = [], random.Random(8)
    words = lambda n: [f"w{rng.randrange(10 ** 9)}" for _ in range(n)]
    passage = words(260)
    rows = [(k, " ".join(passage[:200] + words(60))) for k in range(30)]
    rows += [(100 + k, " ".join(passage[:-1 - k])) for k in range(3)]
    found = clusters.linked_components

    def seen(shared, sets, join):
        built.append((join.__name__, shared.select("node").distinct().count(), sets.count()))
        return found(shared, sets, join)
    monkeypatch.setattr(clusters, "linked_components", seen)
    got = trie.op13_ngram_join(spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA)).collect()
    assert sorted(map(tuple, got), key=str) == by_definition(rows)
    assert {r.component_id for r in got if r.doc_id >= 100} == {100}
    first, last = built[0], built[-1]
    assert first[1] > 20  # by keys many meet
    assert last == ("_trie_join", 3, 3)


def test_only_shared_keys_are_handed_on_when_every_bit_is_set(spark, monkeypatch):
    """A full bit array, as of a large corpus, tells nothing; keys of one node go all the same."""
    given = []
    monkeypatch.setattr(clusters, "bit_array", lambda hashes: b"\xff" * (1 << 23))
    shared_keys = clusters.shared_keys
    monkeypatch.setattr(clusters, "shared_keys", lambda members: given.extend(members.collect()) or shared_keys(members))
    rows = [(1, 11, 3, 7, [100, 101, 102]), (2, 12, 3, 7, [100, 101, 102]), (3, 13, 3, 8, [102, 103, -5]),
            (4, 14, 2, -9, [-5, 104]), (5, 15, 0, None, None)]  # the first two are copies
    signed = spark.createDataFrame(rows, "id long, th long, n long, node long, keys array<long>")
    classes = spark.createDataFrame([(7, 1, 11), (8, 3, 13), (-9, 4, 14)], "node long, id long, th long")
    found = clusters._shared(signed, classes).select("key", "node", "pivot").collect()
    expected = {(102, 7), (102, 8), (-5, 8), (-5, -9)}
    assert {(r.key, r.node) for r in given} == expected and len(given) == len(expected)
    assert {(r.key, r.node, r.pivot) for r in found} == {(102, 7, 7), (102, 8, 7), (-5, 8, -9), (-5, -9, -9)}


def test_hashes_of_words_kept_in_a_worker_stay_small():
    """What 300 thousand words leave behind; a task may have several workers."""
    words = [b"word%d" % k for k in range(300_000)]
    tracemalloc.start()
    try:
        kept = common._WordHashes()
        hashes = [kept[w] for w in words]
        assert hashes[::50_000] == [xxhash.xxh64_intdigest(w) for w in words[::50_000]]
        del words, hashes
        assert tracemalloc.get_traced_memory()[0] < 15 << 20
    finally:
        tracemalloc.stop()
