"""Merkle manifest against a plain tree."""

import hashlib
import random
import zlib

import pytest

from colloquy.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, g int, j string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(doc_id, source, lang, n_chars, text):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def tree(nodes):
    """Levels of runs of 8, up to the root."""
    levels = []
    while len(nodes) > 1:
        runs = [nodes[i:i + 8] for i in range(0, len(nodes), 8)]
        levels.append(runs)
        nodes = [H(*r) for r in runs]
    return levels, nodes[0]


def path(levels, j):
    for runs in levels:
        yield runs[j // 8], j % 8
        j //= 8


def by_definition(rows):
    groups = {}
    for doc_id, text, lang, source, n_chars in rows:
        leaf = leaf_of(doc_id, source, lang, n_chars, text)
        other = None
        if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0:
            lower = None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            other = leaf_of(doc_id, source, lang, n_chars, lower)
        groups.setdefault(lang, []).append((doc_id is not None, doc_id or 0, leaf, other or "", doc_id))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([x[2] for x in sorted(groups[g])]) for g in order}
    top, root = tree([trees[g][1] for g in order])
    out = []
    for place, g in enumerate(order):
        levels, subroot = trees[g]
        for j, (_, _, leaf, other, doc_id) in enumerate(sorted(groups[g])):
            steps = [*path(levels, j), *path(top, place)]
            h = other or leaf
            for run, at in steps:
                h = H(*run[:at], h, *run[at + 1:])
            proof = H(*[x for run, at in steps for k, x in enumerate(run) if k != at])
            out.append((doc_id, leaf, subroot, root, proof, h, h == root))
    return sorted(out, key=str)


def check(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    got = merkle.op11_merkle(df.repartition(3))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=str) == by_definition(rows)


def test_against_a_plain_tree(spark):
    rng = random.Random(3)
    rows = [(i, f"Text {i}" if i % 3 else f"text {i}", rng.choice(["de", "en", "en", None, ""]), "s", i)
            for i in rng.sample(range(-10**15, 10**15), 40) + rng.sample(range(3000), 700)]
    rows += [(7, None, "en", None, None), (8, "", "fr", "s", 0), (9, "É" * 3000, "fr", "s", 3000)]
    rows += rows[:20] + rows[:3]  # repeated rows
    rows += [(5, f"of one id {k}", "en", "s", 1) for k in range(60)] * 2
    rows += [(None, f"Without {k % 30}", rng.choice(["en", "xx", None]), "s", 2) for k in range(60)]
    rows += [(2**63 - 1, "LAST", "en", "s", 1), (-2**63, "FIRST", "en", "s", 1)]
    rng.shuffle(rows)
    check(spark, rows)


def test_more_leaves_than_a_slot_array(spark):
    check(spark, [(3 * i, f"T{i}", "en", "s", i) for i in range(5000)] + [(1, "A", "de", "s", 1)])


@pytest.mark.parametrize("few", [0, 3])
def test_directories_of_directories(spark, monkeypatch, few):
    monkeypatch.setattr(merkle, "FEW", few)
    check(spark, [(i * 7919 * 10**k, "T", "en", "s", i) for i in range(-40, 40) for k in (0, 9)][1:])


def test_one_row_and_none(spark):
    check(spark, [(3, "Lone", None, None, None)])
    assert merkle.op11_merkle(spark.createDataFrame([], SCHEMA)).collect() == []
