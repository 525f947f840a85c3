"""Collocations against counts by brute force."""

import random
import re
from collections import Counter, defaultdict

import pytest

from colloquy.llm import collocations

SCHEMA = "lang string, text string, k int, n string"


def by_definition(rows, support, top):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        n[lang] += 0
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for i in range(len(words)):
                for k in range(1, min(5, len(words) - i) + 1):
                    f[lang][tuple(words[i:i + k])] += 1
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if a >= support}
        kept = []
        for p, a in found.items():
            if len(p) < 2 or any(len(q) > len(p) and b >= a and any(q[i:i + len(p)] == p for i in range(len(q)))
                                 for q, b in found.items()):
                continue
            score, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def texts(seed, count):
    rng = random.Random(seed)
    vocabulary = ["Aa", "aA", "b", "ü", "ß", "der", "\x00", "\x1c", " x", "*"]
    phrases = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(2, 6))) for _ in range(12)]
    rows = [(None, None), ("und", "a b"), ("en", ""), ("en", " ,;\n\t"), ("", "a\tb " * 300), (None, "x y.x y,x y"),
            ("de", "b " * 5000 + "der der")]
    for _ in range(count):
        parts = [rng.choice(phrases) if rng.random() < 0.7 else rng.choice(vocabulary) for _ in range(rng.randint(1, 30))]
        rows.append((rng.choice(["en", "en", "de", None, "fr"]),
                     "".join(p + rng.choice([" ", "  ", "\t", ". ", ",", "\n", "\r\n", "\x0b"]) for p in parts)))
    return rows + rows[-9:]


@pytest.mark.parametrize("least", [1, 2000])
def test_against_brute_force(spark, monkeypatch, least):
    monkeypatch.setattr(collocations, "LEAST_SHARD_BYTES", least)  # 1: many shards, local support 1
    rows = texts(1, 300)
    df = spark.createDataFrame([(*r, 3, "extra") for r in rows], SCHEMA).repartition(5)
    for support, top in ((3, 2000), (40, 7)):
        got = collocations.collocations(df, support=support, top=top)
        assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        assert sorted(map(tuple, got.collect())) == by_definition(rows, support, top)


def test_arithmetic_beyond_64_bits(spark, monkeypatch):
    counts = [("x", 0, "", 9_000_000_000_000_000_000), ("x", 1, "a", 7 * 10**14), ("x", 1, "b", 3 * 10**14 + 1),
              ("x", 2, "a b", 2 * 10**14 + 7)]
    monkeypatch.setattr(collocations, "frequent_phrases", lambda docs, *a: spark.createDataFrame(
        counts, "lang string, k int, phrase string, n long"))
    (row,) = collocations.collocations(None).collect()
    assert row.score == 1000 * counts[3][3] * counts[0][3] // (counts[1][3] * counts[2][3])


def test_empty_table(spark):
    assert collocations.op12_collocations(spark.createDataFrame([], SCHEMA)).collect() == []


def test_classes_and_steps_of_a_shard(monkeypatch):
    whole = collocations._Shard()
    text = random.Random(5).choices(["a", "b", "c", "d.", "e"], k=3000)
    whole.add(" ".join(text).encode())
    parts = list(whole.parts)
    mine = lambda: [(k, sorted(zip(t, c.tolist()))) for k, t, _, c in
                    whole.phrases("x", collocations._frequent(3), True)]
    want = mine()
    for step, size in ((1 << 20, 100), (7, 64), (1000, 1)):
        monkeypatch.setattr(collocations, "_STEP", step)
        monkeypatch.setattr(collocations, "_CLASS", max(size, 40))
        whole.parts = list(parts)
        assert mine() == want
    assert len(want) == 6
