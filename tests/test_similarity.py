"""Similarity kernels against plain definitions (DP edit distance, difflib)."""

import difflib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from colloquy.functions.matching import matching_blocks, ratio
from colloquy.functions.similarity import (diff_ratio, edit_distance, edit_distance_col,
                                           lev_similarity)


def dp(a, b):
    prev = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        cur = [i]
        for j, cb in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
        prev = cur
    return prev[-1]


text = st.text(alphabet=st.sampled_from(list("abcde éçàß\n")), max_size=150)


@settings(max_examples=300, deadline=None)
@given(text, text)
def test_bit_parallel_matches_dp(a, b):
    assert edit_distance(a, b) == dp(a, b)


def test_long_strings_cross_word_boundaries():
    a = "the quick brown fox " * 40
    b = a.replace("o", "0", 17)[5:] + "tail"
    assert edit_distance(a, b) == dp(a, b)


def test_exact_small_cases(spark):
    df = spark.createDataFrame([("é", "e"), ("çà", "ca"), ("tide", "diet"), ("diet", "tide"),
                                ("", ""), ("a", "")], "a string, b string")
    rows = df.select(F.levenshtein("a", "b").alias("native"), edit_distance_col("a", "b", 0).alias("k"),
                     diff_ratio("a", "b").alias("d"), lev_similarity("a", "b").alias("s")).collect()
    assert [r.native for r in rows[:2]] == [1, 2]
    assert [r.k for r in rows] == [r.native for r in rows]
    assert [r.d for r in rows][2:] == [0.25, 0.5, 1.0, 0.0]
    assert rows[4].s == 1.0 and rows[5].s == 0.0


def test_kernel_equals_native_on_random_pairs(spark):
    import random
    rnd = random.Random(7)
    alphabet = "abcdefg éüß"
    pairs = [("".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 300))),
              "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 300)))) for _ in range(120)]
    df = spark.createDataFrame(pairs, "a string, b string").repartition(4)
    rows = df.select("a", "b", F.levenshtein("a", "b").alias("native"),
                     edit_distance_col("a", "b", 0).alias("kernel"),
                     diff_ratio("a", "b").alias("d")).collect()
    for r in rows:
        assert r.kernel == r.native
        assert abs(r.d - difflib.SequenceMatcher(None, r.a, r.b).ratio()) < 1e-12


def test_autojunk_matters_for_long_texts(spark):
    import random
    rnd = random.Random(3)
    a = "".join(rnd.choice("abcd ") for _ in range(400))
    b = a[:200] + "X" + a[201:]
    df = spark.createDataFrame([(a, b)], "a string, b string")
    r = df.select(diff_ratio("a", "b").alias("j"), diff_ratio("a", "b", autojunk=False).alias("n")).first()
    assert r.j == difflib.SequenceMatcher(None, a, b).ratio()
    assert r.n == difflib.SequenceMatcher(None, a, b, autojunk=False).ratio()
    assert r.n > r.j


def test_trimmed_affixes_do_not_change_distance():
    from colloquy.functions.similarity import edit_distances
    A = ["prefix-abc-suffix", "same", "xyz", None]
    Bs = ["prefix-axc-suffix", "same", "", "a"]
    assert edit_distances(A, Bs) == [1, 0, 3, None]


def _edited(rnd, a, n):
    b = list(a)
    for _ in range(n):
        k = rnd.randrange(len(b) + 1)
        b[k:k + rnd.randint(0, 1)] = rnd.choice(["", "é", "the ", "\U0001f600"])
    return "".join(b)


def test_batched_distances_are_those_one_by_one():
    """Few and many edits, unlike texts and lengths, copies, empty and missing sides."""
    import random
    from colloquy.functions.similarity import edit_distances
    rnd = random.Random(11)
    texts = ["".join(rnd.choice("abc é\U0001f600") for _ in range(rnd.randint(0, 900))) for _ in range(160)]
    pairs = [(a, _edited(rnd, a, rnd.choice([0, 3, 30, 200]))) for a in texts] + list(zip(texts, texts[1:]))
    pairs += [(b, a) for a, b in pairs[:60]] + [("", "abc"), ("", ""), (None, "a"), ("a", None)]
    want = [None if a is None or b is None else edit_distance(a, b) for a, b in pairs]
    assert edit_distances(*zip(*pairs)) == want
    assert [edit_distance(a, b) for a, b in pairs[:12]] == [dp(a, b) for a, b in pairs[:12]]


def test_bands_hold_distances_up_to_their_width():
    import random
    from colloquy.functions.similarity import _banded_distances, banded_distance
    rnd = random.Random(12)
    texts = ["".join(rnd.choice("abc ") for _ in range(rnd.randint(1, 400))) for _ in range(60)]
    pairs = [(a, _edited(rnd, a, rnd.randint(0, 90)) or "x") for a in texts] + list(zip(texts, texts[1:]))
    want = [edit_distance(a, b) for a, b in pairs]
    for k in (1, 7, 63, 64, 65, 130, 500):
        held = [w if w <= k else None for w in want]
        assert [banded_distance(a, b, k) for a, b in pairs] == held
        assert _banded_distances(pairs, k) == held


def test_long_pairs_with_few_differences_take_no_whole_bit_vectors(monkeypatch):
    """The work goes with the distance, not with the square of the length."""
    import random
    from colloquy.functions import similarity as S
    rnd = random.Random(13)
    a = "".join(rnd.choice("abcdefg hij") for _ in range(60_000))
    pairs = [(a, _edited(rnd, a, 100)), (a, _edited(rnd, a, 1500)), (a[:3000], _edited(rnd, a[:3000], 40))]
    want = [S.edit_distance(x, y) for x, y in pairs]
    monkeypatch.setattr(S, "edit_distance", None)
    assert S.edit_distances(*zip(*pairs)) == want


def test_each_distinct_pair_is_scored_once(spark):
    from colloquy.operators.scoring import score_pairs
    a, b = "the patient said hello " * 20, "the student said hello " * 20
    rows = [(1, 2, a, b)] * 500 + [(3, 4, b, a)] * 3 + [(7, None, None, None)] * 50
    got = score_pairs(spark.createDataFrame(rows, "h1 long, h2 long, a string, b string").repartition(4)).collect()
    lev = 1 - dp(a, b) / len(a)
    assert sorted((r.h1, r.h2, round(r.levenshtein, 12)) for r in got) == [(1, 2, round(lev, 12)), (3, 4, round(lev, 12))]


def test_pairs_shared_by_many_runs_keep_every_row(spark):
    """Copies, empty, equal and missing sides: a row per prediction, as one by one."""
    from colloquy.operators.scoring import score_segments
    said = "the patient said hello " * 9
    pred = [(f"run{k}", "t1", 0, "Patient:" + said, said) for k in range(200)]
    pred += [("run0", "t2", 0, "", ""), ("run0", "t3", 0, "x", "x"), ("run1", "t3", 0, "", ""), ("run1", "t2", 0, "Patient: a", " a")]
    gold = [("t1", 0, "Doctor:" + said), ("t2", 0, "")]
    raw = [("t1", 0, said), ("t2", 0, " a")]
    got = score_segments(spark.createDataFrame(pred, "run_name string, id string, segment int, labelled string, bare string"),
                         spark.createDataFrame(gold, "id string, segment int, labelled string"),
                         spark.createDataFrame(raw, "id string, segment int, text string")).collect()
    assert len(got) == len(pred)
    g, r = {x[0]: x[2] for x in gold}, {x[0]: x[2] for x in raw}
    texts = {(p[0], p[1]): p[3:] for p in pred}
    for x in got:
        labelled, bare = texts[x.run_name, x.id]
        sides = {"pres": (r.get(x.id), bare), "baseline": (bare, g.get(x.id)), "acc": (g.get(x.id), labelled)}
        for name, (a, b) in sides.items():
            if a is None or b is None:
                assert x[f"lev_{name}"] is None and x[f"diff_{name}"] is None
            else:
                assert abs(x[f"lev_{name}"] - (1.0 if a == b else 1 - dp(a, b) / max(len(a), len(b)))) < 1e-12
                assert abs(x[f"diff_{name}"] - difflib.SequenceMatcher(None, a, b).ratio()) < 1e-12


prose = st.lists(st.sampled_from(["the ", "patient ", "é", "x", "said: ", "zoo\n", "q"]), max_size=90).map("".join)


@settings(max_examples=200, deadline=None)
@given(prose, prose, st.booleans())
def test_matching_blocks_are_those_of_the_definition(a, b, autojunk):
    want = [tuple(m) for m in difflib.SequenceMatcher(None, a, b, autojunk=autojunk).get_matching_blocks()[:-1]]
    got = matching_blocks(a, b, autojunk)
    assert sum(n for *_, n in got) == sum(n for *_, n in want)
    assert matching_blocks(a, b, autojunk, max_points=0) == got
    assert ratio(a, b, autojunk) == difflib.SequenceMatcher(None, a, b, autojunk=autojunk).ratio()


def test_a_part_without_rare_characters_matches_in_its_beginning():
    a, b = "ab" * 150, "ab" * 120 + "ba" * 10
    assert matching_blocks(a, b)[0][:2] == (0, 0)
    assert ratio(a, b) == difflib.SequenceMatcher(None, a, b).ratio()
    assert ratio("", "") == 1.0 and ratio("", "a") == 0.0
    assert ratio("\ud800x", "x\ud800") == difflib.SequenceMatcher(None, "\ud800x", "x\ud800").ratio()


def test_runs_of_a_long_pair_take_little_memory():
    import random
    import tracemalloc
    from colloquy.functions import matching as M
    rnd = random.Random(14)
    letters = [chr(0x400 + k) for k in range(40)]
    a, b = ("".join(rnd.choice(letters) for _ in range(6000)) for _ in range(2))
    points = sum(a.count(ch) * b.count(ch) for ch in letters)
    index = M._Places(M._codes(b), False)
    tracemalloc.start()
    first, end, d = M._diagonal_runs(*index.of(M._codes(a)), index.places)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert int((end - first).sum()) == points
    assert peak < 56 * points


@settings(max_examples=60, deadline=None)
@given(prose, prose, st.booleans())
def test_runs_found_in_parts_are_those_found_at_once(a, b, autojunk):
    from colloquy.functions import matching as M
    from unittest import mock
    at_once = matching_blocks(a, b, autojunk)
    with mock.patch.object(M, "PART_POINTS", 7):
        assert matching_blocks(a, b, autojunk) == at_once
