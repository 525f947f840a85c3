"""MinHash, decontamination, suffix arrays, revisits, components, pipeline."""

import hashlib
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash

from colloquy.llm import clusters, decontam, graph, gsaca, minhash, suffix, urls, warc
from tests.conftest import SMALL_SF

DOC = "doc_id long, text string"
ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII))


def shingles(text):
    w = words_of(text)
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def components_of(rows):
    """Smallest id reachable per id, by comparing all pairs."""
    ids = sorted({i for i, _ in rows if i is not None})
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    up = {i: i for i in ids}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((root(i), root(j)))
                up[y] = x
    return {i: root(i) for i in ids}


# ---- MinHash ----------------------------------------------------------------

@pytest.fixture(scope="module")
def copies():
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefghijkl") for _ in range(4))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "One two"), (6, "one two three"), (6, "one two three"),
            (7, "two one"), (8, "x " * 4000)]
    n = 10
    for _ in range(12):
        base = [word() for _ in range(rng.randint(30, 120))]
        for _ in range(rng.randint(1, 12)):
            w = list(base)
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = word()
            rows.append((n, " ".join(w)))
            n += 1
    rng.shuffle(rows)
    return rows


def test_op2(spark, copies):
    df = spark.createDataFrame([(*r, 1) for r in copies], f"{DOC}, keys int")
    got = minhash.op2_minhash(df).collect()
    want = components_of(copies)
    assert len(got) == len(copies)
    assert {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got} == {
        (i, len(shingles(t)), want[i], want[i] == i) for i, t in copies}
    assert len({r.component_id for r in got}) < len(got)


def test_small_blocks_lose_nothing(spark, copies, monkeypatch):
    monkeypatch.setattr(clusters, "BLOCK", 2)
    got = minhash.op2_minhash(spark.createDataFrame(copies, DOC)).collect()
    want = components_of(copies)
    assert {(r.doc_id, r.component_id) for r in got} == {(i, want[i]) for i, _ in copies}


def test_rows_without_an_id_and_empty_table(spark):
    rows = [(None, "a b c d e f"), (9, "a b c d e f"), (None, "unlike the rest of all this"), (None, None)]
    got = sorted((str(r.doc_id), str(r.component_id), r.kept) for r in
                 minhash.op2_minhash(spark.createDataFrame(rows, DOC)).collect())
    assert got == [("9", "9", True), ("None", "9", False), ("None", "None", True), ("None", "None", True)]
    docs = spark.createDataFrame([*rows, (9, "a b c d e f"), (10, "A b c d e f")], DOC)
    left = minhash.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    assert Counter(r.doc_id for r in left.collect()) == {9: 1, None: 3}
    assert minhash.op2_minhash(spark.createDataFrame([], DOC)).count() == 0


def test_other_texts_of_an_id_stay(spark):
    rows = [(1, "x y z a b c d"), (2, "x y z a b c d"), (2, "another text that is not like it at all"), (2, "X y z a b c d"),
            (3, "another text that is not like it at all"), (3, ""), (3, None), (3, "")]
    got = minhash.op2_minhash(spark.createDataFrame(rows, DOC)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == [
        (1, 3, 1), (2, 3, 1), (2, 3, 1), (2, 5, 2), (3, 0, 3), (3, 0, 3), (3, 0, 3), (3, 5, 2)]
    left = minhash.drop_near_duplicates(spark.createDataFrame(rows, DOC)).collect()
    assert sorted(((r.doc_id, r.text) for r in left), key=str) == [
        (1, "x y z a b c d"), (2, "another text that is not like it at all"), (3, ""), (3, None)]


def test_signature_estimates_the_similarity():
    rng = np.random.default_rng(1)
    a = np.unique(rng.integers(0, 1 << 63, 4000, np.uint64))
    b = np.concatenate([a[:3000], rng.integers(0, 1 << 63, 1000, np.uint64)])
    same = (minhash.signature(a) == minhash.signature(b)).mean()
    assert abs(same - 3000 / 5000) < 0.12


def test_components_of_a_long_chain(spark):
    edges = [(k, k + 1) for k in range(0, 50)] + [(500, 400), (7, 7)]
    got = {r.node: r.component for r in graph.connected_components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    assert set(got) == {*range(51), 400, 500} and {got[k] for k in range(51)} == {0} and got[500] == 400


# ---- decontamination --------------------------------------------------------

def weighted(window, item, items):
    """The similarity by its definition."""
    runs = lambda w: Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    a, b = runs(window), runs(item)
    raw = {s: 1 / sum(s in runs(i) for i in items) for s in b}
    mean = sum(raw.values()) / len(raw)
    weight = lambda s: raw[s] / mean if s in raw else 1.0
    return (sum(weight(s) * min(a[s], b[s]) for s in a | b) / sum(weight(s) * max(a[s], b[s]) for s in a | b))


def test_op9_against_all_windows(spark):
    rng = random.Random(5)
    word = lambda: "w%d" % rng.randint(0, 400)
    items = [[word() for _ in range(rng.randint(12, 40))] for _ in range(12)] + [["too", "short"]]
    items[3][4:12] = items[2][4:12]  # words that two items share
    rows = [(1, None), (2, ""), (None, " ".join(items[0])), (3, "few words"), (4, " ".join(items[1]).upper())]
    for k in range(10, 70):
        w = [word() for _ in range(rng.randint(5, 200))]
        if k % 2:
            part = list(rng.choice(items[:-1]))
            for _ in range(rng.randint(0, 2)):
                part[rng.randrange(len(part))] = "changed"
            at = rng.randrange(len(w))
            w[at:at] = part
        rows.append((k, rng.choice(["\t", " "]).join(w)))
    rows += rows[-3:]
    bench = spark.createDataFrame([(k, " ".join(i)) for k, i in enumerate(items)] + [(99, None)], "item_id long, text string")
    docs = spark.createDataFrame([(*r, 0) for r in rows], f"{DOC}, size int")
    got = decontam.op9_decontamination(docs, bench).collect()
    want = {}
    for i, t in rows:
        w = words_of(t)
        for k, item in enumerate(items[:-1]):
            best = max((weighted(w[s:s + len(item)], item, items) for s in range(max(1, len(w) - len(item) + 1))), default=0)
            if len(w) >= 5 and best >= 0.75:
                want[i, k] = round(best, 6)
    assert {(r.doc_id, r.item_id): r.similarity for r in got} == pytest.approx(want)
    assert len(got) == len(want) >= 10
    left = decontam.drop_contaminated(docs, bench)
    assert left.columns == docs.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(str(i) for i, _ in rows if i not in {d for d, _ in want})
    none = spark.createDataFrame([], DOC)
    assert decontam.op9_decontamination(none, bench).count() == 0
    assert decontam.op9_decontamination(docs, bench.limit(0)).count() == 0


def test_op9_swapped_halves_against_all_windows(spark):
    rng = random.Random(6)
    some = lambda n: [f"w{rng.randrange(4000)}" for _ in range(n)]
    items = [some(50), some(51), some(30), some(40)]
    items[3][20:] = items[3][:20]  # shingles that an item has twice
    texts = [some(40) + items[0][25:] + items[0][:25] + some(40), items[1][17:34] + items[1][34:] + items[1][:17] + some(30),
             some(200) + items[2][15:] + items[2][:15], items[3][:20] * 5 + some(7), items[0][:44], items[0][25:] + items[0][:20],
             items[0] * 3 + some(9) + items[2], some(60) + items[0][:20] + some(9) + items[0][20:]]
    bench = spark.createDataFrame([(k, " ".join(i)) for k, i in enumerate(items)], "item_id long, text string")
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], DOC)
    want = {}
    for d, w in enumerate(texts):
        for k, item in enumerate(items):
            best = max(weighted(w[s:s + len(item)], item, items) for s in range(max(1, len(w) - len(item) + 1)))
            if best >= 0.75:
                want[d, k] = round(best, 6)
    assert want[0, 0] == round(42 / 50, 6) and len(want) >= 6
    got = {(r.doc_id, r.item_id): r.similarity for r in decontam.op9_decontamination(docs, bench).collect()}
    assert got == pytest.approx(want)


def test_op9_benchmark_with_repeats_shared_and_null_ids(spark):
    rng = random.Random(8)
    some = lambda n: " ".join(f"w{rng.randrange(400)}" for _ in range(n))
    repeated, one, two, three, four = (some(30) for _ in range(5))
    bench = spark.createDataFrame([("r", repeated), ("r", repeated), ("r", repeated + " "), ("shared", one), ("shared", two),
                                   (None, three), (None, four), (None, four), (None, None)], "item_id string, text string")
    texts = [f"{some(20)} {x} {some(20)}" for x in (repeated, one, two, three, four, f"{one} {some(9)} {two}")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted((r.doc_id, r.item_id or "", r.similarity, r.start_word, r.n_words)
                 for r in decontam.op9_decontamination(docs, bench).collect())
    assert got == [(0, "r", 1.0, 20, 30), (1, "shared", 1.0, 20, 30), (2, "shared", 1.0, 20, 30), (3, "", 1.0, 20, 30),
                   (4, "", 1.0, 20, 30), (5, "shared", 1.0, 20, 30), (5, "shared", 1.0, 59, 30)]


def test_decontamination_plan_has_no_python(spark):
    plan = decontam.op9_decontamination(spark.read.parquet(f"{SMALL_SF}/documents.parquet"),
                                        spark.read.parquet(f"{SMALL_SF}/benchmark.parquet"))
    assert not re.search("Python|Pandas|Arrow", plan._jdf.queryExecution().toString())


def test_blocks_find_all_within_the_radius():
    masks = decontam.blocks(20)
    assert len(masks) == 21 and sum(bin(m & (1 << 64) - 1).count("1") for m in masks) == 64
    rng = random.Random(1)
    for _ in range(200):
        x = rng.getrandbits(64)
        y = x
        for bit in rng.sample(range(64), 20):
            y ^= 1 << bit
        assert any((x ^ y) & m & (1 << 64) - 1 == 0 for m in masks)


# ---- suffix arrays ----------------------------------------------------------

def test_suffix_array_against_sorting():
    rng = random.Random(2)
    for _ in range(4000):
        letters = rng.choice([b"a", b"ab", b"abc", bytes(range(256))])
        t = bytes(rng.choice(letters) for _ in range(rng.randint(0, 40)))
        assert gsaca.suffix_array(t) == sorted(range(len(t)), key=lambda i: t[i:]), t


def removed_by_definition(rows):
    start, out = {}, []
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    key = lambda i, t: (-(1 << 63) if i is None else i,
                        signed(xxhash.xxh64_intdigest((t or "").encode(), 42)))
    for i, t in sorted(set(rows), key=lambda r: key(*r)):
        b = (t or "").encode()
        for k in range(len(b) - 99):
            start.setdefault(b[k:k + 100], (key(i, t), k))
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - 99):
            if start[b[k:k + 100]] != (key(i, t), k):
                gone[k:k + 100] = b"\1" * 100
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(map(str, out))


@pytest.mark.parametrize("large", [suffix.LARGE, 3])
def test_op6(spark, monkeypatch, large):
    monkeypatch.setattr(suffix, "LARGE", large)  # 3: nearly all owners go the other way
    rng = random.Random(4)
    text = lambda n: " ".join("".join(rng.choice("abcdeéfgh") for _ in range(rng.randint(1, 7))) for _ in range(n))
    parts = [text(rng.randint(15, 60)) for _ in range(12)]
    rows = [(None, parts[0]), (1, None), (2, ""), (3, "a" * 1000), (4, "ab" * 700 + "a" * 300), (5, "x" * 99),
            (6, "x" * 100), (7, "x" * 100), (7, "x" * 100)]
    for i in range(120):
        some = []
        for _ in range(rng.randint(1, 6)):
            p = rng.choice(parts)
            some.append(rng.choice([text(rng.randint(1, 40)), p, p[rng.randint(0, 80):], p[:rng.randint(100, 300)]]))
        rows.append((10 + i, rng.choice([" ", "", "\n"]).join(some)))
    # one id with several texts, several null ids, equal rows
    alone = text(90)
    rows += [(12, parts[3] + text(30)), (12, alone), (12, parts[3]), (None, parts[0]), (None, parts[4]), (None, alone + "!")]
    df = spark.createDataFrame([(*r, "mine") for r in rows], f"{DOC}, h string")
    got = sorted(str(tuple(r)) for r in suffix.op6_suffix_dedup(df).collect())
    assert got == removed_by_definition(rows)
    if large > 3:
        kept = {r.doc_id: r for r in suffix.op6_suffix_dedup(spark.createDataFrame(
            [(i, t, "mine") for i, t in rows if i is not None and i > 12], f"{DOC}, h string")).collect()}
        assert sorted(map(str, (tuple(r) for r in kept.values()))) == removed_by_definition(
            [r for r in rows if r[0] is not None and r[0] > 12])  # no shared id: the other key
        assert suffix.op6_suffix_dedup(spark.createDataFrame([], DOC)).count() == 0


# ---- revisits and SQL -------------------------------------------------------

def test_resolve_revisits(spark):
    h = lambda **kw: {k.replace("_", "-"): v for k, v in kw.items()}
    rows = [
        (1, "response", "http://A.com:80", 10, h(etag='"1"', date="d1", content_type="t"), "s1"),
        (2, "revisit", "HTTP://u@a.com/#x", 20, h(etag='W/"1"', date="d2", content_type="no"), "s1"),
        (3, "revisit", "http://a.com/", 30, h(etag='"2"'), "s1"),
        (4, "revisit", "http://a.com/", 5, h(), "s1"),
        (5, "revisit", "http://a.com/", 40, h(last_modified="x"), None),
        (6, "revisit", "http://a.com/", 10, None, "s1"),
        (7, "response", "http://a.com/", 50, h(last_modified="x"), "s2"),
        (8, "revisit", "http://a.com/", 60, h(last_modified="x"), None),
        (9, "revisit", None, 60, h(), "s1"), (10, "response", None, 50, h(), "s1"),
        (11, "revisit", "http://b.com/?b=2&a=1", 60, h(), "s9"), (12, "response", "http://b.com?a=1&b=2#z", 59, h(), "s9"),
        (13, "request", "http://a.com/", 70, h(), None), (14, "revisit", "http://a.com/", None, h(), "s2"),
    ]
    records = spark.createDataFrame([(*r, "mine") for r in rows],
                                    "record_id long, kind string, url string, at long, headers map<string,string>, "
                                    "digest string, status string")
    got = {r.record_id: r for r in warc.resolve_revisits(records).collect()}
    assert {k: (r.status, r.source_id) for k, r in got.items()} == {
        1: ("full", None), 2: ("resolved", 1), 3: ("mismatch", 1), 4: ("missing", None), 5: ("unchecked", 1),
        6: ("resolved", 1), 7: ("full", None), 8: ("resolved", 7), 9: ("missing", None), 10: ("full", None),
        11: ("resolved", 12), 12: ("full", None), 13: (None, None), 14: ("missing", None)}
    assert got[2].headers == {"etag": 'W/"1"', "date": "d2", "content-type": "t"}
    assert warc.resolve_revisits(records.limit(0)).count() == 0
    capitals = spark.createDataFrame(
        [(1, "response", "http://a/", 1, {"ETag": '"1"', "X": "y"}, None),
         (2, "revisit", "http://a/", 2, {"ETAG": 'W/"1"', "Date": "d", "date": "e"}, None),
         (3, "revisit", "http://a/", 3, {"etag": '"2"'}, None)],
        "record_id long, kind string, url string, at long, headers map<string,string>, digest string")
    cased = {r.record_id: r for r in warc.resolve_revisits(capitals).collect()}
    assert [cased[k].status for k in (1, 2, 3)] == ["full", "resolved", "mismatch"]
    assert cased[2].headers["etag"] == 'W/"1"' and cased[2].headers["x"] == "y" and cased[2].headers["date"] in ("d", "e")
    hot = [(k, "response" if k % 50 == 0 else "revisit", "http://hot/", k, {}, "s") for k in range(2000)]
    out = warc.resolve_revisits(spark.createDataFrame(hot, records.schema.fieldNames()[:6] and
                                "record_id long, kind string, url string, at long, headers map<string,string>, digest string"))
    assert all(r.source_id == r.record_id // 50 * 50 for r in out.collect() if r.kind == "revisit")


def test_resolve_revisits_across_partitions_with_repeated_and_null_ids(spark):
    # one URL over several range partitions; every other response occurs twice, the others have no id
    rows = []
    for k in range(2000):
        if k % 50:
            rows.append((k, "revisit", "http://hot/", k, {}, f"s{k // 50}"))
        else:
            rows += [(None if k % 100 else k, "response", "http://hot/", k, {"x-at": str(k)}, f"s{k // 50}")] * (1 if k % 100 else 2)
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    try:
        out = warc.resolve_revisits(spark.createDataFrame(
            rows, "record_id long, kind string, url string, at long, headers map<string,string>, digest string")).collect()
    finally:
        spark.conf.unset(coalesce)
    assert len(out) == len(rows)
    for r in out:
        if r.kind == "revisit":
            at = r.record_id // 50 * 50
            assert (r.status, r.source_id, r.headers) == ("resolved", None if at % 100 else at, {"x-at": str(at)})


def test_parse_headers(spark):
    block = "HTTP/1.1 200 OK\r\nETag: a:b\r\nX: 1\nx:2\r\n: no\r\nbare\r\n"
    df = spark.createDataFrame([(block,), (None,)], "b string")
    got = [r[0] for r in df.select(warc.parse_headers(df["b"])).collect()]
    assert got == [{"etag": "a:b", "x": "2"}, {}]


@pytest.mark.parametrize("module, name", [(urls, "op1"), (warc, "op3")])
def test_against_sql(spark, module, name):
    pages = spark.read.parquet(f"{SMALL_SF}/pages.parquet")
    run = getattr(module, next(f for f in dir(module) if f.startswith(f"{name}_") and not f.endswith("_sql")))
    got = run(pages)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SMALL_SF}/pages.parquet'")
    want = con.execute(getattr(module, f"{name}_sql")())
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(got.columns)
    rows = lambda them: sorted(map(str, them))
    assert rows(tuple(r) for r in got.select(*columns).collect()) == rows(want.fetchall())


def test_op9_item_of_five_thousand_words(spark):
    rng = random.Random(12)
    some = lambda n: [f"w{rng.randrange(900)}" for _ in range(n)]
    item = some(5000)
    changed = list(item)
    for at in range(0, 5000, 100):
        changed[at] = "changed"
    texts = [some(700) + item + some(300), some(50) + changed + some(2500), item[:2500] + some(2500), ["a", "b"] * 4000]
    bench = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(["a", "b"] * 1000))], "item_id long, text string")
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], DOC)
    got = {(r.doc_id, r.item_id): (r.similarity, r.start_word) for r in decontam.op9_decontamination(docs, bench).collect()}
    want = round(weighted(changed, item, [item, ["a", "b"] * 1000]), 6)
    assert got == {(0, 1): (1.0, 700), (1, 1): (pytest.approx(want), 50), (3, 2): (1.0, 0)}


def test_simhashes_of_a_run_of_windows(spark):
    rng = random.Random(13)
    hashes = [rng.getrandbits(64) - (1 << 63) for _ in range(60)]
    df = spark.createDataFrame([(hashes, 7, 20, 16), (hashes, 0, 0, 90)], "h array<long>, low int, high int, size int")
    rows = df.selectExpr(decontam.simhashes("h", "low", "high", "size") + " AS p").collect()
    plain = lambda part: sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in part) > len(part))
    assert [p & (1 << 64) - 1 for p in rows[0].p] == [plain(hashes[s:s + 16]) for s in range(7, 21)]
    assert [p & (1 << 64) - 1 for p in rows[1].p] == [plain(hashes)]
