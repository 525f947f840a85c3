"""Secret scan, BPE, quality rules, toxicity, attribution, URL filters."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from colloquy.llm import attribution, bpe, rules, secrets, toxicity, urls

DOC = "doc_id long, text string"
EDGE = [(1, None), (2, ""), (2, ""), (None, "plain words here"), (3, " \n\t "), (4, "é漢字 " * 3000)]


def with_clash(spark, rows, clash):
    """The rows with an extra column named like one of the results."""
    return spark.createDataFrame([(*r, "mine") for r in rows], f"{DOC}, {clash} string")


# ---- secrets ----------------------------------------------------------------

def by_regex(text):
    out = []
    for k, r in enumerate(secrets.RULES):
        for m in re.finditer(r.pattern, text, (re.I | re.A) if r.ignore_case else re.A):
            if len(m.group()) >= r.min_chars and (not r.min_value or len(m.groups()[-1]) >= r.min_value):
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_automaton_equals_regex():
    a = secrets.automaton(secrets.RULES)
    rng = random.Random(3)
    bits = ["password", "PassWd", "secret", "token", "api_key", "APIkey", '"', "'", " ", ":", "=", "==", "abc",
            "abcdef12", "AKIA", "AKIAABCD1234", "0123456789abcdef", "é", "\n", "漢", "eyJ", ".", "-", "ghp_", "xoxb-",
            "-----BEGIN RSA PRIVATE KEY-----", "-----BEGIN ", "A" * 20, "f" * 25, "ſ", "K", ";"]
    for _ in range(3000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 14)))
        assert a.spans(text.encode()) == by_regex(text), text


def test_long_text_over_chunks():
    text = "x" * (1 << 16) + " token = abcdefgh " + "é" * 70000 + "f" * 30
    assert secrets.automaton(secrets.RULES).spans(text.encode()) == by_regex(text)


@pytest.mark.parametrize("pattern", ["a(bc)?", "bbbb|ab|abbc", "", "a.c", "(a", "a*"])
def test_patterns_that_are_refused(pattern):
    with pytest.raises(ValueError):
        secrets.Automaton((secrets.Rule("x", pattern),))


def test_op5(spark):
    rows = [*EDGE, (5, 'a token = "0123456789abcdef0123456789"'), (6, "AKIA" + "B" * 16)]
    got = {(r.doc_id, r.spans, r.n_assign, r.n_access, r.n_hex)
           for r in secrets.op5_secrets(with_clash(spark, rows, "spans")).collect()}
    assert (5, "assign:2:37,hex:11:37", 1, 0, 1) in got and (6, "access:0:20", 0, 1, 0) in got
    assert (1, "", 0, 0, 0) in got
    one = secrets.op5_secrets(spark.createDataFrame(rows[-2:-1], DOC)).first()
    assert one.base_sha256 == hashlib.sha256(b"assign:2:37,hex:11:37").hexdigest()
    masked = [r.text for r in secrets.redact(spark.createDataFrame(rows, DOC)).collect()]
    assert "a [secret]\"" in masked and None in masked
    assert secrets.op5_secrets(spark.createDataFrame([], DOC)).count() == 0


# ---- BPE --------------------------------------------------------------------

def test_join_equals_direct_encoding():
    c = bpe.codec(bpe.default_path())
    rng = random.Random(1)
    for letters in ("ab", "aeinrst ", "0123456789", " \n"):
        for _ in range(60):
            text = "".join(rng.choice(letters) for _ in range(rng.randint(2, 600))).encode()
            size = rng.randint(1, 64)
            leaves = [c.encode_piece(text[i:i + size]) for i in range(0, len(text), size)]
            assert c.concat(leaves) == c.encode_piece(text)


def test_op7(spark):
    rng = random.Random(2)
    run = "".join(rng.choice("abcdefghij") for _ in range(20000))
    rows = [*EDGE, (5, "hi <|endoftext|> you"), (6, run), (6, run), (7, "\n" * 6000 + "b" + " " * 6000),
            (None, "a " + "ab" * 6000 + " é <|endoftext|>" + run + "é" * 5000)]
    t = Tokenizer.from_file(bpe.default_path())

    def want(row):
        ids = t.encode(row[1] or "", add_special_tokens=False).ids
        text = t.decode(ids, skip_special_tokens=False)
        return (row[0], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                hashlib.sha256(text.encode()).hexdigest())

    got = [tuple(r) for r in bpe.op7_bpe(with_clash(spark, rows, "ids")).collect()]
    assert sorted(map(str, got)) == sorted(str(want(r)) for r in rows)
    assert bpe.op7_bpe(spark.createDataFrame([], DOC)).count() == 0


# ---- attribution ------------------------------------------------------------

@pytest.mark.parametrize("rule", attribution.RULES)
def test_allocate_against_loop(rule):
    rng = random.Random(rule)
    for _ in range(300):
        lengths = [rng.randint(1, 4) for _ in range(rng.randint(0, 12))]
        total = sum(lengths)
        edges = sorted(rng.randint(0, total) for _ in range(2 * rng.randint(0, 4)))
        spans = list(zip(edges[::2], edges[1::2]))
        got = attribution.allocate(np.array(lengths, np.int64), np.array([s for s, _ in spans], np.int64),
                                   np.array([e for _, e in spans], np.int64), rule)
        want, inside, crossing, share, at = ([0.0] * len(spans), [0] * len(spans), [0] * len(spans),
                                             [0.0] * len(spans), 0)
        for n in lengths:
            cover = [max(0, min(at + n, e) - max(at, s)) for s, e in spans]
            for k, c in enumerate(cover):
                share[k] += c / n
                inside[k] += c == n
                crossing[k] += 0 < c < n
            point = {"first": at, "last": at + n - 1}.get(rule)
            if rule == "share":
                want = share
            elif rule == "most":
                if max(cover, default=0):
                    want[cover.index(max(cover))] += 1
            else:
                for k, (s, e) in enumerate(spans):
                    want[k] += s <= point < e
            at += n
        for a, b in zip(got, (want, inside, crossing, share)):
            assert np.allclose(a, b), (rule, lengths, spans)


def test_op4(spark):
    rows = [*EDGE, (5, "one two\n\nthree é\nx"), (6, "a\n" * 400)]
    t = Tokenizer.from_file(bpe.default_path())
    got = attribution.op4_attribution(with_clash(spark, rows, "line")).collect()
    five = sorted((r.line, r.start, r.end) for r in got if r.doc_id == 5)
    assert five == [(0, 0, 8), (1, 8, 9), (2, 9, 17), (3, 17, 18)]
    for doc_id, text in rows[-3:]:
        ids = t.encode(text, add_special_tokens=False).ids
        assert sum(r.n_tokens for r in got if r.doc_id == doc_id) == len(ids)
        assert abs(sum(r.share for r in got if r.doc_id == doc_id) - len(ids)) < 0.01
    assert [(r.start, r.end, r.n_tokens) for r in got if r.doc_id == 1] == [(0, 0, 0)]
    text, sections = attribution.fields(["doc_id", "text"])
    both = spark.createDataFrame([(12, "ab")], DOC).select(text.alias("t"), sections.alias("s")).first()
    assert both.t == "12\nab" and [(s.name, s.start, s.end) for s in both.s] == [("doc_id", 0, 3), ("text", 3, 5)]
    assert attribution.op4_attribution(spark.createDataFrame([], DOC)).count() == 0


def tokens_of_sections(text, sections, rule):
    """Per section: tokens by the rule, inside, crossing and share, token by token."""
    tok = Tokenizer.from_file(bpe.default_path())
    ids = tok.encode(text, add_special_tokens=False).ids
    vocab = {v: k for k, v in tok.get_vocab().items()}
    raw, at, spans = text.encode(), 0, []
    for i in ids:  # a character of the byte alphabet is one byte
        spans.append((at, at + len(vocab[i])))
        at += len(vocab[i])
    assert at == len(raw)
    byte = [len(text[:k].encode()) for k in range(len(text) + 1)]
    clip = lambda x, d: d if x is None else min(max(x, 0), len(text))
    owner = [None] * len(raw)
    order = sorted(range(len(sections)), key=lambda k: clip(sections[k][1], 0))
    bounds = [(clip(s, 0), clip(e, len(text))) for _, s, e in sections]
    for k in order:
        low, high = bounds[k]
        if high > low:  # the next section's begin ends all before it
            for b in range(byte[low], len(raw)):
                owner[b] = None
            for b in range(byte[low], byte[high]):
                owner[b] = k
    out = [[0, 0, 0, 0.0] for _ in sections]
    for low, high in spans:
        own = owner[low:high]
        for k in {x for x in own if x is not None}:
            n = own.count(k)
            out[k][1 if n == high - low else 2] += 1
            out[k][3] += n / (high - low)
        k = {"first": own[0], "last": own[-1]}.get(rule, max((x for x in own if x is not None), key=lambda x: (
            own.count(x), -own.index(x)), default=None))
        if rule != "share" and k is not None:
            out[k][0] += 1
    return [(o[3] if rule == "share" else o[0], *o[1:]) for o in out]


@pytest.mark.parametrize("rule", attribution.RULES)
def test_any_borders_against_loop(spark, rule):
    rng = random.Random(11)
    border = lambda n: rng.choice([None, -3, 0, n, n + 5, 1 << 40, *[rng.randint(0, n + 1)] * 6])
    rows = []
    for i in range(60):
        text = "".join(rng.choice(["some words", " é", "漢字", "\n", "hello world ", "x", "🙂"]) for _ in range(rng.randint(0, 12)))
        rows.append((i, text, [(str(k), border(len(text)), border(len(text))) for k in range(rng.randint(0, 5))]))
    rows += [(60, None, [("a", 0, 5)]), (61, "abc", None), (62, "abc", [None, ("b", 1, None)])]
    df = spark.createDataFrame(rows, f"{DOC}, cuts array<struct<name:string,start:bigint,end:bigint>>")
    for r in attribution.attribute(df, df["cuts"], rule=rule).collect():
        _, text, cuts = rows[r.doc_id]
        want = tokens_of_sections(text or "", [c or (None, 0, 0) for c in cuts or ()], rule)
        got = [(s.n_tokens, s.n_inside, s.n_crossing, s.share) for s in r.sections]
        assert [s.name for s in r.sections] == [c and c[0] for c in cuts or ()]
        assert len(got) == len(want) and all(abs(x - y) < 1e-9 for g, w in zip(got, want) for x, y in zip(g, w)), rows[r.doc_id]


def test_op4_lines_against_loop(spark):
    rows = [(1, "one line\n\nthree é漢字\n  four"), (2, "\n\n\n"), (3, "no break at all"), (4, "a\r\nb \n 🙂🙂\n")]
    got = {(r.doc_id, r.line): (r.n_tokens, r.n_inside, r.n_crossing, r.share)
           for r in attribution.op4_attribution(spark.createDataFrame(rows, DOC)).collect()}
    for i, text in rows:
        for k, want in enumerate(tokens_of_sections(text, attribution.line_spans(text), "first")):
            assert got.pop((i, k)) == tuple(round(x, 6) for x in want)
    assert not got


# ---- quality rules ----------------------------------------------------------

def brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    inside = {j for i, r in enumerate(runs) if runs.count(r) > 1 for j in range(i, i + 8)}
    lines, dup = [], 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in lines
            lines.append(line)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(inside))


def test_op10(spark):
    rng = random.Random(1)
    fine = [(i, " ".join(rng.choice("abcdé") * rng.randint(1, 4) for _ in range(rng.randint(20, 60))) + "\nend\nend")
            for i in range(200)]
    junk = [(i + 1000, " ".join(rng.choice("abcd") + "$#" for _ in range(40))) for i in range(100)]
    rows = [*EDGE, *fine, *junk, (5000, "a b c d e f g h i " * 9)]
    labels = [(i, 1, 0) for i, _ in fine] + [(i, 0, 0) for i, _ in junk] + [(None, 0, 0), (7, None, 1)]
    truth = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    docs = with_clash(spark, rows, "counts")
    got = rules.op10_quality_rules(docs, truth).collect()
    key = lambda r: (str(r[0]), *r[1:])
    base = {(i, *brute_counts(t or "")) for i, t in rows}
    assert {(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got} == base
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words), key(r)
        if r.doc_id is not None and r.doc_id < 1000 and not r.base_failed:
            assert r.kept
        if r.doc_id is not None and 1000 <= r.doc_id < 5000:
            assert not r.kept
    kept = rules.filter_documents(docs, rules.learn(docs, truth))
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in got)
    assert rules.learn(docs, truth.limit(0)) == []
    empty = spark.createDataFrame([], DOC)
    assert rules.op10_quality_rules(empty, truth).count() == 0


def test_a_rule_is_cut_back():
    rng = np.random.default_rng(1)
    x = {"a": rng.random(900), "b": rng.random(900)}
    bad = x["a"] > 0.8
    out = rules.learn_arrays(x, bad, np.arange(900) % 3 == 0)
    assert [len(r) for r in out] == [1] and out[0][0].feature == "a" and abs(out[0][0].threshold - 0.8) < 0.05


# ---- toxicity ---------------------------------------------------------------

def test_op8(spark):
    rng = random.Random(4)
    sentence = lambda: " ".join(rng.choice(["sun", "tree", "walk", "blue", "house", "rain"]) for _ in range(6))
    rows, labels = [*EDGE], [(None, 1, 1), (1, 1, None)]
    for i in range(10, 700):
        parts = [sentence() for _ in range(rng.randint(1, 8))]
        bad = i % 3 == 0
        if bad:
            parts[rng.randrange(len(parts))] += rng.choice([" vile", " nasty"])
        rows.append((i, ". ".join(parts) + "."))
        labels.append((i, 1, int(bad)))
    truth = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = toxicity.op8_toxicity(with_clash(spark, rows, "score"), truth).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    tested = [r for r in got if r.doc_id is not None and r.doc_id >= 10 and r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    assert sum(r.predicted == (r.doc_id % 3 == 0) for r in tested) / len(tested) > 0.98
    texts = dict(rows)
    found = [texts[r.doc_id][s.start:s.end] for r in tested if r.predicted for s in r.sentences]
    assert found and all("vile" in f or "nasty" in f for f in found)
    assert toxicity.op8_toxicity(spark.createDataFrame([], DOC), truth).count() == 0


# ---- URL filters ------------------------------------------------------------

def test_op1(spark):
    given = [(1, None), (2, ""), (3, "no scheme"), (4, "http://A.example.NET/en/x?q=1"), (4, "http://A.example.NET/en/x?q=1"),
             (None, "https://example.net/de/"), (5, "https://notexample.com/de/"), (6, "https://www.example.com/de/1"),
             (7, "http://b.org/fr/"), (8, "http://b.org/fr"), (9, "http://x.net"), (10, "ftp://x.net?y/"),
             (11, "http://ads.site.com/p"), (12, "http://docs.site.com/cart/1"), (13, "http://site.com/cart/1"),
             (14, "http://x.com/" + "a/" * 30000 + "login"), (15, "http://x.com/login/help")]
    pages = spark.createDataFrame([(*g, "h") for g in given], "page_id long, url string, rule string")
    got = sorted(urls.op1_url_filter(pages).collect(), key=str)
    by_id = {r.page_id: r for r in got}
    verdicts = {k: (r.rule, r.verdict) for k, r in by_id.items()}
    assert verdicts[1] == verdicts[2] == verdicts[3] == verdicts[5] == (None, "allow") and by_id[1].host == ""
    assert verdicts[4] == ("example.net/en/", "allow") and by_id[4].host == "a.example.net"
    assert verdicts[None] == ("net/", "block") and verdicts[6] == ("example.com/de/", "block")
    assert verdicts[7] == ("org/fr/", "allow") and verdicts[8] == (None, "allow")
    assert verdicts[9] == verdicts[10] == (None, "allow") and by_id[10].path == ""
    assert verdicts[11] == (None, "block") and verdicts[12] == (None, "allow") and verdicts[13] == (None, "block")
    assert verdicts[14] == (None, "block") and verdicts[15] == (None, "allow")
    assert len(got) == len(given) and urls.op1_url_filter(pages.limit(0)).count() == 0


def test_shards_give_the_same(spark, monkeypatch):
    pages = spark.createDataFrame([(k, f"http://h{k}.{d}/{p}") for k in range(40) for d in ("net", "example.com", "org")
                                   for p in ("de/1", "fr/", "cart/", "")], "page_id long, url string")
    want = sorted(map(str, urls.op1_url_filter(pages).collect()))
    monkeypatch.setattr(urls, "SHARD", 3)
    assert sorted(map(str, urls.op1_url_filter(pages).collect())) == want


def test_index_tries_few_rules():
    index = urls.Index(tuple(urls.host_rule(f"h{k}.org/", "block") for k in range(500)), {"org": 10 ** 6})
    assert max(map(len, index.by_token.values())) == 1 and index.best("http://h7.org/", "h7.org/") == 7


# ---- the noisy-or against plain formulas ------------------------------------

def noisy_or(bags, w, bias):
    """1 - prod(1 - p) of a document's sentences, p logistic in its buckets."""
    none = 1.0
    for bag in bags:
        none *= 1 - 1 / (1 + np.exp(-(bias + sum(w.get(b, 0.0) for b in bag))))
    return 1 - none


def test_op8_score_is_the_noisy_or_of_the_sentences():
    rng = random.Random(5)
    words = ["bad", "worse", "terrible", "fine", "good", "words", "é", "漢字"]
    w = {b: rng.uniform(-2, 3) for x in words for b in toxicity._buckets(x.encode())}
    scorer = toxicity._Scorer(toxicity.Model(w, -2.5))
    for _ in range(200):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", ". ", "! ", "\n"]) for _ in range(rng.randint(0, 25)))
        score, spans = scorer.score(text.encode())
        assert abs(score - noisy_or(toxicity.bag_of(text.encode()), w, -2.5)) < 1e-9
        for start, end, p in spans:
            assert p > 0.5 and abs(p - noisy_or(toxicity.bag_of(text[start:end].encode()), w, -2.5)) < 1e-9


def test_op8_fit_descends_the_likelihood_of_the_noisy_or():
    """The fitted weights are those of the same descent with the gradient taken
    numerically from the plain likelihood."""
    rng = random.Random(6)
    docs, labels = [], []
    for k in range(80):
        y = k % 2
        bags = [[] for _ in range(rng.randint(1, 3))]
        rng.choice(bags).append(11 if y else 22)
        if y and rng.random() < 0.3:
            rng.choice(bags).append(22)
        for bag in bags:
            if rng.random() < 0.5:
                bag.append(33)  # says nothing: its rates do not differ clearly
        docs.append([sorted(set(b)) for b in bags])
        labels.append(y)
    flat = np.array([b for d in docs for s in d for b in s], np.int64)
    sentence_of = np.repeat(np.arange(sum(map(len, docs))), [len(s) for d in docs for s in d])
    doc_of = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    model = toxicity.Model.fit(flat, sentence_of, doc_of, np.array(labels))

    def loss(x):
        w = {11: x[0], 22: x[1]}
        p = [min(max(noisy_or(d, w, x[2]), 1e-12), 1 - 1e-12) for d in docs]
        return -np.mean([np.log(q if y else 1 - q) for q, y in zip(p, labels)]) + 1e-5 * (x[0] ** 2 + x[1] ** 2)

    x, past = np.array([0.0, 0.0, -9.0]), np.full(3, 1e-8)
    for _ in range(toxicity.ROUNDS):
        g = np.array([(loss(x + e) - loss(x - e)) / 2e-5 for e in np.eye(3) * 1e-5])
        past += g * g
        x -= 0.3 * g / np.sqrt(past)
    assert set(model.weights) == {11, 22}
    assert np.allclose([model.weights[11], model.weights[22], model.bias], x, atol=5e-3)
