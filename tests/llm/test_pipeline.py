"""The corpus pipeline: each stage on the input it gets, against its operator's
brute-force version or its definition."""

import random

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from colloquy.llm import bpe, secrets
from tests.llm.test_corpus_operators import components_of

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables with known junk, copies, leaks and secrets."""
    d = str(tmp_path_factory.mktemp("tables"))
    rng = random.Random(8)
    text = lambda n: " ".join("".join(rng.choice("abcdefghijk") for _ in range(rng.randint(2, 7))) for _ in range(n))
    item = text(30)
    rows = {k: text(80) for k in range(200)}
    rows |= {200 + k: " ".join(w + "$#" for w in text(80).split()) for k in range(60)}
    rows |= {300 + k: rows[k] for k in range(10)}
    rows |= {320 + k: text(20) + " " + item + " " + text(20) for k in range(5)}
    rows |= {340 + k: text(30) + " password = abcdef123456 " + text(30) for k in range(5)}
    rows |= {360: None, 361: "", 362: text(30000)}
    labels = [(k, 0 if 200 <= k < 260 else 1, 0) for k in rows]
    docs = [(k, t, "en", "src", None if t is None else len(t)) for k, t in rows.items()]
    docs += [(None, text(80), None, None, None)] + docs[5:7]
    spark.createDataFrame(docs, COLUMNS).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name != "tokens":
            assert out.columns == docs.columns and out.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
        path = f"{folder}/out-{name}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        seen[name] = docs.collect()
    ids = {name: [r.doc_id for r in rows] for name, rows in seen.items()}
    # 360, 361 have under 20 words; the junk goes, everything clean stays
    clean = [*range(200), *range(300, 310), *range(320, 325), *range(340, 345), 362]
    assert sorted(map(str, ids["quality_rules"])) == sorted(map(str, [*clean, None, 5, 6]))
    group = components_of([(r.doc_id, r.text) for r in seen["quality_rules"] if r.doc_id is not None and r.doc_id != 362])
    stay = [k for k, v in group.items() if k == v]
    assert sorted(map(str, ids["near_duplicates"])) == sorted(map(str, [*stay, 362, None]))
    assert sorted(map(str, ids["decontamination"])) == sorted(
        str(k) for k in [*stay, 362, None] if k not in range(320, 325))
    before = {r.doc_id: r for r in seen["decontamination"]}
    a = secrets.automaton(secrets.RULES)
    for r in seen["secret_scan"]:
        assert r.text is None or not a.spans(r.text.encode())
        assert ("[secret]" in r.text) == (340 <= (r.doc_id or 0) < 345)
        assert r.text == before[r.doc_id].text or r.n_chars == len(r.text)
    t = Tokenizer.from_file(bpe.default_path())
    texts = {r.doc_id: r.text for r in seen["secret_scan"]}
    for r in seen["tokens"]:
        assert np.frombuffer(r.ids, "<u4").tolist() == t.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.decodes and 4 * r.n_tokens == len(r.ids)


@pytest.mark.parametrize("n", [0, 1])
def test_run(spark, folder, tmp_path, n):
    """Empty tables; and one table of every kind with a single fine document."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id = 3").limit(n)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(n).write.parquet(f"{tmp_path}/{name}.parquet")
    assert [r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()] == [3] * n
