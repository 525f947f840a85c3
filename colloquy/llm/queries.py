"""The queries of the training-data operators (``opN_<name>``) and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from colloquy.llm import attribution, bpe, collocations, decontam, merkle, minhash, rules, secrets, suffix, toxicity, trie, urls, warc
from colloquy.llm.common import table


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_url_filter": lambda s, d: urls.op1_url_filter(table(s, d, "pages")),
        "op2_minhash": lambda s, d: minhash.op2_minhash(table(s, d, "documents")),
        "op3_warc": lambda s, d: warc.op3_warc(table(s, d, "pages")),
        "op4_attribution": lambda s, d: attribution.op4_attribution(table(s, d, "documents")),
        "op5_secrets": lambda s, d: secrets.op5_secrets(table(s, d, "documents")),
        "op6_suffix_dedup": lambda s, d: suffix.op6_suffix_dedup(table(s, d, "documents")),
        "op7_bpe": lambda s, d: bpe.op7_bpe(table(s, d, "documents")),
        "op8_toxicity": lambda s, d: toxicity.op8_toxicity(
            table(s, d, "documents"), table(s, d, "labels")),
        "op9_decontamination": lambda s, d: decontam.op9_decontamination(
            table(s, d, "documents"), table(s, d, "benchmark")),
        "op10_quality_rules": lambda s, d: rules.op10_quality_rules(
            table(s, d, "documents"), table(s, d, "labels")),
        "op11_merkle": lambda s, d: merkle.op11_merkle(table(s, d, "documents")),
        "op12_collocations": lambda s, d: collocations.op12_collocations(table(s, d, "documents")),
        "op13_ngram_join": lambda s, d: trie.op13_ngram_join(table(s, d, "documents")),
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_url_filter": urls.op1_sql(), "op3_warc": warc.op3_sql(), "op11_merkle": merkle.op11_sql(),
            "op12_collocations": collocations.op12_sql()}
