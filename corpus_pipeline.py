"""Corpus pipeline: quality rules, near-duplicates, benchmark leaks, secrets, tokens.

Each stage works on all rows that the stage before kept.  All but the last
return the columns of ``documents``; what a stage returns is written as Parquet
and read again as the next one's input.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.llm import bpe, decontam, minhash, rules, secrets
from colloquy.llm.common import checkpoint_folder, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the learned list reject go."""
    return rules.filter_documents(docs, rules.learn(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that of the smallest id."""
    return minhash.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text; ``n_chars`` follows the masked text."""
    masked = secrets.redact(docs)
    return masked.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars"))
                             .otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_chars, n_tokens, ids, decodes): packed token ids
    of the text, and whether they decode to it again."""
    both = bpe.decode(bpe.encode(docs.select("doc_id", "lang", "source", "n_chars", "text")))
    return both.select("doc_id", "lang", "source", "n_chars", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       "ids", (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("decodes"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("tokens", tokens),
]

# Learned rules, automata and byte-level BPE have no SQL form; the tests hold
# every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{checkpoint_folder(spark)}/corpus-pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
