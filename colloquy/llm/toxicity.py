"""Toxicity by multiple-instance learning.

A document is a bag of sentences.  Every sentence has a probability of being
toxic (logistic in hashed words and word beginnings), and the document's is their
noisy-or, 1 - prod(1 - p): one toxic sentence is enough.  Only document labels
are needed to train the sentence weights; afterwards the sentences that carry
the score are known, and ``score`` returns where they are.

The model is fitted on at most MAX_ROWS labelled rows of either class, those
with the smallest hash of their id, outside the held-out fifth
(crc32(id as text) mod 5 = 0).  Only the text is ever an input.  Null or empty
texts have no sentence and score 0.  Labels that are null or have no id are
ignored, repeated labels count as the greatest.  Without labels of both classes
every text scores 0.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.llm.common import ship, text_bytes

BITS = 18
MAX_ROWS = 2500
FOLDS = 5
ROUNDS = 200
PREFIXES = (4, 5, 6)
LEAST_Z = 5.0        # how far a bucket's rates in the two classes must lie apart
_ENDS = b".!?\n"
# length-preserving: letters lower-cased, sentence ends to \n, other marks to spaces
_CLEAN = bytes(b + 32 if 65 <= b <= 90 else 10 if b in _ENDS else
               32 if b < 128 and not chr(b).isalnum() else b for b in range(256))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def sentences(text: bytes) -> list[tuple[int, list[bytes]]]:
    """(byte offset, words) of each sentence that has a word."""
    out, at = [], 0
    for part in text.translate(_CLEAN).split(b"\n"):
        if words := part.split():
            out.append((at, words))
        at += len(part) + 1
    return out


def _buckets(word: bytes) -> list[int]:
    """A word counts as itself and as its first four to six bytes."""
    return [xxhash.xxh64_intdigest(word[:k], 7 if k else 8) & ((1 << BITS) - 1)
            for k in (None, *(k for k in PREFIXES if len(word) > k))]


def bag_of(text: bytes) -> list[list[int]]:
    return [sorted(b for w in set(words) for b in _buckets(w)) for _, words in sentences(text)]


class Model:
    def __init__(self, weights: dict[int, float], bias: float):
        self.weights, self.bias = weights, bias

    @classmethod
    def fit(cls, flat: np.ndarray, sentence_of: np.ndarray, doc_of: np.ndarray, labels: np.ndarray) -> Model:
        """Full-batch gradient descent (adaptive steps) on the noisy-or
        likelihood, over the buckets whose document rates differ clearly.
        ``flat``: the buckets of all sentences in turn, ``sentence_of`` each
        one, ``doc_of`` each sentence."""
        if len(set(labels.tolist())) < 2:
            return cls({}, -np.inf)
        seen = np.unique((doc_of[sentence_of] << BITS) | flat)
        of = [np.bincount((seen & ((1 << BITS) - 1))[labels[seen >> BITS] == y], minlength=1 << BITS) for y in (0, 1)]
        size = np.bincount(labels, minlength=2).astype(float)
        rate = (of[0] + of[1] + 1) / (size.sum() + 2)
        z = (of[1] / size[1] - of[0] / size[0]) / np.sqrt(rate * (1 - rate) * (1 / size[0] + 1 / size[1]))
        clear = (np.abs(z) >= LEAST_Z)[flat]
        flat, sentence_of = flat[clear], sentence_of[clear]
        y, n = labels.astype(float), len(labels)
        w, bias = np.zeros(1 << BITS), -9.0
        past, past_bias = np.full(1 << BITS, 1e-8), 1e-8
        for _ in range(ROUNDS):
            z = bias + np.bincount(sentence_of, w[flat], minlength=len(doc_of))
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            none = np.exp(np.bincount(doc_of, np.log1p(-np.minimum(p, 1 - 1e-9)), minlength=n))
            any_ = np.maximum(1 - none, 1e-9)
            grad = p * np.where(y[doc_of] > 0, -none[doc_of] / any_[doc_of], 1.0) / n
            g = np.bincount(flat, grad[sentence_of], minlength=1 << BITS) + 2e-5 * w
            past += g * g
            past_bias += grad.sum() ** 2
            w -= 0.3 * g / np.sqrt(past)
            bias -= 0.3 * grad.sum() / np.sqrt(past_bias)
        kept = np.flatnonzero(np.abs(w) > 0.05)
        return cls(dict(zip(kept.tolist(), w[kept].tolist())), bias)


class _Scorer:
    """A model in a worker, with a bounded cache of word weights."""

    def __init__(self, model: Model):
        self.model = model
        weights = model.weights

        class Weights(dict):
            def __missing__(self, word):
                if len(self) > 400_000:
                    self.clear()
                v = self[word] = sum(weights.get(b, 0.0) for b in _buckets(word))
                return v
        self.weight = Weights().__getitem__

    def score(self, text: bytes) -> tuple[float, list[tuple[int, int, float]]]:
        """Document probability and the sentences over one half."""
        none, bad = 0.0, []
        for at, words in sentences(text):
            z = self.model.bias + sum(map(self.weight, set(words)))
            none -= np.logaddexp(0, z) if z > -30 else 0.0
            if z > 0:
                end = at
                while end < len(text) and text[end] not in _ENDS:
                    end += 1
                bad.append((at, min(end + 1, len(text)), float(1 / (1 + np.exp(-z)))))
        if bad and not text.isascii():
            before = np.concatenate([[0], np.cumsum(np.frombuffer(text, np.uint8) & 0xC0 != 0x80)])
            bad = [(int(before[a]), int(before[b]), p) for a, b, p in bad]
        return float(-np.expm1(none)), bad


@lru_cache(maxsize=2)
def _scorer(key: tuple) -> _Scorer:
    return _Scorer(Model(dict(key[0]), key[1]))


def train(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", max_rows: int = MAX_ROWS) -> Model:
    ship(documents.sparkSession)
    truth = (labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("y"))
             .filter("id IS NOT NULL AND y IN (0, 1)").groupBy("id").agg(F.max("y").alias("y"))
             .filter(~held_out(F.col("id"))))
    of = lambda y: truth.filter(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(max_rows)

    @F.arrow_udf("array<array<int>>")
    def bag(texts: pa.Array) -> pa.Array:
        return pa.array([bag_of(t) for t in text_bytes(texts)], pa.list_(pa.list_(pa.int32())))

    # the sample is 2 * max_rows small rows at most, so it may be broadcast
    rows = (documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .join(F.broadcast(of(0).union(of(1))), "id").select("id", "y", bag("text").alias("bag")).toArrow())
    order = np.argsort(rows["id"].to_numpy(), kind="stable")
    rows = rows.take(pa.array(order)).combine_chunks()
    y = rows["y"].to_numpy().astype(np.int64)
    of_docs = pa.concat_arrays(rows["bag"].chunks) if rows.num_rows else pa.array([], pa.list_(pa.list_(pa.int32())))
    of_sentences = of_docs.flatten()
    lengths = lambda lists: np.diff(lists.offsets.to_numpy())
    return Model.fit(of_sentences.flatten().to_numpy().astype(np.int64),
                     np.repeat(np.arange(len(of_sentences)), lengths(of_sentences)),
                     np.repeat(np.arange(len(of_docs)), lengths(of_docs)), y)


def score(df: DataFrame, model: Model, text_col: str = "text", out_col: str = "toxicity") -> DataFrame:
    """``df`` with ``struct<score, sentences>`` of every whole text; sentences
    are the spans (code points, end exclusive) whose own score is over 0.5."""
    ship(df.sparkSession)
    key = (tuple(sorted(model.weights.items())), model.bias)

    @F.arrow_udf("struct<score:double,sentences:array<struct<start:int,end:int,score:double>>>")
    def run(texts: pa.Array) -> pa.Array:
        s = _scorer(key)
        got = [s.score(t) for t in text_bytes(texts)]
        spans = [[{"start": a, "end": b, "score": p} for a, b, p in bad] for _, bad in got]
        return pa.StructArray.from_arrays(
            [pa.array([g[0] for g in got], pa.float64()),
             pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()),
                                                 ("score", pa.float64())])))], ["score", "sentences"])

    return df.withColumn(out_col, run.asNondeterministic()(F.col(text_col)))


def op8_toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    model = train(documents, labels)
    t = F.col("toxicity")
    return score(documents.select("doc_id", "text"), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), t["score"].alias("score"),
        (t["score"] >= 0.5).cast("int").alias("predicted"), t["sentences"].alias("sentences"))
