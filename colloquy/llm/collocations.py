"""Phrases and their collocation scores, mined by SON partitioning.

1. A language's texts are dealt to shards of about equal size.  Each shard is
   mined completely, level by level: words, then phrases whose two shorter
   parts are frequent in the shard.  The local support is the global one
   lowered in proportion to the shard's share of the language's bytes, so a
   phrase that is frequent in the language is frequent in at least one shard.
2. The union of the locally frequent phrases, less those that cannot reach the
   support with the most that the other shards can add, is the candidate set.
3. All candidates are counted over all texts, exactly, and those below the
   global support go.  Sub-phrases of a candidate are candidates, so the counts
   that the scores need are there.

Scale.  A shard holds at most SHARD_BYTES and is held by one task as word
numbers (4 bytes a word); a phrase is named by the names of its two shorter
parts, so no hash decides its count.  The candidates reach the counting tasks
as one bit array of fixed size, filled by their hashes: it never grows, and
what it lets through by chance is counted exactly too, then falls below the
support.  With more than
100 shards a language the local support reaches 1 and every phrase of a shard
is a candidate: results stay exact, but the method no longer prunes.

Defined results.  Null language: ``und``, one with the texts so labelled.
Null or empty text: no words.  Repeated rows count as often as they occur.
Other columns play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from colloquy.llm.common import bit_array, bits_hold, checkpoint, mix64, ship, text_bytes

SUPPORT = 100
LONGEST = 5
TOP = 2000
SHARD_BYTES = 128 << 20
LEAST_SHARD_BYTES = 1 << 20
SHARDS_WANTED = 16            # over all languages, while shards stay over the least size
FEW_LANGS = 100_000           # so many rows of sizes are broadcast
_CUT = 0xFF                   # no byte of UTF-8: the border of a piece
_STEP = 1 << 20               # positions handled at a time
_CLASS = 1 << 22              # positions whose pairs are sorted at a time

# separators of pieces: . , ; : ! ? and the line breaks; a tab parts words as a space does
_TABLE = bytearray(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t", b"abcdefghijklmnopqrstuvwxyz "))
for _c in b".,;:!?\n\x0b\x0c\r":
    _TABLE[_c] = _CUT
_TABLE = bytes(_TABLE)


def words_of(text: bytes) -> list[bytes]:
    """The words in order; a border of pieces is the word ``b"\\xff"``."""
    return text.translate(_TABLE).replace(b"\xff", b" \xff ").split()


class _Words(dict):
    """word -> number, in order of appearance; 0 is the border of pieces."""

    def __init__(self):
        super().__init__({b"\xff": 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class _Shard:
    """Word numbers of texts, and what is frequent or asked for among their phrases."""

    def __init__(self):
        self.words, self.parts, self.bytes = _Words(), [], 0

    def add(self, text: bytes) -> None:
        words = words_of(text)
        words.append(b"\xff")
        self.parts.append(np.fromiter(map(self.words.__getitem__, words), np.uint32, len(words)))
        self.bytes += len(text)

    def phrases(self, lang: str, keep, named: bool) -> Iterator[tuple[int, list[bytes], np.ndarray, np.ndarray]]:
        """(words a phrase has, phrases, hashes, counts) for 1 to LONGEST words, of
        those that ``keep(hashes, counts)`` marks and whose parts were kept;
        phrases only if ``named``.  First (0, [b""], [0], [number of all words])."""
        at = np.concatenate(self.parts) if self.parts else np.empty(0, np.uint32)
        self.parts = []
        yield 0, [b""], np.zeros(1, np.uint64), np.array([np.count_nonzero(at)])
        texts = list(self.words)
        lasts = np.fromiter(map(xxhash.xxh64_intdigest, texts), np.uint64, len(texts))
        hashes = mix64(lasts ^ np.uint64(xxhash.xxh64_intdigest(lang.encode())))
        counts = np.bincount(at, minlength=len(texts))
        marks = keep(hashes, counts)
        marks[0] = False
        names = np.cumsum(marks, dtype=np.uint32) * marks
        at = names[at]                       # a kept phrase's number from 1, 0 where there is none
        kept = np.flatnonzero(marks)
        for k in range(1, LONGEST + 1):      # names, hashes, ... of a number are at that number less 1
            texts, hashes, lasts, counts = [texts[i] for i in kept.tolist()] if named else [], hashes[kept], lasts[kept], counts[kept]
            yield k, texts, hashes, counts
            if k == LONGEST or not len(kept):
                return
            found = [x for x in _pair_counts(at, hashes, lasts, keep) if len(x[0])]
            keys = np.concatenate([x[0] for x in found]) if found else np.empty(0, np.uint64)
            order = np.argsort(keys)
            keys = keys[order]
            left, right = ((keys >> np.uint64(32)) - np.uint64(1)).astype(np.int64), (keys & _LOW).astype(np.int64) - 1
            if named:
                texts = [texts[i] + b" " + texts[j].rpartition(b" ")[2] for i, j in zip(left.tolist(), right.tolist())]
            counts = np.concatenate([x[1] for x in found])[order] if found else np.empty(0, np.int64)
            hashes, lasts = _longer(hashes[left], lasts[right]), lasts[right]
            at = _renamed(at, keys)
            kept = np.arange(len(keys))


_LOW = np.uint64(0xFFFFFFFF)


def _longer(hashes: np.ndarray, lasts: np.ndarray) -> np.ndarray:
    return mix64(hashes * np.uint64(0x9E3779B97F4A7C15) + lasts)


def _both(at: np.ndarray):
    """Positions where a kept phrase starts as well as at the next one, and the
    pairs of their names, _STEP positions at a time."""
    for i in range(0, len(at) - 1, _STEP):
        a, b = at[i:min(i + _STEP, len(at) - 1)], at[i + 1:i + _STEP + 1]
        where = np.flatnonzero((a != 0) & (b != 0))
        yield i + where, (a[where].astype(np.uint64) << np.uint64(32)) | b[where]


def _pair_counts(at: np.ndarray, hashes: np.ndarray, lasts: np.ndarray, keep):
    """(pairs of names, counts) of the phrases a word longer that are kept, in
    classes of pairs, so that few are held at a time."""
    classes = len(at) // _CLASS + 1
    for c in range(classes):
        part = [keys[(keys * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(classes) == c] if classes > 1 else keys
                for _, keys in _both(at)]
        keys = np.concatenate(part) if part else np.empty(0, np.uint64)
        del part
        keys.sort()
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, int)
        counts = np.diff(np.append(starts, len(keys)))
        keys = keys[starts]
        left, right = ((keys >> np.uint64(32)) - np.uint64(1)).astype(np.int64), (keys & _LOW).astype(np.int64) - 1
        marks = keep(_longer(hashes[left], lasts[right]), counts)
        yield keys[marks], counts[marks]


def _renamed(at: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Per position the number (from 1) of the longer phrase that starts there."""
    new = np.zeros(len(at), np.uint32)
    if len(keys):
        for where, asked in _both(at):
            found = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
            hit = keys[found] == asked
            new[where[hit]] = found[hit] + 1
    return new


def _frequent(support: int):
    return lambda hashes, counts: counts >= support


def _asked(bits: np.ndarray):
    """Keeps what a bit array of candidates holds."""
    return lambda hashes, counts: bits_hold(bits, hashes)


_ROW = pa.schema([("lang", pa.string()), ("k", pa.int32()), ("phrase", pa.string()), ("n", pa.int64())])


def _shards(batches) -> Iterator[tuple[str, int, _Shard]]:
    """Rows (lang, shard, all, text) in order of (lang, shard) -> (lang, all, shard)."""
    now, shard, whole = None, None, 0
    for batch in batches:
        keys = zip(batch["lang"].to_pylist(), batch["shard"].to_pylist(), batch["all"].to_pylist())
        for (lang, number, size), text in zip(keys, text_bytes(batch["text"])):
            if now != (lang, number):
                if shard is not None:
                    yield now[0], whole, shard
                now, shard, whole = (lang, number), _Shard(), max(1, size)
            shard.add(text)
    if shard is not None:
        yield now[0], whole, shard


def _mine(support: int):
    """(lang, hash, over) of the locally frequent phrases of every shard: what a
    phrase's count has over the most that a phrase not returned can have; that
    much itself, without a hash."""
    def run(batches):
        for lang, whole, shard in _shards(batches):
            local = max(1, math.ceil(support * shard.bytes / whole))
            rows = lambda hashes, over: pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(over), pa.string()), hashes, pa.array(over, pa.int64())], ["lang", "hash", "over"])
            yield rows(pa.nulls(1, pa.int64()), [local - 1])
            for k, _, hashes, counts in shard.phrases(lang, _frequent(local), False):
                if k:
                    yield rows(pa.array(hashes.view(np.int64)), counts - (local - 1))
    return run


def _count(bits):
    """(lang, k, phrase, n): counts of every shard's phrases that the bit array holds."""
    def run(batches):
        keep = _asked(np.frombuffer(bits.value, np.uint8))
        for lang, _, shard in _shards(batches):
            for k, phrases, _, counts in shard.phrases(lang, keep, True):
                for i in range(0, len(phrases), 1 << 16):
                    part = phrases[i:i + (1 << 16)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(part), pa.string()), pa.array([k] * len(part), pa.int32()),
                         pa.array(part, pa.binary()).cast(pa.string()), pa.array(counts[i:i + (1 << 16)], pa.int64())],
                        schema=_ROW)
    return run


def frequent_phrases(docs: DataFrame, lang_col: str = "lang", text_col: str = "text",
                     support: int = SUPPORT) -> DataFrame:
    """(lang, k, phrase, n): every phrase of 1 to LONGEST words that occurs
    ``support`` times or more in its language, and the number of all words as k = 0."""
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    sizes = texts.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("all"))
    wanted = F.greatest(F.lit(LEAST_SHARD_BYTES), F.least(F.lit(SHARD_BYTES), F.sum("all").over(W.partitionBy()) / SHARDS_WANTED))
    sizes = checkpoint(sizes.select("lang", "all", F.greatest(F.lit(1), F.ceil(F.col("all") / wanted)).cast("int").alias("shards")))
    if sizes.count() <= FEW_LANGS:
        sizes = F.broadcast(sizes)
    dealt = (texts.join(sizes, "lang")  # by chance: copies of one text must not meet in a shard
             .select("lang", "all", F.floor(F.rand(12) * F.col("shards")).cast("int").alias("shard"), "text"))
    dealt = dealt.repartition("lang", "shard").sortWithinPartitions("lang", "shard")
    local = dealt.mapInArrow(_mine(support), "lang string, hash long, over long")
    local = checkpoint(local.groupBy("lang", "hash").agg(F.sum("over").alias("over")))
    # a shard that did not return a phrase has it at most that often
    most = local.filter("hash IS NULL").select("lang", F.col("over").alias("others"))
    candidates = local.filter("hash IS NOT NULL").join(most, "lang").filter(F.col("over") + F.col("others") >= support)
    bits = spark.sparkContext.broadcast(bit_array(candidates))
    counted = dealt.mapInArrow(_count(bits), "lang string, k int, phrase string, n long")
    return checkpoint(counted.groupBy("lang", "k", "phrase").agg(F.sum("n").alias("n"))
                      .filter((F.col("n") >= support) | (F.col("k") == 0)))


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text",
                 support: int = SUPPORT, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language."""
    counts = frequent_phrases(docs, lang_col, text_col, support)
    words = counts.filter("k = 0").select("lang", F.col("n").alias("all"))
    phrases = counts.filter("k > 1").select("lang", "k", "phrase", F.col("n").alias("a"))
    part = counts.filter("k > 0")
    cut = lambda first, last: F.array_join(F.slice("w", first, last), " ")
    cuts = (phrases.withColumn("w", F.split("phrase", " "))
            .withColumn("cut", F.explode(F.expr("sequence(1, k - 1)")))
            .select("lang", "phrase", "a", "cut", cut(F.lit(1), F.col("cut")).alias("first"),
                    cut(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("rest")))
    side = lambda name, n: part.select("lang", F.col("phrase").alias(name), F.col("n").alias(n))
    big = lambda c: F.col(c).cast("decimal(19,0)")
    # whole numbers throughout: the product passes 64 bits, a decimal holds 38 digits
    scored = (cuts.join(side("first", "l"), ["lang", "first"]).join(side("rest", "r"), ["lang", "rest"])
              .join(words, "lang")
              .withColumn("over", (F.lit(1000).cast("decimal(4,0)") * F.col("a").cast("decimal(15,0)")).cast("decimal(19,0)")
                          * big("all"))
              .withColumn("score", F.call_function("div", F.col("over"), big("l") * big("r"))))
    best = (scored.groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "cut", "l", "r", "a", "all")).alias("m")).select("lang", "phrase", "m.*"))
    # a phrase of the same count around it implies one that is a word longer
    inside = (phrases.filter("k > 2").withColumn("w", F.split("phrase", " "))
              .select("lang", "a", F.explode(F.array(cut(F.lit(1), F.col("k") - 1), cut(F.lit(2), F.col("k") - 1))).alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    kept = best.join(inside, ["lang", "phrase"], "left").filter("longer IS NULL OR 100 * longer < 100 * a")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    some = (kept.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(64)))
            .withColumn("rank", F.row_number().over(W.partitionBy("lang", "salt").orderBy(*order)))
            .filter(F.col("rank") <= top))
    return (some.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long"))
            .filter(F.col("rank") <= top)
            .select("lang", "rank", "phrase", "a", "l", "r", F.col("all").alias("n"), "score"))


def op12_collocations(documents: DataFrame) -> DataFrame:
    return collocations(documents.select("lang", "text"))


def op12_sql() -> str:
    """Every phrase counted by brute force."""
    split = "[.,;:!?\\x0A-\\x0D]"
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    grams = " UNION ALL ".join(
        f"SELECT lang, {k} AS k, unnest(list_transform(range(1, len(w) - {k - 2}), "
        f"lambda i: array_to_string(w[i:i + {k - 1}], ' '))) AS phrase FROM pieces WHERE len(w) >= {k}"
        for k in range(1, LONGEST + 1))
    return f"""
WITH cut AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({lower}, '{split}')) AS piece FROM documents),
pieces AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM cut),
words AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
f AS (SELECT lang, k, phrase, count(*)::BIGINT AS a FROM ({grams}) GROUP BY ALL HAVING count(*) >= {SUPPORT}),
cuts AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS head FROM f WHERE k > 1),
scored AS (SELECT c.lang, c.phrase, c.a, x.a AS l, y.a AS r, n, head,
  (1000::HUGEINT * c.a * n) // (x.a::HUGEINT * y.a) AS score
  FROM cuts c JOIN words USING (lang)
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:head], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(w[head + 1:], ' ')),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, head) = 1),
kept AS (SELECT * FROM best b WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.lang = b.lang AND f.k > len(string_split(b.phrase, ' '))
  AND 100 * f.a >= 100 * b.a AND contains(' ' || f.phrase || ' ', ' ' || b.phrase || ' ')))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::BIGINT AS rank, phrase, a, l, r, n,
  score::BIGINT AS score FROM kept QUALIFY rank <= {TOP}"""
