"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid
import zipfile
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_CACHE_WORDS = 100_000
_MIX = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


BATCH_BYTES = 4 << 20
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package (``addPyFile``, once per application):
    workers import it by name, so tables compiled there last over tasks.  Also
    lowers the session's Arrow batches to BATCH_BYTES: a batch of long texts and
    its results is held several times over in a worker."""
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    if size(spark.conf.get(setting)) > BATCH_BYTES:
        spark.conf.set(setting, BATCH_BYTES)
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent.parent
    archive = f"{tempfile.mkdtemp(prefix='colloquy-')}/{root.name}-src.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(root.rglob("*.py")):
            z.write(source, source.relative_to(root.parent))
    sc.addPyFile(archive)
    _shipped.add(sc.applicationId)


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``.  Where the session names
    none: a temporary folder in local mode, else one in the shared warehouse."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named:
            local = sc.master == "local" or sc.master.startswith("local[")
            named = (tempfile.mkdtemp(prefix="colloquy-checkpoint-") if local
                     else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints")
        sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def checkpoint(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def materialized(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read again.  Like a checkpoint, but
    the plan starts anew: a checkpoint hands on the constraints of its plan, and
    in jobs of many rounds the optimizer's work on them grows with every round."""
    folder = f"{checkpoint_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files that only lineage before a checkpoint
    needed.  It does so when the driver's JVM collects garbage, which a job with
    little on the driver may put off until its end; call this where no variable
    holds the old frames any more."""
    spark.range(1).count()  # Spark's queues hold on to the last query they saw
    for _ in range(2):  # what the first round lets go of holds more
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(1)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_bytes(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column; null counts as empty."""
    return [b"" if b is None else b for b in column.cast(pa.large_binary()).to_pylist()]


def ascii_lower(text: bytes) -> bytes:
    return text.translate(_LOWER)


class _WordHashes(dict):
    """word -> 64-bit hash; bounded, so a worker's memory does not grow."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_word_hash = _WordHashes()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_word_hash.__getitem__, words), np.uint64, len(words))


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def windows_of(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` consecutive word hashes."""
    n = len(hashes) - width + 1
    acc = np.full(n, np.uint64(width))
    for j in range(width):
        acc *= _MIX
        acc += hashes[j:j + n]
        acc ^= acc >> np.uint64(29)
    return mix64(acc)


def shingle_set(text: bytes, width: int) -> np.ndarray:
    """Sorted distinct shingles of the lower-cased words; the whole sequence
    as one shingle where there are fewer words, nothing without words."""
    words = ascii_lower(text).split()
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(windows_of(word_hashes(words), min(width, len(words))))


FILTER_BITS = 26  # 8 MB


def bit_array(hashes: DataFrame) -> bytes:
    """The column ``hash`` (longs) as FILTER_BITS of place bits, the upper bits of
    each hash; merged by Spark in chunks of 4 KB.  The size never grows: with
    more hashes, more others pass by chance, none is lost."""
    place = F.shiftrightunsigned("hash", 64 - FILTER_BITS)
    rows = (hashes.select(place.alias("at")).groupBy(F.shiftright("at", 15).alias("chunk"))
            .agg(F.bitmap_construct_agg(F.col("at").bitwiseAND((1 << 15) - 1)).alias("bits")))
    bits = bytearray(1 << (FILTER_BITS - 3))
    for row in rows.collect():  # 2 ** FILTER_BITS bits at most
        bits[row.chunk * 4096:(row.chunk + 1) * 4096] = row.bits
    return bytes(bits)


def bits_hold(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether a bit array (bytes) holds the hashes (unsigned)."""
    place = hashes >> np.uint64(64 - FILTER_BITS)
    return (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


def null_safe_eq(left: DataFrame, right: DataFrame, names: list[str]):
    cond = F.lit(True)
    for name in names:
        cond = cond & left[name].eqNullSafe(right[name])
    return cond
