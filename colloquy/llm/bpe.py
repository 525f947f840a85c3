"""Byte-level BPE encoding and decoding, exact against the tokenizer file.

Method: tree concatenation.  The vocabulary's pre-tokeniser cuts a text into
pieces that merge independently.  A piece that it leaves unsplit for long is
halved again and again into leaves, the leaves are encoded in parallel (they
are rows of their own, so Spark spreads one document over many tasks), and
neighbours are joined pairwise up the tree: the last tokens of the left and
the first of the right are decoded and encoded again as one window, which
grows until its first token equals the left side's and its last token the
right side's.  A token sequence is the BPE encoding of its bytes exactly if
every neighbouring pair is (a merge looks at two neighbours only), so an
agreeing window proves the join.

Ids travel as packed little-endian unsigned 32-bit integers (``binary``).
Null text counts as empty and gives no ids; an empty table gives an empty one.
Extra columns are kept; a column that already has the output's name is an error
of the caller's choice of name, so the name is a parameter.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from colloquy.llm.common import fresh, ship

DEFAULT_TOKENIZER = "byte_bpe_50k.json"
# fixed value: the split pattern of the byte-level pre-tokeniser
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# unsplit runs from this many characters on are encoded as a tree of leaves
LONG_PIECE = 4096
LEAF = 1024


def default_path() -> str:
    return public_tokenizers.path(DEFAULT_TOKENIZER)


def _byte_alphabet() -> dict[str, int]:
    """Character -> byte of the byte-level alphabet: printable Latin-1 stands
    for itself, every other byte for the next code point from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Codec:
    """One tokenizer file, loaded once per Python worker."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec["model"]["type"] != "BPE" or spec["normalizer"] or spec["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError(f"{path}: not a plain byte-level BPE")
        letters = _byte_alphabet()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items()
                 if token not in self.special}
        merged = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        ids = [ranks[bytes(letters[c] for c in a + b)] for a, b in merged]
        if ids != sorted(ids):
            raise ValueError(f"{path}: ids do not follow the merge order")
        self.core = tiktoken.Encoding(path, pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens=self.special)
        self.bytes_of = [b""] * (max([*ranks.values(), *self.special.values()]) + 1)
        for token, i in ranks.items():
            self.bytes_of[i] = token
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        self.lengths = np.array([len(b) for b in self.bytes_of], np.int64)
        self.path = path

    def encode(self, text: str) -> np.ndarray:
        return self.core.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False)

    def encode_piece(self, piece: bytes) -> list[int]:
        """Merge the bytes of one piece, without any split."""
        return self.core._encode_single_piece(piece)

    def decode(self, ids: np.ndarray) -> str:
        table = self.bytes_of
        return b"".join(map(table.__getitem__, ids.tolist())).decode("utf-8", "replace")

    def join(self, left: list[int], right: list[int], width: int = 4) -> list[int]:
        """Exact encoding of two neighbouring encoded byte strings."""
        if not left or not right:
            return left + right
        while True:
            a, b = left[-width:], right[:width]
            window = self.encode_piece(b"".join(map(self.bytes_of.__getitem__, a + b)))
            if ((len(a) == len(left) or window[0] == a[0])
                    and (len(b) == len(right) or window[-1] == b[-1])):
                return left[:len(left) - len(a)] + window + right[len(b):]
            width *= 2

    def concat(self, leaves: list[list[int]]) -> list[int]:
        """Join encoded leaves pairwise, level by level."""
        while len(leaves) > 1:
            leaves = [self.join(*leaves[i:i + 2]) if i + 1 < len(leaves) else leaves[i]
                      for i in range(0, len(leaves), 2)]
        return leaves[0] if leaves else []

    def pieces(self, text: str) -> list[tuple[str, int]]:
        """The text cut by special tokens and the pre-tokeniser into runs:
        (run, -1) to be encoded as ordinary text, (run, 0) a long unsplit
        piece, (token, id) a special token."""
        out: list[tuple[str, int]] = []
        cut = re.split("(" + "|".join(map(re.escape, self.special)) + ")", text) if self.special else [text]
        for part in cut:
            if part in self.special:
                out.append((part, self.special[part]))
                continue
            done = 0
            for _, (start, end) in _splitter(self.path).pre_tokenize_str(part):
                if end - start >= LONG_PIECE:
                    if start > done:
                        out.append((part[done:start], -1))
                    out.append((part[start:end], 0))
                    done = end
            if done < len(part):
                out.append((part[done:], -1))
        return out


@lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    return Codec(path)


@lru_cache(maxsize=4)
def _splitter(path: str):
    return Tokenizer.from_file(path).pre_tokenizer


def _has_long_run(text: Column) -> Column:
    """True if the text has a run that may hold a piece of LONG_PIECE characters."""
    runs = rf"(?<!\S)\S{{{LONG_PIECE}}}|(?<!\s)\s{{{LONG_PIECE}}}"
    return F.coalesce((F.length(text) >= LONG_PIECE) & text.rlike(runs), F.lit(False))


def encode(df: DataFrame, text_col: str = "text", out_col: str = "ids", path: str | None = None) -> DataFrame:
    """``df`` with the packed ids of every whole text in ``out_col``.

    Texts without a long unsplit run are encoded where they lie (no shuffle).
    The others are cut into leaves; each distinct text is encoded once and
    joined back by its hash, so repeated rows and null keys need no row id.
    """
    path = path or default_path()
    ship(df.sparkSession)

    @F.arrow_udf("binary")
    def direct(texts: pa.Array) -> pa.Array:
        c = codec(path)
        return pa.array([c.encode(t or "").tobytes() for t in texts.to_pylist()], pa.binary())

    # "nondeterministic" keeps Spark from evaluating it once per use
    direct = direct.asNondeterministic()
    long_text = _has_long_run(F.col(text_col))
    plain = df.filter(~long_text).withColumn(out_col, direct(F.col(text_col)))
    key, joined = fresh(df, "_text_key"), fresh(df, "_joined_key")
    tall = df.filter(long_text).withColumn(key, F.sha2(F.col(text_col), 256))
    done = encode_long(tall.select(F.col(key).alias("key"), F.col(text_col).alias("text")), path)
    tall = (tall.join(done.select(F.col("key").alias(joined), F.col("ids").alias(out_col)),
                      F.col(key) == F.col(joined), "left").drop(key, joined))
    return plain.unionByName(tall)



def encode_long(texts: DataFrame, path: str) -> DataFrame:
    """(key, ids) per distinct (key, text): leaves in parallel, then the tree."""
    ship(texts.sparkSession)

    @F.arrow_udf("array<struct<part:int,leaf:int,special:int,piece:string>>")
    def leaves(column: pa.Array) -> pa.Array:
        c = codec(path)
        out = []
        for text in column.to_pylist():
            rows = []
            for part, (run, kind) in enumerate(c.pieces(text or "")):
                if kind:
                    rows.append({"part": part, "leaf": 0, "special": kind, "piece": run})
                else:
                    rows += [{"part": part, "leaf": k, "special": 0, "piece": run[at:at + LEAF]}
                             for k, at in enumerate(range(0, len(run), LEAF))]
            out.append(rows)
        return pa.array(out, pa.list_(pa.struct([("part", pa.int32()), ("leaf", pa.int32()),
                                                 ("special", pa.int32()), ("piece", pa.string())])))

    @F.arrow_udf("binary")
    def leaf_ids(special: pa.Array, piece: pa.Array) -> pa.Array:
        c = codec(path)
        out = []
        for kind, run in zip(special.to_pylist(), piece.to_pylist()):
            ids = ([kind] if kind > 0 else c.encode(run).tolist() if kind < 0
                   else c.encode_piece(run.encode()))
            out.append(np.array(ids, "<u4").tobytes())
        return pa.array(out, pa.binary())

    @F.arrow_udf("binary")
    def tree(parts: pa.Array) -> pa.Array:
        c = codec(path)
        out = []
        for rows in parts.to_pylist():
            whole: list[int] = []
            by_part: dict[int, list[list[int]]] = {}
            kinds: dict[int, int] = {}
            for row in rows:
                by_part.setdefault(row["part"], []).append(np.frombuffer(row["ids"], "<u4").tolist())
                kinds[row["part"]] = row["special"]
            for part, sides in by_part.items():
                whole += c.concat(sides) if kinds[part] == 0 else sides[0]
            out.append(np.array(whole, "<u4").tobytes())
        return pa.array(out, pa.binary())

    rows = (texts.groupBy("key").agg(F.first("text").alias("text"))
            .select("key", F.explode(leaves("text")).alias("p")).select("key", "p.*")
            .repartition("key", "part", "leaf")
            .withColumn("ids", leaf_ids("special", "piece")))
    return (rows.groupBy("key")
            .agg(F.array_sort(F.collect_list(F.struct("part", "leaf", "special", "ids"))).alias("parts"))
            .select("key", tree("parts").alias("ids")))


def decode(df: DataFrame, ids_col: str = "ids", out_col: str = "decoded", path: str | None = None) -> DataFrame:
    """``df`` with the text of packed ids in ``out_col`` (special tokens kept,
    bytes that are no UTF-8 become U+FFFD); null ids give an empty text."""
    path = path or default_path()
    ship(df.sparkSession)

    @F.arrow_udf("string")
    def to_text(column: pa.Array) -> pa.Array:
        c = codec(path)
        return pa.array([c.decode(np.frombuffer(b or b"", "<u4")) for b in column.to_pylist()], pa.string())

    return df.withColumn(out_col, to_text(F.col(ids_col)))


def op7_bpe(documents: DataFrame, path: str | None = None) -> DataFrame:
    """The contract's digest columns from ``encode`` and ``decode``."""
    both = decode(encode(documents.select("doc_id", "text"), path=path), path=path)
    return both.select("doc_id", (F.octet_length("ids") / 4).cast(T.LongType()).alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))
