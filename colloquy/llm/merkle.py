"""Merkle manifest of a dataset, its leaves placed by bitmap ranks.

Every row is a leaf, the SHA-256 of its fields.  The leaves of a group (a
language) ascend by id and form a tree of fan-out FAN; the groups' roots form
the tree above.

Nothing is sorted to number the leaves.  The ids of a group are bits of
compressed bitmaps, blocks of 512 ids of which only those in use exist, built
by partial aggregation and merged per block.  Popcount directories hold the
number of rows before a block: the blocks' counts are added up over 1024
blocks at a time, and the sums of these again, until few are left.  A leaf's
coordinate is its block's directory entry plus the popcount of the bits below
its own.  Slot arrays of FAN ** LEVELS coordinates then reduce LEVELS levels
per shuffle.  Texts are hashed in the scan and never shuffled.

Defined results.  Rows without an id come first in their group.  Rows that
share an id ascend by leaf (then by the leaf as presented); equal rows take
neighbouring places.  A null group is a group of its own, the first.  A group
is one row of the tree above, so the number of groups (languages) has to fit a
task.  An empty table gives no rows.  Other columns play no part.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from colloquy.llm.common import checkpoint

FAN_BITS = 3
FAN = 1 << FAN_BITS
LEVELS = 4                    # levels that one slot array reduces
SLOTS = FAN ** LEVELS
WORDS = 8                     # 64-bit words of a bitmap block
BLOCK_BITS = 9                # 512 ids a block
FEW = 50_000                  # directory entries that one pass adds up
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaf(fields: list[Column]) -> Column:
    """SHA-256 (32 bytes) of the fields: ``-`` for null, else byte count, ``:``, value."""
    texts = [f.cast("string") for f in fields]
    return F.unhex(F.sha2(F.concat(*[
        F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256))


def _before(counts: DataFrame, shift: int = 0) -> DataFrame:
    """``counts(g, key, n)`` with ``before``, the sum of n over smaller keys of g.

    A window adds up 1024 keys at most (their common upper bits), until FEW are left."""
    so_far = lambda w: F.coalesce(
        F.sum("n").over(w.orderBy("key").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    if shift >= 60 or counts.count() <= FEW:
        return counts.withColumn("before", so_far(W.partitionBy("g")))
    inside = counts.withColumn("up", F.shiftright("key", 10)).withColumn("here", so_far(W.partitionBy("g", "up")))
    above = _before(checkpoint(inside.groupBy("g", F.col("up").alias("key")).agg(F.sum("n").alias("n"))), shift + 10)
    return (inside.join(above.select("g", F.col("key").alias("up"), F.col("before").alias("outer")), ["g", "up"])
            .select("g", "key", "n", (F.col("here") + F.col("outer")).alias("before")))


def _bitmaps(ids: DataFrame) -> DataFrame:
    """``ids(g, id, rows)``, distinct -> (g, key, w0.., more, before): the bitmap
    block, the places whose id has several rows, and the rows before the block."""
    bit = F.col("id").bitwiseAND(511).cast("int")
    parts = ids.select("g", F.shiftright("id", BLOCK_BITS).alias("key"), "rows", bit.alias("bit"))
    word = lambda w: F.bit_or(F.when(F.shiftright("bit", 6) == w, F.expr("shiftleft(1L, bit & 63)")))
    blocks = checkpoint(parts.groupBy("g", "key").agg(
        *[word(w).alias(f"w{w}") for w in range(WORDS)], F.sum("rows").alias("n")))
    more = (parts.filter("rows > 1").groupBy("g", "key")
            .agg(F.collect_list(F.struct("bit", (F.col("rows") - 1).alias("extra"))).alias("more")))
    return (blocks.drop("n").join(_before(blocks.select("g", "key", "n")).drop("n"), ["g", "key"])
            .join(more, ["g", "key"], "left"))


def _rank() -> Column:
    """Rows of the group before the first one of ``id``, from its bitmap block."""
    at, low = F.expr("int((id & 511) >> 6)"), F.expr("~shiftleft(-1L, int(id & 63))")
    bits = [F.when(at < w, F.lit(0)).otherwise(F.bit_count(F.when(at > w, F.col(f"w{w}"))
                                                           .otherwise(F.col(f"w{w}").bitwiseAND(low))))
            for w in range(WORDS)]
    below = sum((F.coalesce(b, F.lit(0)) for b in bits), F.col("before"))
    extra = F.expr("coalesce(aggregate(filter(more, m -> m.bit < (id & 511)), 0L, (s, m) -> s + m.extra), 0L)")
    return below + extra


def _among_equals(rows: DataFrame) -> DataFrame:
    """``rows(g, id, leaf, other, c)`` of ids with several leaves -> plus ``within``,
    the rows of the same id before: counted by the leaf's first 12 bits, then
    inside these, so a hot id (or a third of all rows without one) is spread."""
    some = rows.withColumn("top", F.conv(F.substring(F.hex("leaf"), 1, 3), 16, 10).cast("int"))
    tops = some.groupBy("g", "id", "top").agg(F.sum("c").alias("t"))
    tops = tops.withColumn("outer", F.coalesce(F.sum("t").over(
        W.partitionBy("g", "id").orderBy("top").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("t")
    here = F.coalesce(F.sum("c").over(W.partitionBy("g", "id", "top").orderBy("leaf", "other")
                                      .rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    some = some.withColumn("here", here).alias("s")
    tops = tops.alias("t")
    return (some.join(tops, (F.col("s.g") == F.col("t.g")) & F.col("s.id").eqNullSafe(F.col("t.id"))
                      & (F.col("s.top") == F.col("t.top")))
            .select("s.g", "s.id", "s.leaf", "s.other", "s.c", (F.col("here") + F.col("outer")).alias("within")))


def _placed(rows: DataFrame) -> DataFrame:
    """``rows(g, id, leaf, other)`` -> (g, n, j, id, leaf, other): the coordinate
    j of each leaf among the n of its group."""
    kinds = checkpoint(rows.groupBy("g", "id", "leaf", "other").agg(F.count("*").alias("c")))
    ids = checkpoint(kinds.groupBy("g", "id").agg(F.sum("c").alias("rows"), F.count("*").alias("kinds")))
    groups = ids.groupBy("g").agg(F.sum("rows").alias("n"),
                                  F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("rows"))), F.lit(0)).alias("unnamed"))
    mixed = ids.filter("kinds > 1").select(F.col("g").alias("mg"), F.col("id").alias("mid"))
    is_mixed = (F.col("g") == F.col("mg")) & F.col("id").eqNullSafe(F.col("mid"))
    kinds = (kinds.join(mixed, is_mixed, "left_anti").withColumn("within", F.lit(0).cast("long"))
             .unionByName(_among_equals(kinds.join(mixed, is_mixed, "left_semi"))))
    named = kinds.filter("id IS NOT NULL").withColumn("key", F.shiftright("id", BLOCK_BITS))
    named = (named.join(_bitmaps(ids.filter("id IS NOT NULL")), ["g", "key"])
             .join(groups, "g").withColumn("j", _rank() + F.col("unnamed") + F.col("within")))
    unnamed = kinds.filter("id IS NULL").join(groups, "g").withColumn("j", F.col("within"))
    cols = ["g", "n", "j", "c", "id", "leaf", "other"]
    once = named.select(*cols).unionByName(unnamed.select(*cols))
    # equal rows take neighbouring places; two steps keep the arrays short
    return (once.withColumn("k", F.explode(F.expr("sequence(0L, c - 1, 4096L)")))
            .withColumn("k", F.explode(F.expr("sequence(k, least(k + 4095, c - 1))")))
            .select("g", "n", (F.col("j") + F.col("k")).alias("j"), "id", "leaf", "other"))


def _digest(text: bytes) -> bytes:
    return hashlib.sha256(text).hexdigest().encode()


def _climb(nodes: list[bytes], whole: bool) -> tuple[list[list[bytes]], list[bytes]]:
    """The runs of FAN nodes (joined) on each level, and the nodes above them:
    LEVELS levels up, or to the single root if the group has no other nodes."""
    levels = []
    while len(nodes) > 1 if whole else len(levels) < LEVELS:
        runs = [b"".join(nodes[i:i + FAN]) for i in range(0, len(nodes), FAN)]
        levels.append(runs)
        nodes = [_digest(r) for r in runs]
    return levels, nodes


def _slots(t: pa.Table, name: str) -> list[bytes]:
    """The nodes of a slot array, keyed by coordinate, without sorting."""
    base = t["key"][0].as_py() * SLOTS
    nodes = [None] * t.num_rows
    for j, h in zip(t["j"].to_pylist(), t[name].to_pylist()):
        nodes[j - base] = h.hex().encode()
    return nodes


def _reduced(t: pa.Table) -> pa.Table:
    """(g, key, n, j, h) of one slot array -> its node above."""
    g, key, n = (t[c][0].as_py() for c in ("g", "key", "n"))
    _, (top,) = _climb(_slots(t, "h"), n <= SLOTS)
    return pa.table({"g": [g], "n": pa.array([-(-n // SLOTS)], pa.int64()), "j": pa.array([key], pa.int64()),
                     "h": pa.array([bytes.fromhex(top.decode())], pa.binary())})


def _with_runs(t: pa.Table, above: pa.Table) -> pa.Table:
    """The nodes of one slot array with the runs they lie in, upwards to the root."""
    n, key = t["n"][0].as_py(), t["key"][0].as_py()
    levels, _ = _climb(_slots(t, "h"), n <= SLOTS)
    rest = above["runs"][0].as_py() if above.num_rows else []
    js = t["j"].to_pylist()
    runs = [[level[(j - key * SLOTS) >> (FAN_BITS * (k + 1))].decode() for k, level in enumerate(levels)] + rest
            for j in js]
    return pa.table({"g": t["g"], "j": t["j"], "h": t["h"], "runs": pa.array(runs, pa.list_(pa.string()))})


_NODE = "g string, n long, j long, h binary"


class _Tree:
    """Trees over ``nodes(g, n, j, h)``: every stage's nodes, as tables."""

    def __init__(self, nodes: DataFrame):
        self.stages = [nodes]
        most = nodes.agg(F.max("n")).first()[0] or 0
        while most > 1:
            below = self.stages[-1].withColumn("key", F.shiftright("j", FAN_BITS * LEVELS))
            self.stages.append(checkpoint(below.select("g", "n", "j", "h", "key").groupBy("g", "key")
                                          .applyInArrow(_reduced, _NODE)))
            most = -(-most // SLOTS)

    def roots(self) -> DataFrame:
        return self.stages[-1].select("g", "h")

    def runs(self, stage: int) -> DataFrame:
        """(g, j, h, runs) of a stage's nodes: the runs from there to the root."""
        found = self.stages[-1].select("g", "j", "h", F.array().cast("array<string>").alias("runs"))
        for nodes in self.stages[-2:stage - len(self.stages) - 1:-1] if stage < len(self.stages) - 1 else []:
            left = nodes.withColumn("key", F.shiftright("j", FAN_BITS * LEVELS)).select("g", "n", "j", "h", "key")
            right = found.select("g", F.col("j").alias("key"), "runs")
            found = (left.groupBy("g", "key").cogroup(right.groupBy("g", "key"))
                     .applyInArrow(_with_runs, "g string, j long, h binary, runs array<string>"))
        return found


def _prove(t: pa.Table, above: pa.Table) -> pa.Table:
    """(leaves of a slot array, the runs above it) -> proofs and folded roots."""
    n, key = t["n"][0].as_py(), t["key"][0].as_py()
    levels, _ = _climb(_slots(t, "leaf"), n <= SLOTS)
    up = above.to_pylist()[0]
    higher = [(r.encode(), (key >> (FAN_BITS * k)) & (FAN - 1)) for k, r in enumerate(up["runs"])]
    higher += [(r.encode(), (up["place"] >> (FAN_BITS * k)) & (FAN - 1)) for k, r in enumerate(up["top_runs"])]
    root = up["root"].hex()
    proofs, folded = [], []
    for j, other in zip(t["j"].to_pylist(), t["other"].to_pylist()):
        slot = j - key * SLOTS
        path = [(level[slot >> (FAN_BITS * (k + 1))], (slot >> (FAN_BITS * k)) & (FAN - 1))
                for k, level in enumerate(levels)] + higher
        sides = [(run[:64 * at], run[64 * (at + 1):]) for run, at in path]
        proofs.append(hashlib.sha256(b"".join([p for side in sides for p in side])).hexdigest())
        if other is None:
            folded.append(root)
            continue
        h = other.hex().encode()
        for left, right in sides:
            h = _digest(left + h + right)
        folded.append(h.decode())
    size = t.num_rows
    hexes = [h.hex() for h in t["leaf"].to_pylist()]
    return pa.table({"id": t["id"], "leaf": hexes, "subroot": [up["subroot"].hex()] * size, "root": [root] * size,
                     "proof_sha256": proofs, "folded_root": folded, "verified": [f == root for f in folded]})


def manifest(docs: DataFrame, fields: list[str], id_col: str = "doc_id", group_col: str = "lang",
             presented: dict[str, Column] | None = None, when: Column | None = None) -> DataFrame:
    """One row per row of ``docs``: (id, leaf, subroot, root, proof_sha256,
    folded_root, verified).

    ``presented`` names fields whose presented value differs from the recorded
    one, on the rows that satisfy ``when``; their proof is folded from the leaf
    as presented, which ``verified`` compares with the root."""
    as_is = [F.col(f) for f in fields]
    shown = [(presented or {}).get(f, F.col(f)) for f in fields]
    rows = docs.select(
        F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit("")).alias("g"),
        F.col(id_col).cast("long").alias("id"), leaf(as_is).alias("leaf"),
        (F.when(when, leaf(shown)) if presented else F.lit(None)).cast("binary").alias("other"))
    leaves = checkpoint(_placed(rows))
    tree = _Tree(leaves.select("g", "n", "j", F.col("leaf").alias("h")))
    subroots = checkpoint(tree.roots())
    numbered = subroots.withColumn("j", F.row_number().over(W.orderBy("g")).cast("long") - 1)
    count = subroots.count()
    top = _Tree(checkpoint(numbered.select(F.lit("").alias("g"), F.lit(count).cast("long").alias("n"), "j", "h")))
    root = top.roots().first()  # one digest
    groups = (numbered.select("g", F.col("h").alias("subroot"), F.col("j").alias("place"))
              .join(top.runs(0).select(F.col("j").alias("place"), F.col("runs").alias("top_runs")), "place")
              .withColumn("root", F.lit(bytes(root.h) if root else None).cast("binary")))
    if len(tree.stages) > 1:
        arrays = tree.runs(1).select("g", F.col("j").alias("key"), "runs")
    else:
        arrays = subroots.select("g", F.lit(0).cast("long").alias("key"), F.array().cast("array<string>").alias("runs"))
    above = arrays.join(groups, "g")
    above = above.select(*[F.col(c).alias(c) for c in above.columns])  # columns that differ from those of the leaves
    below = leaves.withColumn("key", F.shiftright("j", FAN_BITS * LEVELS))
    return (below.groupBy("g", "key").cogroup(above.groupBy("g", "key")).applyInArrow(
        _prove, "id long, leaf string, subroot string, root string, proof_sha256 string, "
                "folded_root string, verified boolean"))


FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def op11_merkle(documents: DataFrame) -> DataFrame:
    return manifest(documents.select(*FIELDS), FIELDS,
                    presented={"text": F.translate("text", _UPPER, _LOWER)},
                    when=F.crc32(F.col("doc_id").cast("string")) % 3 == 0).withColumnRenamed("id", "doc_id")


def op11_sql(levels: int = 7) -> str:
    """The manifest by sorting; ``levels`` unrolled levels of 8 hold 8 ** levels
    leaves a language, and 8 ** 2 languages."""
    field = lambda f: f"coalesce(strlen({f}::VARCHAR)::VARCHAR || ':' || {f}::VARCHAR, '-')"
    leaf_of = lambda text: "sha256(" + " || ".join(
        field(f) for f in [*FIELDS[:-1], text]) + ")"
    lower = f"translate(text, '{_UPPER}', '{_LOWER}')"
    crc = ("xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''), "
           "lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), lambda a, x: CASE WHEN x >= 0 "
           "THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295)")
    ctes = [f"rows AS (SELECT doc_id, coalesce('=' || lang, '') AS g, {leaf_of('text')} AS leaf, "
            f"CASE WHEN {crc} % 3 = 0 THEN {leaf_of(lower)} END AS other FROM documents)",
            "l0 AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf, other) - 1 AS j, "
            "leaf AS h FROM rows)"]

    def up(prefix: str, k: int, key: str) -> list[str]:
        # of a level with one node nothing is left to do: its run is empty
        return [f"{prefix}r{k} AS (SELECT {key}, j // 8 AS j, CASE WHEN max(max(j)) OVER (PARTITION BY {key}) = 0 THEN '' "
                f"ELSE string_agg(h, '' ORDER BY j) END AS run, min(h) AS one FROM {prefix}{k} GROUP BY {key}, j // 8)",
                f"{prefix}{k + 1} AS (SELECT {key}, j, CASE WHEN run = '' THEN one ELSE sha256(run) END AS h FROM {prefix}r{k})"]
    for k in range(levels):
        ctes += up("l", k, "g")
    ctes.append(f"t0 AS (SELECT 0 AS z, g, row_number() OVER (ORDER BY g) - 1 AS j, h FROM l{levels})")
    for k in range(2):
        ctes += up("t", k, "z")
    joins, sides = [], []
    for prefix, count, on, j in (("l", levels, "{a}.g = l0.g", "l0.j"), ("t", 2, "{a}.z = 0", "t0.j")):
        for k in range(count):
            a = f"{prefix}r{k}"
            joins.append(f"JOIN {a} ON {on.format(a=a)} AND {a}.j = {j} // {8 ** (k + 1)}")
            sides.append((f"left({a}.run, 64 * ({j} // {8 ** k} % 8))", f"substr({a}.run, 64 * ({j} // {8 ** k} % 8) + 65)",
                          f"{a}.run"))
    steps, last = [], "paths"
    for k, _ in enumerate(sides):
        steps.append(f"f{k} AS (SELECT *, CASE WHEN run{k} = '' THEN v ELSE sha256(left{k} || v || right{k}) END AS v2 "
                     f"FROM {last})")
        steps.append(f"g{k} AS (SELECT * REPLACE (v2 AS v) FROM (SELECT * FROM f{k}))")
        last = f"(SELECT * EXCLUDE (v2) FROM g{k})"
    paths = ("paths AS (SELECT l0.doc_id, l0.leaf, t0.h AS subroot, t2.h AS root, coalesce(l0.other, l0.leaf) AS v, "
             + ", ".join(f"{a} AS left{k}, {b} AS right{k}, {r} AS run{k}" for k, (a, b, r) in enumerate(sides))
             + f" FROM l0 JOIN t0 ON t0.g = l0.g JOIN t2 ON true {' '.join(joins)})")
    proof = " || ".join(f"left{k} || right{k}" for k in range(len(sides)))
    return (f"WITH {', '.join([*ctes, paths, *steps])} SELECT doc_id, leaf, subroot, root, sha256({proof}) AS proof_sha256, "
            f"v AS folded_root, v = root AS verified FROM {last}")
