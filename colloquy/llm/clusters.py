"""Finding the components of a similarity graph from shared keys.

``members(key, node)`` says which nodes (sets) share a key; similar nodes share
at least one.  Nodes meet in blocks of bounded size inside a task, which return
a spanning forest of the links they find, never all pairs:

1. every node meets the node of its keys' smallest members with which it shares
   most keys, and others that meet the same one.  A node goes to one block, so
   this is linear however large a group of copies is;
2. what is linked is contracted.  Nodes of keys that still hold several
   components meet all others they share such a key with.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.llm.common import bit_array, bits_hold, materialized
from colloquy.llm.graph import connected_components

BLOCK = 1024             # nodes of a block
BLOCK_BYTES = 16 << 20   # and bytes of their sets


def groups_of(batches, name: str) -> Iterator[pa.Table]:
    """Rows that come in order of ``name`` -> one table per value."""
    rest = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        rest = t if rest is None else pa.concat_tables([rest, t])
        column = rest[name].combine_chunks()
        if len(column) and column[0] == column[-1]:
            continue
        edges = pc.indices_nonzero(pc.not_equal(column[1:], column[:-1])).to_pylist()
        done = 0
        for edge in edges:
            yield rest.slice(done, edge + 1 - done)
            done = edge + 1
        rest = rest.slice(done)
    if rest is not None and rest.num_rows:
        yield rest


def shared_keys(members: DataFrame, weight: str = "1") -> DataFrame:
    """(key, node, pivot, weight) of the keys that several nodes have; of keys
    with the same nodes, one, with the sum of their weights (an expression, the
    same in all rows of a key)."""
    keys = (members.groupBy("key").agg(F.min("node").alias("pivot"), F.max("node").alias("last"), F.count("*").alias("nodes"),
                                       F.max(F.expr(weight)).alias("weight"),
                                       F.bit_xor(F.xxhash64("node")).alias("x"),
                                       F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"))
            .filter("pivot <> last")
            .groupBy("pivot", "last", "nodes", "x", "y").agg(F.min("key").alias("key"), F.sum("weight").alias("weight"))
            .select("key", "pivot", "weight"))
    return members.select("key", "node").join(keys, "key").select("key", "node", "pivot", "weight")


def _blocks(size: Column, count: Column) -> Column:
    return F.greatest(F.ceil(count / BLOCK), F.ceil(size / BLOCK_BYTES), F.lit(1)).cast("int")


def _pivot_blocks(shared: DataFrame, sets: DataFrame) -> DataFrame:
    """(block, node, side): each node with its nearest pivot."""
    met = shared.filter("node <> pivot").groupBy("node", "pivot").agg(F.sum("weight").alias("times"))
    nearest = (met.groupBy("node").agg(F.max(F.struct("times", "pivot")).alias("m"))
               .select("node", F.col("m.pivot").alias("pivot")))
    nearest = materialized(nearest.join(sets.select("node", F.octet_length("set").alias("size")), "node"))
    groups = nearest.groupBy("pivot").agg(_blocks(F.sum("size"), F.count("*")).alias("blocks"))
    block = lambda k: F.xxhash64("pivot", k).alias("block")
    dealt = nearest.join(groups, "pivot").select(block(F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")), "node")
    pivots = (groups.withColumn("k", F.explode(F.expr("sequence(0, blocks - 1)")))
              .select(block(F.col("k")), F.col("pivot").alias("node")))
    return dealt.unionByName(pivots).withColumn("side", F.lit(0))


def _tiles(rows: DataFrame, key: str) -> DataFrame:
    """Blocks in which every two nodes of ``rows(key, node, size)`` of a key meet."""
    groups = rows.groupBy(key).agg(_blocks(F.sum("size"), F.count("*")).alias("blocks"))
    tile = lambda k: F.struct(F.xxhash64(F.lit(key), key, F.least("mine", k), F.greatest("mine", k)).alias("block"),
                              (F.col("mine") > k).cast("int").alias("side"))
    return (rows.join(groups, key).withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
            .select("node", F.explode(F.transform(F.expr("sequence(0, blocks - 1)"), tile)).alias("t"))
            .select("t.block", "node", "t.side"))


def _open_blocks(still: DataFrame, sets: DataFrame) -> DataFrame:
    """``still(key, node, pivot)`` -> (block, node, side): blocks in which every two
    nodes that share a key meet.  Side 0 meets side 1, or itself in a block of
    one side.  Nodes that keys hold together, directly or not, are a gang; it
    meets as a whole unless its nodes have fewer keys than it would fill blocks."""
    gangs = connected_components(still.select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct())
    size = sets.select("node", F.octet_length("set").alias("size"))
    held = still.groupBy("node").agg(F.count("*").alias("keys"))
    sized = materialized(gangs.select("node", F.col("component").alias("gang")).join(size, "node").join(held, "node"))
    loose = (sized.groupBy("gang").agg(_blocks(F.sum("size"), F.count("*")).alias("blocks"), F.avg("keys").alias("keys"))
             .filter("blocks > 1 AND blocks > keys").select("gang"))
    by_key = still.select("key", "node").join(sized.join(loose, "gang", "left_semi").select("node", "size"), "node")
    return _tiles(sized.join(loose, "gang", "left_anti").select("gang", "node", "size"), "gang").unionByName(_tiles(by_key, "key"))


def _links(blocks: DataFrame, labels: DataFrame | None, sets: DataFrame, join) -> DataFrame:
    """The forests (a, b) that ``join`` finds in the blocks."""
    rows = blocks.join(sets, "node")
    if labels is None:
        rows = rows.withColumn("lab", F.col("node"))
    else:
        rows = rows.join(labels, "node", "left").withColumn("lab", F.coalesce("component", "node")).drop("component")
    return materialized(rows.select("block", "node", "lab", "side", *[c for c in sets.columns if c != "node"])
                      .repartition("block").sortWithinPartitions("block").mapInArrow(join, "a long, b long"))


def linked_components(shared: DataFrame, sets: DataFrame, join) -> DataFrame:
    """(node, component) of the nodes that are linked with others.

    ``shared``: written rows of shared_keys; ``sets``: (node, set, ...),
    written; ``join``: for mapInArrow, rows (block, node, lab, side, set, ...)
    in order of block -> links (a, b) that join different labs."""
    found = materialized(connected_components(_links(_pivot_blocks(shared, sets), None, sets, join)))
    lab = F.coalesce("component", "node")
    labelled = shared.join(found, "node", "left").select("key", "node", lab.alias("lab"))
    open_keys = (labelled.groupBy("key").agg(F.min("lab").alias("lo"), F.max("lab").alias("hi"))
                 .filter("lo <> hi").select("key"))
    still = materialized(shared.join(open_keys, "key").select("key", "node", "pivot"))
    if still.isEmpty():
        return found
    more = _links(_open_blocks(still, sets), found, sets, join)
    # these join components as wholes
    own = lambda x: found.select(F.col("node").alias(x), F.col("component").alias(f"c{x}"))
    wholes = connected_components(more.join(own("a"), "a", "left").join(own("b"), "b", "left")
                                  .select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")))
    nodes = found.unionByName(more.selectExpr("a AS node").union(more.selectExpr("b AS node")).distinct()
                              .join(found, "node", "left_anti").withColumn("component", F.col("node")))
    outer = wholes.select(F.col("node").alias("component"), F.col("component").alias("whole"))
    return nodes.join(outer, "component", "left").select("node", F.coalesce("whole", "component").alias("component"))


# ---- documents to components ------------------------------------------------

class Bits:
    """A bit array of hashes, broadcast; ``done`` when no task needs it any more."""

    def __init__(self, hashes: DataFrame):
        self.sent = hashes.sparkSession.sparkContext.broadcast(bit_array(hashes))
        self.done = self.sent.destroy

    def hold(self, *columns: str) -> Column:
        """Whether the row may be one of the hashed."""
        bits = self.sent

        def held(hashes: pa.Array) -> pa.Array:
            return pa.array(bits_hold(np.frombuffer(bits.value, np.uint8), hashes.to_numpy().view(np.uint64)))
        return F.arrow_udf(held, "boolean")(F.xxhash64(*columns))


def _shared(signed: DataFrame, classes: DataFrame) -> DataFrame:
    """Rows of shared_keys.  Keys travel once, each with its node; what is met
    by one node only goes where it arrives, exactly, so all later steps grow with
    the shared keys.  A bit array tells one row of each class and lets some more
    pass; these repeat a node."""
    of_class = Bits(classes.select(F.xxhash64("id", "th").alias("hash")))
    rows = signed.filter("n > 0").filter(of_class.hold("id", "th"))
    met = rows.select(F.explode("keys").alias("key"), "node").repartition("key")
    several = met.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo <> hi").select("key")
    # one shuffle by key serves both sides and nothing is sorted; Spark would plan another if it stood right below the join
    turned = met.select("key", F.bitwise_not("node").alias("turned"))
    members = materialized(turned.join(several.hint("shuffle_hash"), "key", "left_semi")
                           .select("key", F.bitwise_not("turned").alias("node")).distinct())
    of_class.done()
    return materialized(shared_keys(members))


def _near(shared: DataFrame, signed: DataFrame, classes: DataFrame, sift) -> DataFrame:
    """``shared`` without the nodes that no other can be linked with, judged by
    sketches instead of sets: nodes that ``sift`` joins, directly or not, stay
    together, and a key counts for each such group alone."""
    owners = classes.join(shared.select("node").distinct(), "node", "left_semi")
    wanted = Bits(owners.select(F.xxhash64("id", "th").alias("hash")))
    sketches = materialized(signed.filter("n > 0").filter(wanted.hold("id", "th"))
                            .groupBy("node").agg(F.first("n").alias("n"), F.first("sketch").alias("set")))
    wanted.done()
    near = linked_components(shared, sketches, sift)
    members = shared.join(near, "node").select(F.xxhash64("key", "component").alias("key"), "node", "weight")
    return materialized(shared_keys(materialized(members), "weight"))


def rows_with_components(df: DataFrame, id_col: str, text_col: str, signed: DataFrame, pack, join,
                         carried: list[str] | None = None, sift=None) -> DataFrame:
    """(id, th, n, node, component) per row of ``df``.

    ``signed``: written (id, th, n, node, keys, ...), th being the text's
    xxhash64, node the hash of its set, n the set's size; ``pack``: texts -> sets,
    an Arrow function; ``carried``: columns of ``signed`` that ``join`` wants.
    ``sift``: as ``join``, with the columns n and set = ``sketch`` of ``signed``;
    finds at least the pairs that ``join`` links.  Sets are then built, and
    shuffled, for the nodes it leaves only.
    Component is the smallest id that links reach: that of the row where n is 0."""
    carried = carried or []
    row = F.min(F.struct(F.col("id").isNull().alias("x"), "id", "th"))  # of a class, one that has an id
    classes = materialized(signed.filter("n > 0").groupBy("node").agg(row.alias("r"), *[F.first(c).alias(c) for c in carried])
                         .select("node", "r.id", "r.th", *carried))
    shared = _shared(signed, classes)
    if sift:
        shared = _near(shared, signed, classes, sift)
    owners = (classes.join(shared.select("node").distinct(), "node", "left_semi")
              .withColumnsRenamed({"id": "oid", "th": "oth"}))
    wanted = Bits(owners.select(F.xxhash64("oid", "oth").alias("hash")))
    texts = df.select(F.col(id_col).alias("tid"), F.xxhash64(text_col).alias("tth"), F.col(text_col).alias("text"))
    sets = materialized(texts.filter(wanted.hold("tid", "tth"))
                      .join(owners, F.col("tid").eqNullSafe(F.col("oid")) & (F.col("tth") == F.col("oth")))
                      .groupBy("node", *carried).agg(F.first("text").alias("text"))
                      .select("node", F.arrow_udf(pack, "binary")("text").alias("set"), *carried))
    wanted.done()
    found = linked_components(shared, sets, join)
    known = classes.select("node", "id").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = known.groupBy("component").agg(F.min("id").alias("least"))
    known = known.join(least, "component").select("node", "least")
    return (signed.select("id", "th", "n", "node").join(known, "node", "left")
            .select("id", "th", "n", "node", F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("least")).alias("component")))
