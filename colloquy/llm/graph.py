"""Connected components of an undirected graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm.common import materialized


def _at_roots(parent: DataFrame) -> DataFrame:
    """Pointers (v, p) followed to their ends; each step doubles the distance."""
    while True:
        up = parent.select(F.col("v").alias("p"), F.col("p").alias("pp"))
        step = materialized(parent.join(up, "p", "left").select("v", F.col("p").alias("was"), F.coalesce("pp", "p").alias("p")))
        parent = step.select("v", "p")
        if step.filter("was <> p").isEmpty():
            return parent


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges(a, b)`` (longs) that has
    another neighbour than itself, component being the smallest node reachable.

    Each round points every node at its smallest neighbour (if smaller),
    follows the pointers to their ends and contracts the edges to these, which
    at least halves the nodes; stars are done after one round.  All steps are
    joins and map-side combined minimums, so one hub with a third of all edges
    is no problem; every round is cut off by written tables."""
    pair = lambda a, b: (F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
    edges = materialized(edges.select(*pair("a", "b")).filter("a <> b").distinct())
    found = None
    while True:
        both = edges.select(F.col("a").alias("v"), F.col("b").alias("u")).union(edges.select("b", "a"))
        near = both.groupBy("v").agg(F.least(F.col("v"), F.min("u")).alias("p"))
        roots = _at_roots(materialized(near))
        if found is None:
            found = roots
        else:
            found = materialized(found.join(roots.select(F.col("v").alias("p"), F.col("p").alias("r")), "p", "left")
                               .select("v", F.coalesce("r", "p").alias("p")))
        edges = materialized(
            edges.join(roots.select(F.col("v").alias("a"), F.col("p").alias("pa")), "a")
            .join(roots.select(F.col("v").alias("b"), F.col("p").alias("pb")), "b")
            .select(*pair("pa", "pb")).filter("a <> b").distinct())
        if edges.isEmpty():
            return found.select(F.col("v").alias("node"), F.col("p").alias("component"))
