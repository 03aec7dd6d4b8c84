"""Connected components of an edge table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.scratch import materialize


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for every node of ``a``-``b`` edges.

    Each round every node moves to the smallest of itself and its neighbours, and edges within
    one node end; so each component at least halves, and rounds grow with the logarithm of its
    longest path. Every table of a round is written, so no plan grows. A node with very many
    edges is met by partial aggregation and by joins that Spark may split.
    """
    edges = materialize(edges.filter("a <> b").select("a", "b").distinct(), "edges")
    moves: list[DataFrame] = []
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        step = both.groupBy("a").agg(F.min("b").alias("b")).select(
            F.col("a").alias("node"), F.least("a", "b").alias("root"))
        step = materialize(step, "step")
        moves.append(step)
        to_a = step.withColumnsRenamed({"node": "a", "root": "ra"})
        to_b = step.withColumnsRenamed({"node": "b", "root": "rb"})
        moved = edges.join(to_a, "a").join(to_b, "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
        edges = materialize(moved.filter("a <> b").distinct(), "edges")
    if not moves:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = moves[0]
    for step in moves[1:]:
        later = step.select(F.col("node").alias("root"), F.col("root").alias("later"))
        found = found.join(later, "root", "left").select("node", F.coalesce("later", "root").alias("root"))
    return found
