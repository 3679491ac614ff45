"""Connected components of an edge table by alternating large and small stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.storage import stored


def _oriented(edges: DataFrame) -> DataFrame:
    """Each edge once, from its larger node ``a`` to its smaller node ``b``."""
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Tie every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    roots = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")))
    larger = edges.select(F.col("b").alias("node"), F.col("a").alias("far"))
    tied = larger.join(roots, "node").select(F.col("far").alias("a"), F.least("node", "low").alias("b"))
    return tied.where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Tie a node and its smaller neighbours to the smallest of them."""
    roots = stored(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")))
    smaller = edges.select(F.col("a").alias("node"), F.col("b").alias("near"))
    tied = smaller.join(roots, "node").select(F.col("near").alias("a"), F.col("low").alias("b"))
    own = roots.select(F.col("node").alias("a"), F.col("low").alias("b"))
    return tied.union(own).where("a <> b").distinct()


def _signature(edges: DataFrame):
    return edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of the edges ``(a, b)``; component: smallest node.

    Nodes are of any ordered type; edges need no order, repeats and loops are allowed, edges
    with a null end are ignored. Each round is stored, so a lost executor repeats one round
    at most. Minima are combined before they are shuffled, and stored: the joins with them are then plain shuffle
    joins of two scans, in which adaptive execution splits a hub's rows over several tasks.
    """
    current = stored(_oriented(edges.select("a", "b").dropna()))
    before = _signature(current)
    while before.n:
        current = stored(_small_star(_large_star(current)))
        after = _signature(current)
        if after == before:
            break
        before = after
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
