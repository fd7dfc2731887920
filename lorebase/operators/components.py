"""Connected components of an edge table, for nodes of any ordered type."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lorebase.sources.tables import discard, materialise


def _down(edges: DataFrame) -> DataFrame:
    """Edges from the larger node to the smaller one, once each."""
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()


def _fact(edges: DataFrame) -> tuple:
    h = F.pmod(F.xxhash64("a", "b"), F.lit((1 << 31) - 1).cast("long"))
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(h)).first())


def _step(tree: DataFrame) -> DataFrame:
    """A node's larger neighbours are tied to its least one, then a node and its smaller ones to the least of them."""
    both = tree.unionAll(tree.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.least("m", "a").alias("b"))
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    return large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for all nodes of the edges (a, b); the label is the least node reached. A written table.

    Steps grow with the logarithm of a component's size; an edge from a node to itself only names the node.
    """
    every = materialise(edges.select("a", "b").distinct(), "edges")
    now = materialise(_down(every), "edges")
    last = _fact(now)
    while last[0]:
        before, now = now, materialise(_down(_step(now)), "edges")
        discard(before)
        fact = _fact(now)
        if fact == last:
            break
        last = fact
    nodes = every.select(F.col("a").alias("node")).unionAll(every.select(F.col("b").alias("node"))).distinct()
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out = materialise(nodes.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("label")), "components")
    discard(now, every)
    return out
