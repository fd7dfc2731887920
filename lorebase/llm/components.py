"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lorebase.sources.tables import discard, materialise


def _fact(edges: DataFrame) -> tuple:
    h = F.pmod(F.xxhash64("a", "b"), F.lit((1 << 31) - 1).cast("long"))
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(h)).first())


def _ordered(edges: DataFrame) -> DataFrame:
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's least neighbour or itself."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.least("m", "u").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("a", F.col("m").alias("b")))


#: Edges a task of an iteration takes at least; small graphs are not dealt out over all partitions.
TASK_EDGES = 200_000


def _few(edges: DataFrame, n: int) -> DataFrame:
    return edges.coalesce(max(1, -(-n // TASK_EDGES)))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) of every node with an edge; label is the least node reached. Labels' own rows are included.

    Only counts reach the driver. Steps grow with the logarithm of the component size.
    """
    edges = materialise(_ordered(edges.select(F.col(a).alias("a"), F.col(b).alias("b"))), "edges")
    before = _fact(edges)
    while before[0]:
        n = before[0]
        wide = _few(_ordered(_large_star(_few(edges, n))), n)
        last, edges = edges, materialise(_few(_ordered(_small_star(wide)), n), "edges")
        discard(last)
        now = _fact(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionAll(
        edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    )
