"""Connected components of an edge table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlight.session import remove, store


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the least node of its neighbourhood."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("root"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("root").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the least of them; edges run from larger to smaller."""
    least = edges.groupBy("a").agg(F.min("b").alias("root"))
    others = edges.join(least, "a").where("b <> root").select(F.col("b").alias("a"), F.col("root").alias("b"))
    return others.union(least.select("a", F.col("root").alias("b"))).distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether every node hangs on one root that hangs on nothing."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("hangs")).union(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("hangs")).distinct()
    )
    nodes = ends.groupBy("node").agg(F.sum("hangs").alias("ups"), F.min("hangs").alias("roots"))
    return nodes.where("ups > 1 or (ups = 1 and roots = 0)").isEmpty()


def connected_components(edges: DataFrame, purpose: str = "components") -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the least node reachable.

    Both stars keep a node's hub as an aggregate, so a hub with very many neighbours is
    joined to its edges and never gathered. Each round is written to the shared folder, and the
    one before removed; the rounds end when every node hangs on a root, after about the
    logarithm of the longest path. Repeated edges and loops do no harm. No edges: no rows.
    """
    rows = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    rows, path = store(rows, purpose)
    settled = rows.isEmpty()
    while not settled:
        last = path
        rows, path = store(_small_star(_large_star(rows)), purpose)
        remove(edges.sparkSession, last)
        settled = _settled(rows)
    return rows.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        rows.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
