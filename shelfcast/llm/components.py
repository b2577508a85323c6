"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.session import discard, materialize


def contracted(edges: DataFrame) -> DataFrame:
    """Edges (a, b) with a > b of the same components, every neighbour hung on the smallest node near it.

    First the larger neighbours of each node (large star), then the smaller ones (small star);
    both keep the components and shorten all paths to the smallest node.
    """
    both = edges.select(F.inline(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    least = large.groupBy("a").agg(F.min("b").alias("least"))
    small = large.join(least, "a").select(F.inline(F.array(F.struct("a", F.col("least").alias("b")), F.struct(F.col("b").alias("a"), F.col("least").alias("b")))))
    return small.where("a <> b").distinct()


def connected(links: DataFrame) -> DataFrame:
    """(node, label) for every node of `links` (a, b): label is the smallest node of its component.

    Ends when every node hangs on one node, which hangs on nothing; the number of rounds
    grows with the logarithm of the longest path. No links give no rows.
    """
    edges = materialize(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "edges")
    while True:
        ends = edges.select(F.inline(F.array(*(F.struct(F.col(c).alias("node"), F.lit(hangs).alias("hangs"), F.lit(1 - hangs).alias("bears")) for c, hangs in (("a", 1), ("b", 0))))))
        state = ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("bears").alias("bears"))
        if not state.where("hangs + bears > 1").limit(1).count():
            break
        before, edges = edges, materialize(contracted(edges), "edges")
        discard(before)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).union(edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
