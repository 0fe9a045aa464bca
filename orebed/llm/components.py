"""Connected components of a graph of any size, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orebed.session import stage

#: Rounds after which a graph that still changes is taken for a fault.
MOST_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links (a, b)``: root is the smallest node
    reachable. Nodes without a link are not listed; self links are ignored.

    Alternates the large-star and small-star steps of Kiveris et al., "Connected Components
    in MapReduce and Beyond" (2014): the number of links never grows, and rounds grow with the
    logarithm of the longest path. Each round is written to the shared folder; only a
    count returns to the driver. The minimum of a node's links combines before its
    shuffle, and the join that follows is one Spark can split where a node is hot.
    """
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = stage(links.where("a <> b").distinct())
    for _ in range(MOST_ROUNDS):
        if _is_stars(links):
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                links.select("b", "b").distinct()
            )
        links = stage(_small_star(_large_star(links)))
    raise RuntimeError(f"components not found in {MOST_ROUNDS} rounds")


def _is_stars(links: DataFrame) -> bool:
    """Each node hangs on one smaller node, which hangs on none."""
    middle = links.join(links.select(F.col("b").alias("a")).distinct(), "a", "left_semi")
    twice = links.groupBy("a").count().where("count > 1").select("a")
    return middle.select("a").union(twice).isEmpty()


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is hung on the smallest of the node and its neighbours."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    larger = links.select(F.col("b").alias("a"), F.col("a").alias("far"))
    out = larger.join(least, "a").select(F.col("far").alias("a"), F.least("a", "m").alias("b"))
    return out.distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are hung on the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()
