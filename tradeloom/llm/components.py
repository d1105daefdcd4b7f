"""Connected components of a table of links, in rounds of joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.tables import written

#: Rounds after which something must be wrong; each at least halves the longest path.
MOST_ROUNDS = 60


def _both_ways(links: DataFrame) -> DataFrame:
    return links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(links: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is linked to the node's least neighbour (or itself)."""
    both = _both_ways(links)
    least = written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least")), "least")
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the least of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = written(down.groupBy("a").agg(F.min("b").alias("least")), "least")
    moved = down.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.union(least.select("a", F.col("least").alias("b"))).where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """node and component (its least reachable node) of the nodes of links (a, b).

    Nodes that are their own component are left out: the least ones, and those that only
    link to themselves. Every round
    is written to the shared folder, so a lost executor costs one round at most.
    """
    links = written(links.select("a", "b").where("a <> b").distinct(), "links")
    for _ in range(MOST_ROUNDS):
        if _settled(links):
            return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
        links = written(_small_star(written(_large_star(links), "links")), "links")
    raise RuntimeError("components did not settle")


def _settled(links: DataFrame) -> bool:
    """Whether every node is linked to one smaller node, which itself has no smaller one."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"), (F.col("a") < F.col("b")).alias("wrong"))
    tops = links.select(F.col("b"), F.lit(0), F.lit(1), F.lit(False))
    nodes = ends.union(tops).groupBy("node").agg(F.sum("up").alias("up"), F.sum("down").alias("down"), F.max("wrong").alias("wrong"))
    return nodes.where("wrong or up > 1 or (up > 0 and down > 0)").isEmpty()
