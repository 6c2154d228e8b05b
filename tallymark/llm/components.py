"""Connected components of a large graph, by rounds of joins that halve long paths."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.shared import written

ROUNDS = 60  # far beyond what any graph needs; passing it means a fault, not a cut result


def component_roots(links: DataFrame) -> DataFrame:
    """``node, root`` for every node that has a smaller one in its component.

    ``links``: ``a, b`` with a < b. The root is the component's smallest node. Every round
    hangs each node's smaller neighbours, and then its larger ones, below the smallest of
    them (alternating small and large stars). The rounds' tables go to shared storage, so
    both sides of every join are plain reads and a node with very many links can be split.
    """
    links = written(links.distinct(), "links")
    for _ in range(ROUNDS):
        least = written(links.groupBy("b").agg(F.min("a").alias("root")), "least")
        # Small star: all smaller neighbours of b, and b itself, point to the least of them.
        down = links.join(least, "b").where("a <> root").select(F.col("root").alias("a"), F.col("a").alias("b"))
        stars = written(
            least.select(F.col("root").alias("a"), "b").union(down).distinct(), "links"
        )
        # Large star: whatever hangs below a moves to the least neighbour of a.
        least = written(stars.groupBy("b").agg(F.min("a").alias("root")), "least")
        upper = least.select(F.col("b").alias("a"), F.col("root"))
        moved = stars.join(upper, "a", "left")
        links = written(
            moved.select(F.coalesce("root", "a").alias("a"), "b").distinct(), "links"
        )
        # Done when every link goes from a node to its root: roots have nothing above them,
        # and each node has one link.
        n_links, n_nodes = links.agg(F.count("*"), F.countDistinct("b")).first()
        above = links.join(links.select(F.col("b").alias("a")).distinct(), "a", "left_semi")
        if n_links == n_nodes and above.isEmpty():
            return links.select(F.col("b").alias("node"), F.col("a").alias("root"))
    raise RuntimeError(f"components are not settled after {ROUNDS} rounds")
