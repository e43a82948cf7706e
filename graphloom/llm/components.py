"""Connected components of links, by alternating large and small stars, each round a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.llm.text import dealt_anew
from graphloom.session import written


def components(links: DataFrame) -> DataFrame:
    """`node` and `root`, the least node of its component, for every node of `links` (`a`, `b`) but the roots.

    A star round ties each node's greater neighbours, the next its smaller ones, to the least node it knows; the number of
    rounds grows with the logarithm of the longest path. A node of many links is reduced map-side, and the join that
    deals the least node back can be split.
    """
    edges = links.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root")).where("node <> root").distinct()
    edges = written(edges, "links")
    while True:
        both = edges.unionByName(edges.select(F.col("root").alias("node"), F.col("node").alias("root")))
        least = both.groupBy("node").agg(F.min("root").alias("least"))
        least = least.select(dealt_anew("node"), F.least("least", "node").alias("least"))
        large = both.join(least, "node").where("root > node").select(F.col("root").alias("node"), F.col("least").alias("root"))
        large = large.where("node <> root").distinct()
        least = large.groupBy("node").agg(F.min("root").alias("least"))
        small = large.join(least.select(dealt_anew("node"), "least"), "node").where("root <> least").select(F.col("root").alias("node"), F.col("least").alias("root"))
        edges = written(small.unionByName(least.select("node", F.col("least").alias("root"))).distinct(), "stars")
        # Done when every node has one root, and no root has another.
        torn = edges.groupBy("node").count().where("count > 1")
        if torn.isEmpty() and edges.join(edges.select(F.col("root").alias("node")).distinct(), "node", "left_semi").isEmpty():
            return edges


def tied(links: DataFrame) -> DataFrame:
    """`node` and `root`, a node it is connected with, the same for most of a component: the least node within two links,
    and the root of that. Enough to tell much of what is connected, stars above all, without rounds to the end."""
    both = links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(links.select(F.col("b").alias("node"), F.col("a").alias("root")))
    near = both.groupBy("node").agg(F.min("root").alias("root")).select("node", F.least("node", "root").alias("root"))
    near = written(near, "tied")
    around = both.join(near.select(F.col("node").alias("root"), F.col("root").alias("least")), "root")
    near = written(around.groupBy("node").agg(F.min("least").alias("root")), "tied")
    return near.join(near.select(F.col("node").alias("root"), F.col("root").alias("next")), "root").select("node", F.col("next").alias("root"))
