"""Connected components of a link table, by alternating large and small stars.

Each step is a grouped minimum and a join; no neighbour list is ever gathered,
so a node with very many links only makes a longer (splittable) join. Every
step is written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inforce.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(edges.select(F.col("b"), F.col("a")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    # after a large star every edge points from the larger to the smaller node
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return least.select("a", F.col("m").alias("b")).unionAll(moved).filter(F.col("a") != F.col("b")).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (two long columns a, b);
    component is the smallest node reachable. Self links and nulls say nothing;
    an empty table gives an empty result."""
    a, b = F.greatest("a", "b"), F.least("a", "b")
    edges = written(links.filter(F.col("a") != F.col("b")).select(a.alias("a"), b.alias("b")).distinct(), "links")
    while True:
        edges = written(_small_star(_large_star(edges)), "stars")
        # done when every node has one edge, to a node that has none
        several = edges.groupBy("a").count().filter("count > 1").select("a")
        passed_on = edges.select(F.col("b").alias("a")).distinct().join(edges.select("a"), "a", "left_semi")
        if several.unionAll(passed_on).isEmpty():
            break
    # every edge is (node, component)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(edges.select(F.col("b"), F.col("b")).distinct())
