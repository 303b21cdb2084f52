"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakepipe.session import checkpoint


def _unfinished(edges: DataFrame) -> bool:
    """Whether some node points to two others, or to one that points on."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("in")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("in"))
    )
    by_node = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("in").alias("in"))
    return not by_node.filter("out > 1 OR (out > 0 AND in > 0)").isEmpty()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b); root is the smallest node it is connected with.

    A link of a node with itself only names it.

    Alternates large-star and small-star steps (Kiveris et al., 2014) until every node points to its
    root: a logarithmic number of rounds in practice, each one an aggregation with a map-side part
    and a join. The table is written to the shared folder between rounds.
    """
    own = links.filter("a = b").select(F.col("a").alias("node"))
    edges = checkpoint(
        links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    while _unfinished(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("low", "u").alias("low"))
        # Large star: every larger neighbour of u now points to u's smallest neighbour.
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        # Small star: u and all its smaller neighbours point to the smallest of them.
        lowest = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(lowest, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("low").alias("v"))
        edges = checkpoint(small.filter("u <> v").distinct())
    found = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    lone = edges.select(F.col("v").alias("node")).unionByName(own.join(edges, F.col("node") == F.col("u"), "left_anti"))
    return found.unionByName(lone.distinct().select("node", F.col("node").alias("root")))
