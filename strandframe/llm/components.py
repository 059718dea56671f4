"""Connected components of a table of links, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import write_table


def _least_parent(edges: DataFrame) -> DataFrame:
    """On file, so that Spark knows its size and can split a skewed join with it."""
    return write_table(edges.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m")), "least")


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for each node of links (a, b), root being the component's smallest node. Links with equal or null ends add nothing.

    A round ties the smaller neighbours of every node to the smallest of them, and then every node to its neighbour's smallest one. The
    work of a round follows the number of links, which never grows and after the first step is about one a node; rounds are few as trees
    shrink to stars. Steps are written to the shared folder, so lost executors cost one at most; minima are taken before shuffling.
    """
    edges = links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = write_table(edges, "links")
    while True:
        least = _least_parent(edges)
        others = edges.join(least, (F.col("a") == F.col("n")) & (F.col("b") != F.col("m"))).select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = write_table(others.union(least.select("n", "m")).distinct(), "links")
        least = _least_parent(edges)
        deep = edges.join(least, F.col("b") == F.col("n"), "left_semi").isEmpty()
        if deep and edges.count() == least.count():  # every node has one neighbour, which has none
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select(F.col("b"), F.col("b")).distinct())
        edges = edges.join(least, F.col("b") == F.col("n"), "left").select("a", F.coalesce("m", "b").alias("b")).distinct()
        edges = write_table(edges, "links")
