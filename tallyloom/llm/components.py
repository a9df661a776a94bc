"""Connected components of a graph of links, by stars that grow and merge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.tables import written


def _mark(edges: DataFrame) -> tuple:
    """Equal for equal sets of edges."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node points to the smallest of the node and its neighbours."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    hub = F.least("a", "least")
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), hub.alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours point to the smallest of these."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    joined = down.join(least, "a")
    others = joined.where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return others.union(least.select("a", F.col("least").alias("b"))).distinct()


def _edges(links: DataFrame) -> DataFrame:
    return links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _named(edges: DataFrame) -> DataFrame:
    """(node, component) of edges that point to hubs; a node with two hubs goes by the smaller one."""
    nodes = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
    hubs = edges.select(F.col("b").alias("node")).distinct().join(nodes.select("node"), "node", "left_anti")
    return nodes.union(hubs.withColumn("component", F.col("node")))


def components(links: DataFrame) -> DataFrame:
    """From links (a, b): (node, component), where a component is named by its smallest node.

    Nodes without links are left out, as are links of a node to itself. Each round is written to the
    shared folder; rounds grow with the logarithm of a component's width. A node of many links is summed
    up before it is shuffled, and only its links are joined to its one sum.
    """
    edges = written(_edges(links), "links")
    before, now = None, _mark(edges)
    while now != before:
        edges = written(_small_star(_large_star(edges)), "stars")
        before, now = now, _mark(edges)
    return _named(edges)
