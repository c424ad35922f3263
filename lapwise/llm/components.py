"""Connected components by alternating large-star and small-star steps.

Each step links nodes to the smallest neighbour known, so the graph turns into
stars in a few rounds. Every round is written to the shared folder, which cuts
the lineage. A hub's edges are joined with one row, a join that Spark can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapwise.session import materialised


def _unsettled(edges: DataFrame) -> bool:
    """Whether some node has two smaller neighbours, or one and also a larger neighbour."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.union(edges.select("b", F.lit(0), F.lit(1))).groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return bool(ends.filter((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).limit(1).count())


def _with_smallest(edges: DataFrame) -> DataFrame:
    """`edges` (a, b) with m, the smallest of `a` and its neighbours `b`."""
    smallest = edges.groupBy(F.col("a").alias("s")).agg(F.min("b").alias("m"))
    joined = edges.join(smallest, edges["a"] == smallest["s"])
    return joined.select("a", "b", F.least("a", "m").alias("m"))


def connected_components(edges: DataFrame) -> DataFrame | None:
    """(node, component) for every node of an edge (a, b); component is the smallest node.

    Loops and repeated edges do no harm, edges with a null end are dropped.
    None if no edge joins two different nodes.
    """
    edges = edges.select("a", "b").filter(F.col("a") != F.col("b"))
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = materialised(edges, "edges")
    if not edges.limit(1).count():
        return None
    while _unsettled(edges):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _with_smallest(both).filter(F.col("b") > F.col("a"))
        large = large.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        down = _with_smallest(large)
        small = down.select(F.col("b").alias("a"), F.col("m").alias("b")).union(down.select("a", F.col("m").alias("b")))
        edges = materialised(small.filter(F.col("a") != F.col("b")).distinct(), "edges")
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(edges.select("b", F.col("b").alias("c"))).distinct()
