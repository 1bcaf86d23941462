"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.sinks.layers import discard, store


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the least node around it."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("least"))
    return both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node links itself and its smaller neighbours to the least of them. Edges lead from larger to smaller."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    down = edges.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return down.unionByName(least.select("a", F.col("least").alias("b"))).filter(F.col("a") > F.col("b"))


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its least reachable node) for all nodes of the edges ``a``, ``b``, stored.

    Nodes are of any type that can be ordered; null ends, loops and repeated edges are ignored. Every round joins
    and aggregates on a node, never gathers a neighbourhood, and its result is stored in the shared folder.
    """
    edges = edges.filter(F.col("a") != F.col("b"))
    edges = store(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:
        before, edges = edges, store(_small_star(_large_star(edges)).distinct(), "stars")
        discard(before)
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            labelled = edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
            labelled = store(labelled, "components")
            discard(edges)
            return labelled
        seen = state
