"""Connected components of an edge table by alternating stars, each round one pair of shuffles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learnlake.llm.common import written


def _state(edges: DataFrame) -> tuple:
    """Row count and an order-free digest: equal when nothing changed."""
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def _nearest(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is hung below the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    hung = both.join(_nearest(both), "u").where("v > u")
    return hung.select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are hung below the smallest of them."""
    nearest = _nearest(edges)
    moved = edges.join(nearest, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(nearest.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(node, root) of every node with an edge to another one; ``root`` is the component's smallest node.

    Self-links and repeated or reversed edges make no difference; no edge gives no rows. Each round's edges are
    written to the shared folder, so neither lineage nor the loss of an executor matters; the number of rounds is
    logarithmic, and a hub's edges are pre-aggregated (minimum) or split by an ordinary join.
    """
    pairs = edges.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v")).where("u != v")
    current = written(pairs.distinct(), "edges")
    state = _state(current)
    while state[0]:
        current = written(_small_star(_large_star(current)), "edges")
        before, state = state, _state(current)
        if state == before:
            break
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
