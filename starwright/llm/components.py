"""Connected components of a table of links, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starwright.storage import written

MOST_ROUNDS = 64


def _least(edges: DataFrame, key: str, other: str) -> DataFrame:
    """The least neighbour of each node, itself included; folds a hot node before the shuffle."""
    return edges.groupBy(F.col(key).alias("node")).agg(F.least(F.min(other), F.min(key)).alias("least"))


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node that has a link; the component is its least node.

    ``links`` has (a, b). Each round points every larger neighbour of a node to
    the node's least neighbour, then every smaller one (large star and small
    star); rounds are logarithmic in the longest path. The state is a table of
    at most as many edges as at first, written after each round.
    """
    edges = links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = written(edges, "links")
    for _ in range(MOST_ROUNDS):
        # Large star: all larger neighbours of a node go to the node's least neighbour.
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = written(_least(both, "a", "b"), "stars")
        large = edges.join(least, edges["b"] == least["node"]).select("a", F.col("least").alias("b")).where("a != b").distinct()
        # Small star: a node and its smaller neighbours go to the least of them.
        large = written(large, "large-star")
        least = written(_least(large, "a", "b"), "stars")
        small = large.join(least, large["a"] == least["node"]).select(F.col("b").alias("a"), F.col("least").alias("b"))
        small = small.unionByName(least.select(F.col("node").alias("a"), F.col("least").alias("b")))
        edges = written(small.where("a != b").distinct(), "links")
        centres = edges.select("b").distinct()
        if edges.select("a").join(centres, F.col("a") == F.col("b"), "left_semi").isEmpty():
            # Stars only: no centre points on.
            whole = edges.unionByName(centres.select(F.col("b").alias("a"), "b"))
            return whole.select(F.col("a").alias("node"), F.col("b").alias("component"))
    raise RuntimeError(f"links did not contract in {MOST_ROUNDS} rounds")
