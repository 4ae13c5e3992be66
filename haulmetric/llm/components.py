"""Connected components of an edge table, by alternating large and small stars.

Every round is one grouped minimum and one join, both on keys that grow no row count; a node
with very many neighbours is combined map-side in the minimum, and split by adaptive execution
in the join. Each round's edges are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmetric.llm.common import saved


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """Rows (node, component) for every node of edges (a, b); the component is its least node."""
    edges = saved(_both(edges).filter("a > b").distinct(), label)
    while True:
        least = _both(edges).groupBy("a").agg(F.min("b").alias("m"))
        # Large star: larger neighbours move to the least node of the neighbourhood.
        large = (
            _both(edges)
            .join(least, "a")
            .select(F.col("b").alias("a"), F.least("m", "a").alias("b"))
            .filter("a > b")
            .distinct()
        )
        # Small star: smaller neighbours, and the node itself, move to the least of them.
        small_least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(small_least, "a")
            .select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
            .filter("a > b")
            .distinct()
        )
        after = saved(small, label)
        # A forest of stars: no node is both a leaf and a centre, and no leaf has two centres.
        leaves = after.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
        centres = after.select(F.col("b").alias("a")).distinct()
        if leaves.filter("n > 1").isEmpty() and leaves.join(centres, "a", "left_semi").isEmpty():
            break
        edges = after
    return after.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        after.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(
        edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    )
