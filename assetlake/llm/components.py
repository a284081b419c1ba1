"""Connected components of a large graph by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetlake.llm.storage import written


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's least neighbour or itself."""
    near = _both(edges)
    least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return near.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of these."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b")
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select("a", F.col("least").alias("b"))).filter("a != b")


def connected(edges: DataFrame) -> DataFrame:
    """Nodes (fp) of edges (a, b) with the least node of their component (label).

    Each round is written to the shared folder; rounds grow with the logarithm of the nodes. No group is collected:
    minima are combined before the shuffle and joined back.
    """
    now, before = edges, None
    while True:
        now = written(_small_star(_large_star(now)).distinct(), "components")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == before:
            break
        before = tuple(state)
    roots = now.select(F.col("b").alias("fp")).distinct().withColumn("label", F.col("fp"))
    return now.select(F.col("a").alias("fp"), F.col("b").alias("label")).unionByName(roots)
