"""Connected components of an edge table, by rounds of star operations on stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallgrove.llm.frames import stored


def _toward_least(edges: DataFrame, small: bool) -> DataFrame:
    """Point neighbours at the least neighbour: those above a node (large star) or below it (small star)."""
    if small:
        seen = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    else:
        seen = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
    least = seen.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    joined = seen.join(least, "u")
    if small:
        moved = joined.select(F.col("m").alias("a"), F.col("v").alias("b")).unionByName(
            least.select(F.col("m").alias("a"), F.col("u").alias("b"))
        )
    else:
        moved = joined.filter("v > u").select(F.col("m").alias("a"), F.col("v").alias("b"))
    return moved.filter("a < b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes of the (a, b) edges; the component is its least node.

    Self-loops are ignored. Each round is two shuffled joins on nodes; a node with very many
    edges is met as a minimum (pre-aggregated) and as a splittable join side.
    """
    edges = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct()
    edges = stored(edges, "edges")
    mark = None
    while True:
        edges = stored(_toward_least(_toward_least(edges, False), True), "edges")
        # As soon as every node points at a root that points nowhere, a round changes nothing.
        now = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if now == mark:
            break
        mark = now
    roots = edges.select(F.col("a").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(roots)
