"""Connected components by repeated hooking and contraction, with min-aggregates and joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); the component is its smallest node.

    Each round every node hooks onto its smallest neighbour, pointers are halved until they reach
    roots, and the edges are contracted to the roots. A node's neighbours are never gathered: hot
    nodes are reduced by partial aggregation. The driver sees row counts only.
    """
    def undirected(e: DataFrame) -> DataFrame:
        return (e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct())

    left = written(undirected(edges), "cc-edges")
    labels: DataFrame | None = None
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooked = written(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("parent")), "cc-hook")
        while True:
            up = hooked.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
            jumped = written(hooked.join(up, "parent").select("node", F.col("grand").alias("parent"), (F.col("grand") != F.col("parent")).alias("moved")), "cc-jump")
            moved = not jumped.where("moved").isEmpty()
            hooked = jumped.select("node", "parent")
            if not moved:
                break
        root = hooked.select("node", F.col("parent").alias("root"))
        if labels is None:
            labels = root.select("node", F.col("root").alias("component"))
        else:
            labels = labels.join(root.withColumnRenamed("node", "component"), "component", "left").select(
                "node", F.coalesce("root", "component").alias("component"))
        ra, rb = root.toDF("a", "ra"), root.toDF("b", "rb")
        left = written(undirected(left.join(ra, "a").join(rb, "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"))), "cc-edges")
    return written(labels, "cc") if labels is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("component")).limit(0)
