"""Weakly connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlake.graph.graph import Graph
from airlake.scratch import keep, working_area


def connected_components(graph: Graph) -> DataFrame:
    """Vertices with ``component``, the smallest id reachable when direction is ignored.

    Alternating large-star and small-star steps on (child, parent) pairs, child >
    parent (Kiveris et al. 2014): the number of rounds grows with the logarithm of
    the graph, not with its diameter, and the number of pairs does not grow.
    Finished when every pair points from a vertex to a root.
    """
    with working_area(graph.edges.sparkSession) as area:
        pairs = area.keep(
            graph.edges.where(F.col("src") != F.col("dst"))
            .select(F.greatest("src", "dst").alias("child"), F.least("src", "dst").alias("parent"))
            .distinct(),
            "pairs",
        )
        while True:
            nodes = area.keep(_neighbourhoods(pairs), "nodes")
            if nodes.where("parents > 1 OR (parents > 0 AND children > 0)").isEmpty():
                break
            pairs = area.keep(_small_star(_large_star(pairs, nodes)), "pairs")
        roots = keep(pairs.select(F.col("child").alias("id"), F.col("parent").alias("_root")), "roots")
    return (
        graph.vertices.join(roots, "id", "left")
        .withColumn("component", F.coalesce("_root", "id"))
        .drop("_root")
    )


def _neighbourhoods(pairs: DataFrame) -> DataFrame:
    """Per vertex: the lowest id around it, itself included, and how many pairs on either side."""
    up = pairs.select(
        F.col("child").alias("node"), F.col("parent").alias("low"), F.lit(1).alias("up"), F.lit(0).alias("down")
    )
    down = pairs.select(
        F.col("parent").alias("node"), F.col("parent").alias("low"), F.lit(0).alias("up"), F.lit(1).alias("down")
    )
    return up.union(down).groupBy("node").agg(
        F.min("low").alias("lowest"), F.sum("up").alias("parents"), F.sum("down").alias("children")
    )


def _large_star(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Move every child to the lowest vertex its parent knows."""
    lowest = nodes.where("children > 0").select(F.col("node").alias("parent"), "lowest")
    return pairs.join(lowest, "parent").select("child", F.col("lowest").alias("parent"))


def _small_star(pairs: DataFrame) -> DataFrame:
    """Tie every child and its other parents to its lowest parent."""
    nearest = pairs.groupBy("child").agg(F.min("parent").alias("nearest"))
    others = pairs.join(nearest, "child").where(F.col("parent") != F.col("nearest")).select(
        F.col("parent").alias("child"), F.col("nearest").alias("parent")
    )
    return others.unionByName(nearest.withColumnRenamed("nearest", "parent")).distinct()
