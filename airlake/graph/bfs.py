"""Breadth-first search between two sets of vertices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlake.graph.graph import Graph
from airlake.scratch import cut_lineage


def _ids(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.select(F.col(column).alias(name)).distinct()


def bfs(graph: Graph, from_expr: str, to_expr: str, max_length: int = 10) -> DataFrame:
    """All shortest paths from one set of vertices to the other.

    One length for the whole search: the smallest at which any start reaches any
    target. Columns are structs ``from, e0, v1, e1, …, to``. Nothing found within
    ``max_length`` gives an empty frame with ``from`` and ``to``.

    The search itself moves sets of vertices, never paths: level i holds the
    vertices first reached by i edges. Once a level meets the targets, edges
    between levels that lead to one are picked from the back, and only those are
    joined to paths.
    """
    structs = graph.vertices.select(F.struct("*").alias("_vertex"), F.col("id").alias("_vertex_id"))
    starts = graph.vertices.where(from_expr)
    targets = graph.vertices.where(to_expr).select(F.col("id").alias("_target"))

    level = cut_lineage(_ids(starts, "id", "_reached"))
    hit = _hits(level, targets)
    levels = [level]
    seen = level
    while hit.isEmpty() and len(levels) <= max_length:
        step = graph.edges.join(level, F.col("src") == F.col("_reached"), "left_semi")
        found = _ids(step, "dst", "_found")
        level = cut_lineage(
            found.join(seen, F.col("_found") == F.col("_reached"), "left_anti")
            .withColumnRenamed("_found", "_reached")
        )
        if level.isEmpty():
            break
        seen = seen.unionByName(level)
        levels.append(level)
        hit = _hits(level, targets)
    length = len(levels) - 1

    if length == 0 or hit.isEmpty() or length > max_length:
        both = graph.vertices.where(from_expr).where(to_expr)
        met = length == 0 and not hit.isEmpty()
        pair = both.select(F.struct("*").alias("from"), F.struct("*").alias("to"))
        return pair if met else pair.where(F.lit(False))

    # From the back: edges of each level that still lead to a target.
    useful, wanted = [], hit
    for i in range(length, 0, -1):
        leaving = graph.edges.join(levels[i - 1], F.col("src") == F.col("_reached"), "left_semi")
        ends = wanted.select(F.col("_reached").alias("_wanted"))
        leading = cut_lineage(leaving.join(ends, F.col("dst") == F.col("_wanted"), "left_semi"))
        useful.insert(0, leading)
        wanted = _ids(leading, "src", "_reached")

    paths = None
    for i, leading in enumerate(useful):
        name = "to" if i == length - 1 else f"v{i + 1}"
        edge = leading.select(F.struct("*").alias(f"e{i}"))
        end = structs.select(F.col("_vertex").alias(name), "_vertex_id")
        if paths is None:
            begin = structs.select(F.col("_vertex").alias("from"), "_vertex_id")
            paths = begin.join(edge, F.col("_vertex_id") == F.col("e0.src")).drop("_vertex_id")
        else:
            paths = paths.join(edge, F.col(f"v{i}.id") == F.col(f"e{i}.src"))
        paths = paths.join(end, F.col("_vertex_id") == F.col(f"e{i}.dst")).drop("_vertex_id")
    return paths


def _hits(level: DataFrame, targets: DataFrame) -> DataFrame:
    return cut_lineage(level.join(targets, F.col("_reached") == F.col("_target"), "left_semi"))


def route_columns(paths: DataFrame) -> DataFrame:
    """BFS rows as (segments, route, distance_km)."""
    edges = [c for c in paths.columns if c.startswith("e") and c[1:].isdigit()]
    stops = ["from", *(f"v{i}" for i in range(1, len(edges))), "to"]
    distance = F.lit(0.0)
    for edge in edges:
        distance = distance + F.col(f"{edge}.distance_km")
    return paths.select(
        F.lit(len(edges)).alias("segments"),
        F.concat_ws(" → ", *(F.col(f"{stop}.code") for stop in stops)).alias("route"),
        distance.alias("distance_km"),
    )


def busiest_without_direct_edge(graph: Graph, from_expr: str, to_expr: str, n: int = 1) -> DataFrame:
    """Vertices of one set with no edge into the other, those with most departures first."""
    targets = graph.vertices.where(to_expr).select(F.col("id").alias("_target"))
    direct = graph.edges.join(targets, F.col("dst") == F.col("_target"), "left_semi")
    connected = _ids(direct, "src", "_connected")
    return (
        graph.vertices.where(from_expr)
        .join(connected, F.col("id") == F.col("_connected"), "left_anti")
        .join(graph.out_degrees.withColumnRenamed("outDegree", "departures"), "id")
        .orderBy(F.desc("departures"), "id")
        .limit(n)
    )
