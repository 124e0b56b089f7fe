"""A directed graph as a pair of DataFrames."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlake.scratch import keep


def collapse_routes(routes: DataFrame) -> DataFrame:
    """Parallel routes as one directed pair: number of airlines and of routes.

    Done before anything is looked up for the ends: what is joined afterwards is
    a row per pair, not per route.
    """
    return routes.groupBy("src_id", "dst_id").agg(
        F.count_distinct("airline_id").alias("airlines"), F.count(F.lit(1)).alias("flights")
    )


def edges_of(pairs: DataFrame) -> DataFrame:
    """Located pairs as edges."""
    return pairs.select(F.col("src_id").alias("src"), F.col("dst_id").alias("dst"), "distance_km", "airlines")


def touched_vertices(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Only vertices at one end of an edge at least."""
    ends = edges.select(F.col("src").alias("_end")).union(edges.select("dst")).distinct()
    return vertices.join(ends, F.col("id") == F.col("_end"), "left_semi")


class Graph:
    """``vertices`` has a unique ``id``, ``edges`` has ``src`` and ``dst``; other columns are free.

    Vertices with very many edges are left to the adaptive skew join, which splits
    what a shuffle has measured; loops that keep their edges in place split them
    by the degree instead.
    """

    def __init__(self, vertices: DataFrame, edges: DataFrame):
        missing = ({"id"} - set(vertices.columns)) | ({"src", "dst"} - set(edges.columns))
        if missing:
            raise ValueError(f"graph lacks columns {sorted(missing)}")
        self.vertices = vertices
        self.edges = edges

    def kept(self) -> Graph:
        """The same graph over materialised tables, for work that scans it many times."""
        return Graph(keep(self.vertices, "vertices"), keep(self.edges, "edges"))

    def cache(self) -> Graph:
        self.vertices.cache()
        self.edges.cache()
        return self

    def unpersist(self) -> Graph:
        self.vertices.unpersist()
        self.edges.unpersist()
        return self

    @cached_property
    def coded_edges(self) -> DataFrame:
        """Edges with the code of the vertex they lead to, materialised once for all searches."""
        codes = self.vertices.select(F.col("id").alias("_id"), "code")
        hops = self.edges.select("src", "dst", "distance_km").join(codes, F.col("dst") == F.col("_id"))
        return keep(hops.drop("_id"), "hops")

    @property
    def in_degrees(self) -> DataFrame:
        return self.edges.groupBy(F.col("dst").alias("id")).agg(F.count(F.lit(1)).alias("inDegree"))

    @property
    def out_degrees(self) -> DataFrame:
        return self.edges.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("outDegree"))

    def degrees(self, how: str = "inner") -> DataFrame:
        """In- and out-degree; the inner join leaves out vertices that lack one of them."""
        return self.in_degrees.join(self.out_degrees, "id", how)

    def sizes(self) -> DataFrame:
        from airlake.operators.aggregates import row_counts

        return row_counts({"vertices": self.vertices, "edges": self.edges})


def degree_centrality(graph: Graph, n: int) -> DataFrame:
    """Vertices with the most departures, smaller id first on ties."""
    return (
        graph.vertices.join(graph.degrees(), "id").orderBy(F.desc("outDegree"), F.asc("id")).limit(n)
    )
