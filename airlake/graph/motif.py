"""Structural patterns such as ``(a)-[e1]->(b); (b)-[e2]->(c)``."""

from __future__ import annotations

import re
from functools import reduce
from itertools import pairwise
from operator import and_
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlake.graph.cycles import four_cycles, triangles
from airlake.graph.graph import Graph
from airlake.scratch import keep

_TERM = re.compile(r"\s*\((\w+)\)-\[(\w+)\]->\((\w+)\)\s*")


class Term(NamedTuple):
    """One edge of a pattern and the vertices it leads between."""

    start: str
    edge: str
    end: str


def parse(pattern: str) -> list[Term]:
    """The terms of a pattern written as text."""
    found = [_TERM.fullmatch(term) for term in pattern.split(";")]
    if not all(found):
        raise ValueError(f"not a list of (a)-[e]->(b) terms: {pattern}")
    return [Term(*m.groups()) for m in found]


def walk(stops: str | list[str]) -> list[Term]:
    """A walk through vertices in the order of their names; its edges are named by their ends."""
    return [Term(a, f"{a}_{b}", b) for a, b in pairwise(stops)]


def reduced(graph: Graph, terms: list[Term], bound: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Per term the edges that can be part of a match, each written once.

    Semi-joins only: from the first term to the last an edge stays if its ends may stand where its names
    say, then the same way back. In a chain each edge left is part of a walk from one bound end to the
    other, so no join of the search gives a row that leads nowhere.
    """
    allowed = {name: vertices.select(F.col("id").alias("_id")).distinct() for name, vertices in bound.items()}
    edges = {term.edge: graph.edges for term in terms}
    for term in [*terms, *terms[-2::-1]]:
        ends = {"src": term.start, "dst": term.end}
        known = [(column, allowed[name]) for column, name in ends.items() if name in allowed]
        for column, ids in known:
            edges[term.edge] = edges[term.edge].join(ids, F.col(column) == F.col("_id"), "left_semi")
        if known:
            edges[term.edge] = keep(edges[term.edge], "reduced")
            allowed |= {name: edges[term.edge].select(F.col(column).alias("_id")).distinct() for column, name in ends.items()}
    return edges


def _closed(terms: list[Term]) -> bool:
    """Whether the terms are one directed cycle of three or four names."""
    names = [term.start for term in terms]
    return len(terms) in (3, 4) and len(set(names)) == len(terms) and [t.end for t in terms] == names[1:] + names[:1]


def _cycle_matches(graph: Graph, terms: list[Term]) -> DataFrame:
    """Matches of a closed pattern over different vertices: cycles first, then what is on them."""
    matches = (triangles if len(terms) == 3 else four_cycles)(graph)
    matches = matches.toDF(*(f"_{term.start}" for term in terms))
    for start, edge, end in terms:
        edges = graph.edges.select(F.struct("*").alias(edge))
        matches = matches.join(edges, (F.col(f"{edge}.src") == F.col(f"_{start}")) & (F.col(f"{edge}.dst") == F.col(f"_{end}")))
    for term in terms:
        vertex = graph.vertices.select(F.struct("*").alias(term.start))
        matches = matches.join(vertex, F.col(f"{term.start}.id") == F.col(f"_{term.start}"))
    return matches.drop(*(f"_{term.start}" for term in terms))


def find_motif(
    graph: Graph,
    pattern: str | list[Term],
    distinct: bool = False,
    bound: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """All matches, one struct column per named vertex and edge.

    ``distinct`` asks for different vertices under different names: each join that
    brings a vertex in compares it with those before, so a repetition ends there.
    ``bound`` restricts names to given vertices; the edges of every term are then reduced to those
    that such matches can use (``reduced``) before any is joined. Directed cycles of three or
    four different vertices are found without their open wedges (``airlake.graph.cycles``).
    Others are a chain of equi-joins; a term must share a vertex with an earlier one.
    """
    terms = parse(pattern) if isinstance(pattern, str) else pattern
    bound = bound or {}
    if distinct and not bound and _closed(terms):
        return _cycle_matches(graph, terms)
    edges_of = reduced(graph, terms, bound) if bound else {}
    matches: DataFrame | None = None
    known: list[str] = []
    for start, edge, end in terms:
        edges = edges_of.get(edge, graph.edges).select(F.struct("*").alias(edge))
        ends = {start: F.col(f"{edge}.src"), end: F.col(f"{edge}.dst")}
        if matches is None:
            matches = edges
        else:
            shared = [F.col(f"{name}.id") == ends[name] for name in ends if name in known]
            if not shared:
                raise ValueError(f"term of edge {edge} shares no vertex with the terms before it")
            new = [ends[name] for name in ends if name not in known]
            apart = [F.col(f"{other}.id") != column for column in new for other in known] if distinct else []
            matches = matches.join(edges, reduce(and_, shared + apart))
        if start == end:
            # One name is one vertex: a loop, also where names stand for different vertices.
            matches = matches.where(F.col(f"{edge}.src") == F.col(f"{edge}.dst"))
        elif distinct:
            matches = matches.where(F.col(f"{edge}.src") != F.col(f"{edge}.dst"))
        for name, column in ends.items():
            if name not in known:
                vertex = bound.get(name, graph.vertices).select(F.struct("*").alias(name))
                matches = matches.join(vertex, F.col(f"{name}.id") == column)
                known.append(name)
    return matches
