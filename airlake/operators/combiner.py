"""What map-side combining saves, read from Spark's own counters of a finished plan."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame


class Combined(NamedTuple):
    """Rows an aggregate's tasks took in and what they handed to its shuffle."""

    rows_in: int
    rows_shuffled: int


def _below(node) -> list:
    """The nodes a plan's node reads, through stages and adaptive plans."""
    kind = node.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return [node.executedPlan()]
    if kind.endswith("QueryStageExec"):
        return [node.plan()]
    if kind == "ReusedExchangeExec":
        return [node.child()]
    children = node.children()
    return [children.apply(i) for i in range(children.size())]


def _rows_out(node) -> int | None:
    found = node.metrics().get("numOutputRows")
    return found.get().value() if found.isDefined() else None


def _rows_into(node) -> int:
    """Rows a node takes in: those its nearest counting descendants gave."""
    total = 0
    for child in _below(node):
        rows = _rows_out(child)
        total += _rows_into(child) if rows is None else rows
    return total


def _partial_aggregates(node) -> list:
    found = []
    if node.getClass().getSimpleName().endswith("AggregateExec"):
        expressions = node.aggregateExpressions()
        modes = {expressions.apply(i).mode().toString() for i in range(expressions.size())}
        if modes == {"Partial"}:
            found.append(node)
    return found + [below for child in _below(node) for below in _partial_aggregates(child)]


def combined(df: DataFrame) -> list[Combined]:
    """Each map-side aggregate of a query, the last one first.

    The query is run and its rows are only counted, where they are. The counters
    are those of its finished plan, also where it was changed on the way; an aggregate that
    Spark left out, as its input turned out empty, is not among them.
    """
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    return [Combined(_rows_into(node), _rows_out(node)) for node in _partial_aggregates(execution.executedPlan())]
