"""Routes that visit no vertex twice."""

from __future__ import annotations

from functools import reduce
from itertools import combinations
from math import inf
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airlake.graph.graph import Graph
from airlake.scratch import WorkingArea, keep, shuffle_width, working_area

#: Half walks that a task counts; vertices where more meet are dealt to several.
HALVES_PER_TASK = 500_000
MOST_TASKS = 50_000

ARROW = " → "


def condition(template: str, alias: str) -> Column:
    """SQL condition with ``{v}`` standing for the alias of a vertex."""
    return F.expr(template.format(v=alias))


def select_vertices(vertices: DataFrame, template: str) -> DataFrame:
    return vertices.alias("v").where(condition(template, "v"))


class Halves(NamedTuple):
    """Half walks by number of edges, from the starts onwards and from the targets back.

    Columns: ``_mid`` (where both meet), ``_visited`` and ``_codes`` (ids and codes in order; those of a
    second half without the meeting vertex), ``_km``. Halves that are only counted lack the last two.
    """

    onward: list[DataFrame]
    back: list[DataFrame]

    def meeting(self, edges: int) -> tuple[DataFrame, DataFrame]:
        return self.onward[(edges + 1) // 2], self.back[edges // 2]


def half_walks(graph: Graph, start: str, end: str, longest: int, keep_half, counted: bool = False) -> Halves:
    """Simple walks of up to half of ``longest`` edges from either side.

    A step joins on a vertex and loses repeated ones there. The last step onwards goes only where a walk from
    the targets has been, the steps before it only where enough edges are left to reach a target.
    ``counted`` leaves out codes and distances.
    """
    hops = graph.coded_edges
    columns = ["_mid", "_visited"] if counted else ["_mid", "_visited", "_codes", "_km"]
    targets = select_vertices(graph.vertices, end).select("id", "code")
    no_code = F.array().cast("array<string>")
    back = [targets.select(F.col("id").alias("_mid"), F.array_remove(F.array("id"), F.col("id")).alias("_visited"), no_code.alias("_codes"), F.lit(0.0).alias("_km")).select(columns)]
    for _ in range(longest // 2):
        new = (F.col("src") != F.col("_mid")) & ~F.array_contains("_visited", F.col("src"))
        grown = hops.join(back[-1], (F.col("dst") == F.col("_mid")) & new)
        values = [F.col("src"), F.array_prepend("_visited", F.col("dst"))]
        values += [] if counted else [F.array_prepend("_codes", F.col("code")), F.col("distance_km") + F.col("_km")]
        back.append(keep_half(grown.select(*(value.alias(c) for value, c in zip(values, columns)))))
    onward = [select_vertices(graph.vertices, start).select(
        F.col("id").alias("_mid"), F.array("id").alias("_visited"), F.array("code").alias("_codes"), F.lit(0.0).alias("_km")
    ).select(columns)]
    steps = (longest + 1) // 2
    reached = reduce(DataFrame.union, [half.select("_mid") for half in back]).distinct()
    useful = [keep_half(reached.select(F.col("_mid").alias("_id")))]
    for _ in range(steps - 1 if steps > 2 else 0):
        before = hops.join(useful[-1], F.col("dst") == F.col("_id"), "left_semi").select(F.col("src").alias("_id"))
        useful.append(keep_half(useful[-1].union(before).distinct()))
    for step in range(1, steps + 1):
        left = steps - step
        on = hops.join(useful[left], F.col("dst") == F.col("_id"), "left_semi") if left < len(useful) else hops
        new = ~F.array_contains("_visited", F.col("dst"))
        grown = onward[-1].join(on, (F.col("_mid") == F.col("src")) & new)
        values = [F.col("dst"), F.array_append("_visited", F.col("dst"))]
        values += [] if counted else [F.array_append("_codes", F.col("code")), F.col("_km") + F.col("distance_km")]
        onward.append(keep_half(grown.select(*(value.alias(c) for value, c in zip(values, columns)))))
    return Halves(onward, back)


def met(first: DataFrame, second: DataFrame) -> DataFrame:
    """Both halves of every path: they meet in a vertex and share no other. Columns: codes, distance_km."""
    second = second.select("_mid", *(F.col(c).alias(f"{c}_on") for c in ("_visited", "_codes", "_km")))
    apart = ~F.arrays_overlap("_visited", "_visited_on")
    return first.join(second, "_mid").where(apart).select(
        F.concat("_codes", "_codes_on").alias("codes"), (F.col("_km") + F.col("_km_on")).alias("distance_km")
    )


def _all_met(graph: Graph, start: str, end: str, longest: int, shortest: int, area: WorkingArea) -> DataFrame:
    """Paths of every length: segments, codes, distance_km."""
    halves = half_walks(graph, start, end, longest, lambda df: area.keep(df, "half"))
    lengths = range(shortest, longest + 1)
    return reduce(DataFrame.unionByName, (met(*halves.meeting(n)).withColumn("segments", F.lit(n)) for n in lengths))


def paths_between(graph: Graph, start: str, end: str, longest: int, shortest: int = 1) -> DataFrame:
    """Paths of ``shortest`` to ``longest`` edges between vertices meeting two conditions.

    ``start`` and ``end`` are conditions such as ``{v}.country = 'X'``. Vertices need
    ``code``, edges ``distance_km``. Columns: segments, route, distance_km.

    Half walks from either side are joined where they meet. What is returned has been written once, so it can
    be read many times. Where paths are only counted or the outermost of them wanted, ``count_paths``,
    ``count_stops`` and ``outermost_paths`` write none of the others.
    """
    with working_area(graph.edges.sparkSession) as area:
        found = _all_met(graph, start, end, longest, shortest, area)
        return keep(found.select("segments", F.concat_ws(ARROW, "codes").alias("route"), "distance_km"), "paths")


def count_paths(graph: Graph, longest: int, start: str, end: str, shortest: int = 1) -> DataFrame:
    """(segments, paths) for every length that has any; no path is formed, and no two halves are joined."""
    with working_area(graph.edges.sparkSession) as area:
        halves = half_walks(graph, start, end, longest, lambda df: area.keep(df, "half"), counted=True)
        return keep(_count_apart(halves, range(shortest, longest + 1), area), "counts")


def _count_apart(halves: Halves, lengths: range, area: WorkingArea, halves_per_task: int = HALVES_PER_TASK) -> DataFrame:
    """(segments, paths): pairs of halves that meet in a vertex and share no other, without forming any.

    By inclusion and exclusion: with f(s) halves of one side that visit all of a set s of vertices, and g(s) of the other, the
    sum of f(s) g(s) over all sets, less where s is odd, counts each pair that shares nothing once and others not at all.
    So a half is a row for each set of its vertices, and what is held is in proportion to the halves, not to their pairs.
    Steps whose vertices no half of the other side visits are in no set.
    """
    meetings = {n: ((n + 1) // 2, n // 2) for n in lengths}
    shared = _shared_steps(halves, max(i for i, _ in meetings.values()), max(j for _, j in meetings.values()))

    # Onwards a half begins with its start and ends where halves meet; back it ends with its target.
    ids = {("onward", i): [F.col("_visited")[k] for k in range(i) if shared["onward", k]] for i, _ in meetings.values()}
    ids |= {("back", j): [F.col("_visited")[j - 1 - k] for k in range(j) if shared["back", k]] for _, j in meetings.values()}
    most = dict.fromkeys(ids, 0)
    for i, j in meetings.values():
        for side in (("onward", i), ("back", j)):
            most[side] = max(most[side], min(len(ids["onward", i]), len(ids["back", j])))
    names = {side: f"_{side[0]}_{side[1]}" for side in ids}
    ids_type = halves.onward[0].schema["_visited"].dataType

    def rows(side: tuple[str, int]) -> DataFrame:
        half = (halves.onward if side[0] == "onward" else halves.back)[side[1]]
        visited = F.array_sort(F.array(*ids[side])) if most[side] else F.array()
        return half.select("_mid", F.lit(names[side]).alias("_side"), visited.cast(ids_type).alias("_ids"))

    def sets(side: tuple[str, int]) -> Column:
        chosen = [c for k in range(1, most[side] + 1) for c in combinations(range(len(ids[side])), k)]
        return F.array(*(F.array(*(F.col("_ids")[x] for x in c)) for c in chosen))

    def unfolded(found: DataFrame) -> DataFrame:
        each = reduce(lambda rest, side: F.when(F.col("_side") == names[side], sets(side)).otherwise(rest), several, F.lit(None))
        return found.select("_mid", "_side", F.explode(each).alias("_set"))

    def summed(found: DataFrame, sign: Column) -> DataFrame:
        return found.agg(*(F.sum(sign * F.col(names["onward", i]) * F.col(names["back", j])).alias(str(n)) for n, (i, j) in meetings.items()))

    counts = [F.count_if(F.col("_side") == name).alias(name) for name in names.values()]
    at = area.keep(reduce(DataFrame.unionByName, map(rows, ids)).groupBy("_mid").agg(*counts), "meeting")
    parts = [summed(at, F.lit(1))]
    several = [side for side in ids if most[side]]
    if several:
        every = reduce(DataFrame.unionByName, map(rows, several))
        met_by = reduce(Column.__add__, (F.col(names[side]) for side in several))
        tasks = max(shuffle_width(area.spark), min((at.agg(F.sum(met_by)).first()[0] or 0) // halves_per_task + 1, MOST_TASKS))
        busy = area.keep(at.where(met_by > halves_per_task).select("_mid"), "busy")
        if busy.isEmpty():
            found = unfolded(every.repartition(tasks, "_mid")).groupBy("_mid", "_set").agg(*counts)
        else:
            quiet = unfolded(every.join(busy, "_mid", "left_anti").repartition(tasks, "_mid")).groupBy("_mid", "_set").agg(*counts)
            dealt = unfolded(every.join(busy, "_mid", "left_semi")).repartition(tasks, "_mid", "_set")
            found = quiet.union(dealt.groupBy("_mid", "_set").agg(*counts))
        parts.append(summed(found, F.when(F.size("_set") % 2 == 1, -1).otherwise(1)))
    listed = F.inline(F.array(*(F.struct(F.lit(n).alias("segments"), F.col(str(n)).alias("paths")) for n in meetings)))
    each = reduce(DataFrame.unionByName, parts).select(listed)
    return each.groupBy("segments").agg(F.sum("paths").alias("paths")).where("paths > 0")


def _shared_steps(halves: Halves, onward: int, back: int) -> dict[tuple[str, int], bool]:
    """By side and step from its end, whether halves of the other side may visit any vertex that this step does."""
    steps = {("onward", k): half for k, half in enumerate(halves.onward[:onward])}
    steps |= {("back", k): half for k, half in enumerate(halves.back[:back])}
    tagged = reduce(DataFrame.unionByName, (half.select("_mid", F.lit(f"{s}_{k}").alias("_step")) for (s, k), half in steps.items()))
    seen = tagged.groupBy("_mid").agg(*(F.bool_or(F.col("_step") == f"{s}_{k}").alias(f"{s}_{k}") for s, k in steps))

    def any_of(side: str) -> Column:
        return reduce(Column.__or__, (F.col(f"{s}_{k}") for s, k in steps if s == side), F.lit(False))

    other = {"onward": any_of("back"), "back": any_of("onward")}
    found = seen.agg(*(F.bool_or(F.col(f"{s}_{k}") & other[s]).alias(f"{s}_{k}") for s, k in steps)).first()
    return {(s, k): bool(found[f"{s}_{k}"]) for s, k in steps}


def count_stops(graph: Graph, longest: int, start: str, end: str, shortest: int = 1) -> DataFrame:
    """(stop, paths): on how many paths a vertex lies between start and end; no route is written or read."""
    with working_area(graph.edges.sparkSession) as area:
        found = _all_met(graph, start, end, longest, shortest, area)
        between = F.slice("codes", F.lit(2), F.size("codes") - 2)
        stops = found.select(F.explode(between).alias("stop")).groupBy("stop").agg(F.count(F.lit(1)).alias("paths"))
        return keep(stops, "stops")


def outermost_paths(graph: Graph, longest: int, start: str, end: str, n: int, slack: float = 0.001) -> DataFrame:
    """Paths among which are the ``n`` shortest and the ``n`` longest, and all that differ from them by up to ``slack``.

    Each vertex where halves meet has the least and the most distance that is left to a target, by edges left. The best
    halves of every meeting vertex, joined, give ``n`` paths of each kind to beat. Halves that with the least (most)
    distance left cannot are dropped before the rest is joined.
    """
    with working_area(graph.edges.sparkSession) as area:
        halves = half_walks(graph, start, end, longest, lambda df: area.keep(df, "half"))
        lengths = range(1, longest + 1)
        low, high = _to_beat(halves, lengths, n)
        found = []
        for edges in lengths:
            first, second = halves.meeting(edges)
            kept = met(promising(first, second, low, high, slack), promising(second, first, low, high, slack))
            inside = (F.col("distance_km") <= low + slack) | (F.col("distance_km") >= high - slack)
            found.append(kept.where(inside).select(F.lit(edges).alias("segments"), F.concat_ws(ARROW, "codes").alias("route"), "distance_km"))
        return keep(reduce(DataFrame.unionByName, found), "paths")


def _to_beat(halves: Halves, lengths: range, n: int) -> tuple[float, float]:
    """The ``n``-th shortest and longest distance of some paths; without bound where there are fewer."""
    tried = []
    for edges in lengths:
        first, second = halves.meeting(edges)
        for best in (F.min_by, F.max_by):
            ends = [half.groupBy("_mid").agg(best(F.struct("_visited", "_codes", "_km"), "_km").alias("best")).select("_mid", "best.*") for half in (first, second)]
            tried.append(met(*ends).select(F.lit(edges).alias("segments"), F.concat_ws(ARROW, "codes").alias("route"), "distance_km"))
    # A vertex's shortest halves may be its longest ones too: the same path counts once.
    some = keep(reduce(DataFrame.unionByName, tried).dropDuplicates(["segments", "route"]), "tried")
    lows = some.orderBy("distance_km").limit(n).agg(F.count(F.lit(1)), F.max("distance_km")).first()
    highs = some.orderBy(F.desc("distance_km")).limit(n).agg(F.count(F.lit(1)), F.min("distance_km")).first()
    return (lows[1] if lows[0] == n else inf), (highs[1] if highs[0] == n else -inf)


def promising(half: DataFrame, other: DataFrame, low: float, high: float, slack: float = 0.0) -> DataFrame:
    """Half walks that the other half's least or most distance may bring to ``low`` or below, or to ``high`` or above."""
    left = other.groupBy("_mid").agg(F.min("_km").alias("_least"), F.max("_km").alias("_most"))
    may = (F.col("_km") + F.col("_least") <= low + slack) | (F.col("_km") + F.col("_most") >= high - slack)
    return half.join(left, "_mid").where(may).select(half.columns)


def simple_paths(graph: Graph, segments: int, start: str, end: str) -> DataFrame:
    """Paths of exactly ``segments`` edges."""
    return paths_between(graph, start, end, segments, segments)


def paths_up_to(graph: Graph, longest: int, start: str, end: str) -> DataFrame:
    """Paths of 1, 2, …, ``longest`` segments."""
    return paths_between(graph, start, end, longest)


def path_counts(paths: DataFrame) -> DataFrame:
    return paths.groupBy("segments").agg(F.count(F.lit(1)).alias("paths"))


def stop_counts(paths: DataFrame) -> DataFrame:
    """(stop, paths): on how many paths a vertex lies between start and end."""
    codes = F.split("route", ARROW)
    between = F.slice(codes, F.lit(2), F.size(codes) - 2)
    return paths.select(F.explode(between).alias("stop")).groupBy("stop").agg(F.count(F.lit(1)).alias("paths"))


def extreme_paths(paths: DataFrame, n: int) -> DataFrame:
    """The ``n`` shortest and the ``n`` longest paths, told apart by ``kind``."""
    ends = {"shortest": F.asc("distance_km"), "longest": F.desc("distance_km")}
    return reduce(
        DataFrame.unionByName,
        (paths.orderBy(order, "route").limit(n).withColumn("kind", F.lit(kind)) for kind, order in ends.items()),
    )
