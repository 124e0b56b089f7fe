"""Directed triangles and four-cycles, found from the end of lower degree.

Vertices are ranked by degree. Every pattern is looked for from one vertex of known rank, so the
middle of a wedge is never a vertex with more neighbours than the end it is paired with: the
wedges formed number no more than the sum, over all edges, of the lower degree. A vertex has no
more higher-ranked neighbours than the square root of twice the edges, which bounds every list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlake.graph.graph import Graph
from airlake.scratch import WorkingArea, keep, shuffle_width, working_area

#: Neighbours in a list of them, rows that a task makes unique, and wedges (by their bound) that a task counts.
LIST_ROWS, PAIRS_PER_TASK, WEDGES_PER_TASK = 4096, 1_000_000, 4_000_000
MOST_TASKS = 50_000


def neighbours(graph: Graph) -> DataFrame:
    """(v, w, out, back, above): each vertex's neighbours, the edges' directions, whether w ranks higher.

    Loops are left out, parallel edges are one. Written once.
    """
    ways = F.explode(F.array(
        F.struct(F.col("src").alias("v"), F.col("dst").alias("w"), F.lit(True).alias("out"), F.lit(False).alias("back")),
        F.struct(F.col("dst").alias("v"), F.col("src").alias("w"), F.lit(False).alias("out"), F.lit(True).alias("back")),
    ))
    each = graph.edges.where("src <> dst").select(ways.alias("way")).select("way.*")
    around = keep(each.groupBy("v", "w").agg(F.max("out").alias("out"), F.max("back").alias("back")), "around")
    degrees = around.groupBy("v").agg(F.count(F.lit(1)).alias("degree"))
    ranked = around.join(degrees, "v").join(degrees.select(F.col("v").alias("w"), F.col("degree").alias("w_degree")), "w")
    rank, w_rank = F.struct("degree", "v"), F.struct("w_degree", "w")
    return keep(
        ranked.select("v", "w", "out", "back", (w_rank > rank).alias("above"), rank.alias("v_rank"), w_rank.alias("w_rank")),
        "neighbours",
    )


def triangles(graph: Graph) -> DataFrame:
    """(a, b, c) with edges a to b, b to c and c to a, every rotation a row.

    The two lower vertices' lists of higher neighbours are intersected: no wedge is formed.
    """
    above = neighbours(graph).where("above").select("v", "w", "out", "back")
    lists = keep(
        above.groupBy("v").agg(
            F.collect_list(F.when(F.col("out"), F.col("w"))).alias("outs"), F.collect_list(F.when(F.col("back"), F.col("w"))).alias("backs")
        ),
        "lists",
    )
    lowest = lists.select("v", F.col("outs").alias("v_outs"), F.col("backs").alias("v_backs"))
    middle = lists.select(F.col("v").alias("w"), "outs", "backs")
    both = above.join(lowest, "v").join(middle, "w")
    # v to w to x to v, or v to x to w to v, where x ranks above both.
    forth = F.when(F.col("out"), F.array_intersect("outs", "v_backs"))
    back = F.when(F.col("back"), F.array_intersect("backs", "v_outs"))
    found = both.select("v", "w", F.explode_outer(forth).alias("x")).where("x IS NOT NULL").select("v", "w", "x")
    found = found.union(
        both.select("v", F.explode_outer(back).alias("x"), "w").where("x IS NOT NULL").select("v", "x", "w")
    ).toDF("v", "w", "x")
    return _rotations(found, ["v", "w", "x"], "abc")


def _rotations(cycles: DataFrame, order: list[str], names: str) -> DataFrame:
    turned = [order[i:] + order[:i] for i in range(len(order))]
    each = F.explode(F.array(*(F.struct(*(F.col(c).alias(n) for c, n in zip(turn, names))) for turn in turned)))
    return cycles.select(each.alias("match")).select("match.*")


def _wedges(graph: Graph) -> DataFrame:
    """(top, v, low, forth, back): two edges over ``v``, whose neighbour ``top`` outranks both others."""
    around = neighbours(graph)
    tops = around.where("above").select(
        "v", F.col("w").alias("top"), F.col("out").alias("to_top"), F.col("back").alias("from_top"), F.col("w_rank").alias("top_rank")
    )
    lows = around.select("v", F.col("w").alias("low"), F.col("out").alias("to_low"), F.col("back").alias("from_low"), F.col("w_rank").alias("low_rank"))
    forth, back = F.col("from_top") & F.col("to_low"), F.col("from_low") & F.col("to_top")
    wedges = tops.join(lows, "v").where(F.col("low_rank") < F.col("top_rank"))
    return wedges.select("top", "v", "low", forth.alias("forth"), back.alias("back")).where("forth OR back")


def _numbered_links(graph: Graph, area: WorkingArea) -> tuple[DataFrame, str]:
    """(v, w, code, v_degree, w_degree), hashed by v, and the type of a number times four.

    Vertices are numbers without large gaps, so that lists of them are short. Each link is there from both ends; the
    bits of ``code`` are 1 for v to w and 2 for w to v. Loops are left out, parallel edges are one.
    """
    spark = area.spark
    tasks = max(shuffle_width(spark), min(graph.edges.count() // PAIRS_PER_TASK + 1, MOST_TASKS))
    ends = graph.edges.where("src <> dst").select(
        F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"), F.when(F.col("src") < F.col("dst"), 1).otherwise(2).alias("way")
    )
    pairs = area.keep(ends.repartition(tasks, "a", "b").groupBy("a", "b").agg(F.bit_or("way").alias("code")), "pairs")
    each = pairs.select("a").union(pairs.select("b")).toDF("id")
    degrees = area.keep(
        each.groupBy("id").agg(F.count(F.lit(1)).cast("int").alias("degree")).withColumn("_row", F.monotonically_increasing_id()), "degrees"
    )
    # A task's rows count up from its number times 2^33; the tasks' rows are interleaved.
    task, row = F.shiftrightunsigned("_row", 33), F.col("_row").bitwiseAND((1 << 33) - 1)
    several = (degrees.agg(F.max(task)).first()[0] or 0) + 1
    number = row * several + task
    most = degrees.agg(F.max(number)).first()[0] or 0
    kind = "int" if 4 * most + 3 < 1 << 31 else "bigint"
    numbers = degrees.select("id", number.cast(kind).alias("number"), "degree")

    def end(name: str) -> DataFrame:
        return numbers.select(F.col("id").alias(name), F.col("number").alias(f"{name}_number"), F.col("degree").alias(f"{name}_degree"))

    def seen(v: str, w: str, code) -> F.Column:
        return F.struct(
            F.col(f"{v}_number").alias("v"), F.col(f"{w}_number").alias("w"), code.alias("code"),
            F.col(f"{v}_degree").alias("v_degree"), F.col(f"{w}_degree").alias("w_degree"),
        )

    turned = F.element_at(F.array(F.lit(2), F.lit(1), F.lit(3)), F.col("code"))
    both = pairs.join(end("a"), "a").join(end("b"), "b")
    links = both.select(F.inline(F.array(seen("a", "b", F.col("code")), seen("b", "a", turned))))
    return area.bucketed(links, ["v"], "links"), kind


def _wedge_lists(links: DataFrame, kind: str, wedges_per_task: int, area: WorkingArea) -> tuple[DataFrame, list[str], int]:
    """(top, part, lows), the columns they are dealt by, and to how many tasks; without busy tops there are no parts.

    A row of ``lows`` lists the far ends of a vertex's wedges that begin at ``top``, in pieces, each as four times its number
    and 1 for a wedge that leads from ``top``, 2 for one that leads to it. The lists of a ``top`` are one part but where
    they have more than ``wedges_per_task`` wedges: those are dealt one by one, by the far end.
    """
    rank, own = F.struct(F.col("w_degree").alias("degree"), F.col("w").alias("number"), "code"), F.struct("v_degree", "v")
    pieces = F.ceil(F.col("v_degree") / F.lit(LIST_ROWS))
    lists = links.groupBy("v", F.pmod(F.xxhash64("w"), pieces).alias("piece")).agg(F.collect_list(rank).alias("around"))
    tops = links.where(F.struct("w_degree", "w") > own).select(
        "v", F.col("w").alias("top"), rank.alias("at"), F.col("v_degree").alias("wedges"),
        # From top to low: top leads to v and v to low; the other way: low leads to v and v to top.
        F.element_at(F.array(F.lit(2), F.lit(1), F.lit(3)), F.col("code")).alias("used"),
    )
    bound = tops.groupBy("top").agg(F.sum("wedges").alias("wedges"))
    bound = area.keep(bound, "bound")
    busy = area.keep(bound.where(F.col("wedges") > wedges_per_task).select(
        "top", F.ceil(F.col("wedges") / F.lit(wedges_per_task)).alias("parts")
    ), "busy")
    total = bound.agg(F.sum("wedges")).first()[0] or 0
    tasks = max(shuffle_width(area.spark), min(total // wedges_per_task + 1, MOST_TASKS))

    def listed(wanted: DataFrame) -> DataFrame:
        below = F.filter("around", lambda x: (x < F.col("at")) & (x["code"].bitwiseAND(F.col("used")) != 0))
        coded = F.transform(below, lambda x: (x["number"] * 4 + x["code"].bitwiseAND(F.col("used"))).cast(kind))
        return wanted.join(lists, "v").withColumn("lows", coded).where(F.size("lows") > 0)

    if busy.isEmpty():
        return listed(tops).select("top", "lows"), ["top"], int(tasks)
    whole = listed(tops.join(busy, "top", "left_anti")).select("top", F.lit(0).cast("long").alias("part"), "lows")
    dealt = listed(tops.join(busy, "top")).select("top", "parts", F.explode("lows").alias("low"))
    dealt = dealt.select("top", F.pmod(F.xxhash64(F.shiftright("low", 2)), "parts").alias("part"), F.array("low").alias("lows"))
    return whole.union(dealt), ["top", "part"], int(tasks)


def count_four_cycles(graph: Graph, wedges_per_task: int = WEDGES_PER_TASK) -> DataFrame:
    """(matches): how many (a, b, c, d), all different, have edges a to b, b to c, c to d and d to a.

    Counted per pair of opposite vertices, each cycle at its highest ranked one; none is formed. Wedges are moved once, as
    lists of numbers by that vertex, to as many tasks as their number asks for, which hold the counts of their pairs.
    """
    with working_area(graph.edges.sparkSession) as area:
        lists, dealt_by, tasks = _wedge_lists(*_numbered_links(graph, area), wedges_per_task, area)
        wedges = lists.repartition(tasks, *dealt_by).select(*dealt_by, F.explode("lows").alias("low"))
        forth, back = F.col("low").bitwiseAND(1) > 0, F.col("low").bitwiseAND(2) > 0
        pairs = wedges.groupBy(*dealt_by, F.shiftright("low", 2).alias("low")).agg(
            F.count_if(forth).alias("forth"), F.count_if(back).alias("back"), F.count_if(forth & back).alias("both")
        )
        cycles = F.sum(F.col("forth") * F.col("back") - F.col("both"))
        return keep(pairs.agg((4 * F.coalesce(cycles, F.lit(0))).cast("long").alias("matches")), "matches")


def four_cycles(graph: Graph) -> DataFrame:
    """(a, b, c, d) of the matches that ``count_four_cycles`` counts."""
    wedges = keep(_wedges(graph), "wedges")
    forth = wedges.where("forth").select("top", "low", "v")
    back = wedges.where("back").select("top", "low", F.col("v").alias("x"))
    return _rotations(forth.join(back, ["top", "low"]).where("v <> x"), ["top", "v", "low", "x"], "abcd")
