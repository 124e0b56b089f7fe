"""Label propagation and reports on groups of vertices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlake.graph.graph import Graph
from airlake.graph.pagerank import LINKS_PER_PIECE, piece_of, pieces_of
from airlake.operators.aggregates import listed, ranked_list, share
from airlake.operators.windows import top_n_per_group
from airlake.scratch import WorkingArea, cut_lineage, keep, shuffle_width, working_area


def label_propagation(
    graph: Graph, max_iter: int = 5, checkpoint_interval: int = 1, links_per_piece: int = LINKS_PER_PIECE
) -> DataFrame:
    """Vertices with ``label``: each round a vertex takes its neighbours' most common label.

    Every edge carries labels both ways. Ties go to the smallest label, so results
    are repeatable; a vertex without neighbours keeps its own.

    Links are lists that stay where they are, hashed by speaker; as every edge carries labels both ways, a vertex's list
    is also what it hears in the first round, when all say their own ids. In later rounds every speaker's label goes to
    its hearers, in one shuffle by hearer, where votes are counted and the winner found. Where vertices have very many
    neighbours, lists are cut into pieces and votes are counted by vertex and label first, so that many tasks speak
    and count for such a vertex. Rounds end when nothing has changed. An end that is no vertex says its own id.
    """
    ends = graph.edges.select(F.col("src").alias("speaker"), F.col("dst").alias("hearer"))
    ends = ends.union(graph.edges.select("dst", "src")).where("speaker IS NOT NULL AND hearer IS NOT NULL")
    winner = F.min(F.struct((-F.col("n")).alias("n"), "label"))["label"].alias("new")
    with working_area(graph.edges.sparkSession) as area:
        lists, several = _heard(ends, links_per_piece, area)
        labels = graph.vertices.select("id", F.col("id").alias("label"))
        first = F.array_min(F.transform("hearers", lambda x: F.struct((-x["weight"]).alias("n"), x["hearer"].alias("label"))))
        winners = lists.select(F.col("speaker").alias("id"), first.alias("best")).groupBy("id").agg(F.min("best")["label"].alias("new"))
        for round_ in range(1, max_iter + 1):
            found = labels.join(winners, "id", "left")
            moved = found.select("id", F.col("label").alias("old"), F.coalesce("new", "label").alias("label"))
            labels = cut_lineage(moved) if round_ % checkpoint_interval == 0 or round_ == max_iter else moved
            changed = labels.where("old <> label")
            labels = labels.drop("old")
            if round_ == max_iter:
                break
            if changed.isEmpty():
                labels = labels if round_ % checkpoint_interval == 0 else cut_lineage(labels)
                break
            said = lists.join(labels.withColumnRenamed("id", "speaker"), "speaker", "left")
            said = said.select(F.coalesce("label", "speaker").alias("label"), F.inline("hearers"))
            votes = said.select(F.col("hearer").alias("id"), "label", "weight")
            votes = votes if several else votes.repartition(shuffle_width(area.spark), "id")
            winners = votes.groupBy("id", "label").agg(F.sum("weight").alias("n")).groupBy("id").agg(winner)
        if max_iter == 0:
            labels = cut_lineage(labels)
    return graph.vertices.join(labels, "id")


def _heard(ends: DataFrame, links_per_piece: int, area: WorkingArea) -> tuple[DataFrame, bool]:
    """(speaker, hearers) lists of (hearer, weight), and whether any speaker has several; ends are moved once, by speaker."""
    hot = ends.groupBy("speaker").agg(F.count(F.lit(1)).alias("_links"))
    hot = area.keep(hot.select("speaker", pieces_of("_links", links_per_piece).alias("pieces")).where("pieces > 1"), "hot")
    several = not hot.isEmpty()
    keys = ["speaker", "piece"] if several else ["speaker"]
    if several:
        piece = F.when(F.col("pieces") > 1, piece_of("hearer", "pieces")).otherwise(1)
        ends = ends.join(F.broadcast(hot), "speaker", "left").select("speaker", piece.alias("piece"), "hearer")
    links = ends.repartition(shuffle_width(area.spark), *keys).groupBy(*keys, "hearer").agg(F.count(F.lit(1)).alias("weight"))
    lists = links.groupBy(*keys).agg(F.collect_list(F.struct("hearer", "weight")).alias("hearers"))
    return area.bucketed(lists, keys, "lists", placed=True).select("speaker", "hearers"), several


def group_sizes(members: DataFrame, group: str, at_least: int = 1) -> DataFrame:
    """Members per group, small groups left out."""
    return members.groupBy(group).agg(F.count(F.lit(1)).alias("size")).where(F.col("size") >= at_least)


def largest_group(sizes: DataFrame, group: str):
    """The id of the largest group, the smallest id on ties; None without groups."""
    top = sizes.orderBy(F.desc("size"), group).first()
    return None if top is None else top[group]


def isolated_components(components: DataFrame, at_least: int = 2) -> DataFrame:
    """Components outside the largest one with what they consist of, an entry a row.

    Columns: component, size, ``list`` ('members' or 'countries'), position, item.
    """
    sizes = keep(group_sizes(components, "component", at_least), "sizes")
    others = sizes.where(F.col("component") != F.lit(largest_group(sizes, "component")))
    inside = keep(components.select("id", "code", "city", "country", "component").join(others, "component"), "isolated")
    named = inside.select("component", "id", F.format_string("%s (%s)", "code", "city").alias("name"))
    members = listed(named, ["component"], "name", ["id"]).withColumn("list", F.lit("members"))
    countries = listed(inside.select("component", "country").distinct(), ["component"], "country")
    entries = members.unionByName(countries.withColumn("list", F.lit("countries")))
    return entries.join(others, "component").select("component", "size", "list", "position", "item")


def community_summary(communities: DataFrame, degrees: DataFrame, at_least: int = 5, hubs: int = 5) -> DataFrame:
    """Per label: members, countries, the country of most members with its share, the busiest members.

    ``hubs`` is NULL where no member has both in- and out-edges.
    """
    per_country = communities.groupBy("label", "country").agg(F.count(F.lit(1)).alias("here"))
    # The sums and the leading country come from the same few rows, in one aggregate.
    summary = per_country.groupBy("label").agg(
        F.sum("here").alias("members"), F.count("country").alias("countries"),
        F.min(F.struct((-F.col("here")).alias("fewer"), "country")).alias("lead"),
    )
    busiest = top_n_per_group(
        communities.select("id", "label", "code").join(degrees, "id"),
        ["label"], [F.desc("outDegree"), F.asc("id")], hubs,
    )
    return (
        summary.where(F.col("members") >= at_least)
        .join(ranked_list(busiest, ["label"], "rank", "code", "hubs"), "label", "left")
        .select(
            "label", "members", "countries", F.col("lead.country").alias("lead_country"),
            share(-F.col("lead.fewer"), F.col("members"), 2).alias("lead_share"), "hubs",
        )
    )
