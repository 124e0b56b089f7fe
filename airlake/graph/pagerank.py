"""PageRank in a number of rounds, or until the ranks settle."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlake.graph.graph import Graph
from airlake.rounds import RoundLog
from airlake.scratch import WorkingArea, cut_lineage, shuffle_width, working_area

CHECKPOINT_INTERVAL = 5
#: Links of one source that lie together; a source with more has as many pieces as it needs.
LINKS_PER_PIECE = 100_000


def pieces_of(degree: str, links_per_piece: int):
    return F.ceil(F.col(degree) / links_per_piece).cast("int")


def piece_of(other_end: str, pieces: str):
    """The piece, from 1, that a link to that vertex lies in."""
    return F.pmod(F.xxhash64(other_end), F.col(pieces)).cast("int") + 1


def to_pieces(df: DataFrame) -> DataFrame:
    """A row for each of a vertex's ``pieces``, none where it has none."""
    numbers = F.when(F.col("pieces") > 0, F.sequence(F.lit(1), F.col("pieces")))
    return df.withColumn("piece", F.explode(numbers))


def _links(graph: Graph, links_per_piece: int, area: WorkingArea) -> tuple[DataFrame, bool]:
    """(src, piece, to, fan_out, pieces), and whether any source has several pieces.

    A row is a source's piece with the vertices it leads to, behind the source itself in the first piece (null in
    others); what has no links, vertex or only an edge's end, has only itself. Edges are moved once, hashed by source and, where sources have
    several pieces, by piece as well, and written where they are.
    """
    hot = graph.out_degrees.select(F.col("id").alias("src"), pieces_of("outDegree", links_per_piece).alias("pieces"))
    hot = area.keep(hot.where("pieces > 1 AND src IS NOT NULL"), "hot")
    several = not hot.isEmpty()
    keys = ["src", "piece"] if several else ["src"]
    edges = graph.edges.select("src", "dst", F.lit(1).alias("links")).where("src IS NOT NULL")
    ends = graph.vertices.select("id").union(graph.edges.select("dst").distinct())
    alone = ends.select(F.col("id").alias("src"), F.lit(None).alias("dst"), F.lit(0).alias("links"))
    if several:
        # Of few sources; parallel edges to one vertex are dealt to pieces like others.
        edges = edges.withColumn("_edge", F.monotonically_increasing_id()).join(F.broadcast(hot), "src", "left")
        piece = F.when(F.col("pieces") > 1, piece_of(F.struct("dst", "_edge"), "pieces")).otherwise(1)
        edges = edges.select("src", piece.alias("piece"), "dst", "links")
        alone = alone.withColumn("piece", F.lit(1))
    each = edges.unionByName(alone).repartition(shuffle_width(area.spark), *keys)
    lists = each.groupBy(*keys).agg(F.collect_list("dst").alias("dsts"), F.sum("links").alias("fan_out"))
    if several:
        total = graph.out_degrees.select(F.col("id").alias("src"), F.col("outDegree").alias("_all"))
        total = F.broadcast(total.join(F.broadcast(hot), "src"))
        lists = lists.join(total, "src", "left").withColumn("fan_out", F.coalesce("_all", "fan_out")).drop("_all")
    else:
        lists = lists.withColumn("piece", F.lit(1)).withColumn("pieces", F.lit(1))
    to = F.array_prepend("dsts", F.when(F.col("piece") == 1, F.col("src")))
    lists = lists.select("src", "piece", to.alias("to"), "fan_out", F.coalesce("pieces", F.lit(1)).alias("pieces"))
    return area.bucketed(lists, keys, "links", placed=True), several


def _ranks(
    graph: Graph, resets: list[float], max_iter: int, checkpoint_interval: int, links_per_piece: int,
    tol: float | None = None, log: RoundLog | None = None, write_rounds: bool = False,
) -> DataFrame:
    """(id, rank_0, rank_1, …): one rank per reset probability, all in the same rounds.

    Links are lists, written once, and stay in place. What walks without resets bring to a vertex after k rounds,
    ``walks``, is the same for every probability r: a walk takes k steps without a reset with probability (1 - r)^k,
    so the rank after n rounds is the sum of r (1 - r)^k walks_k for k < n and of (1 - r)^n walks_n. So a round
    shuffles one number per link, already summed per task and target, however many probabilities there are. Each
    vertex hands itself nothing, so all stay, together with the sums of their rounds so far.

    With ``tol`` rounds end at the first checkpoint where the ranks' changes in one round add up to no
    more than ``tol`` per vertex. With ``log`` checkpoints are recorded there, and rounds recorded before are not
    run again.

    What rounds shuffle, a number per link and round, lies on disk until their states are written. That is at checkpoints,
    for several rounds at once, or with ``write_rounds`` after every round: a small write, a row per vertex.
    """
    sums = [f"sum_{i}" for i in range(len(resets))]
    with working_area(graph.edges.sparkSession) as area:
        links, several = _links(graph, links_per_piece, area)
        extra = ["pieces"] if several else []
        found = log.last(max_iter) if log else None
        done, ranks = found if found else (
            0, links.where("piece = 1").select(F.col("src").alias("id"), F.lit(1.0).alias("walks"), *(F.lit(0.0).alias(c) for c in sums), *extra)
        )
        itself = (F.col("pos") == 0) & (F.col("piece") == 1)
        for round_ in range(done + 1, max_iter + 1):
            weights = [reset * (1.0 - reset) ** (round_ - 1) for reset in resets]
            known = ranks.select(
                F.col("id").alias("src"), "walks", *((F.col(c) + F.lit(w) * F.col("walks")).alias(c) for c, w in zip(sums, weights)), *extra
            )
            lists = links.drop("pieces") if several else links.drop("pieces", "piece").withColumn("piece", F.lit(1))
            at_links = lists.join(to_pieces(known), ["src", "piece"]) if several else lists.join(known, "src")
            share = F.when(F.col("fan_out") > 0, F.col("walks") / F.col("fan_out"))
            at_links = at_links.select("piece", share.alias("share"), "walks", *sums, *extra, F.posexplode("to").alias("pos", "id"))
            before = [F.max(F.when(itself, F.col("walks"))).alias("before")] if tol is not None else []
            ranks = at_links.where("id IS NOT NULL").groupBy("id").agg(
                F.sum(F.when(itself, 0.0).otherwise(F.col("share"))).alias("walks"), *before,
                *(F.max(F.when(itself, F.col(c))).alias(c) for c in [*sums, *extra]),
            )
            if round_ % checkpoint_interval == 0 or round_ == max_iter:
                ranks = log.record(round_, ranks) if log else cut_lineage(ranks)
                done = round_
                if tol is not None and _settled(ranks, [(1.0 - reset) ** round_ for reset in resets], tol):
                    break
            elif write_rounds:
                ranks = area.keep_latest(ranks, "ranks")
        if max_iter == 0:
            ranks = cut_lineage(ranks)

    ranks = ranks.select("id", *(
        (F.col(c) + F.lit((1.0 - reset) ** done) * F.col("walks")).alias(f"rank_{i}") for i, (c, reset) in enumerate(zip(sums, resets))
    ))
    columns = [f"rank_{i}" for i in range(len(resets))]
    count, *totals = ranks.agg(F.count(F.lit(1)), *(F.sum(c) for c in columns)).first()
    return ranks.select(
        "id", *((F.col(c) * F.lit(count / total if total else 0.0)).alias(c) for c, total in zip(columns, totals))
    )


def _settled(ranks: DataFrame, weights: list[float], tol: float) -> bool:
    """Whether the last round changed the ranks of every probability by no more than ``tol`` per vertex."""
    count, change = ranks.agg(F.count(F.lit(1)), F.sum(F.abs(F.col("walks") - F.col("before")))).first()
    return all(weight * (change or 0.0) <= tol * count for weight in weights)


def pagerank(
    graph: Graph,
    reset: float = 0.15,
    max_iter: int = 20,
    checkpoint_interval: int = CHECKPOINT_INTERVAL,
    links_per_piece: int = LINKS_PER_PIECE,
    tol: float | None = None,
    log: RoundLog | None = None,
    write_rounds: bool = False,
) -> DataFrame:
    """Vertices with ``pagerank``; the ranks add up to the number of vertices.

    A vertex hands its rank to its out-edges in equal shares; parallel edges count
    each. With probability ``reset`` a walk starts anew at any vertex. ``tol`` may end
    the rounds before ``max_iter``, ``log`` records them, ``write_rounds`` spares disk: see ``_ranks``.
    """
    ranks = _ranks(graph, [reset], max_iter, checkpoint_interval, links_per_piece, tol, log, write_rounds)
    return graph.vertices.join(ranks.withColumnRenamed("rank_0", "pagerank"), "id")


def pagerank_sweep(
    graph: Graph,
    resets: list[float],
    n: int,
    max_iter: int = 20,
    digits: int = 6,
    checkpoint_interval: int = CHECKPOINT_INTERVAL,
    links_per_piece: int = LINKS_PER_PIECE,
) -> DataFrame:
    """The ``n`` highest ranked vertices for each reset probability.

    All probabilities share the rounds, so the sweep costs one PageRank.
    """
    ranks = _ranks(graph, resets, max_iter, checkpoint_interval, links_per_piece)
    tops = []
    for i, reset in enumerate(resets):
        top = (
            ranks.select("id", F.round(f"rank_{i}", digits).alias("pagerank"))
            .orderBy(F.desc("pagerank"), "id")
            .limit(n)
        )
        tops.append(top.withColumn("reset", F.lit(reset)))
    # n rows per probability meet the vertices: the top rows may be broadcast.
    return reduce(DataFrame.unionByName, tops).join(graph.vertices.select("id", "code"), "id").select(
        "reset", "id", "code", "pagerank"
    )


def rank_and_degrees(graph: Graph, ranked: DataFrame) -> DataFrame:
    """Ranked vertices with their degrees; those lacking in- or out-edges drop out."""
    return ranked.join(graph.degrees(), "id")
