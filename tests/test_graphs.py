from __future__ import annotations

import random
import time
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from airlake.graph import Graph
from airlake.graph.bfs import bfs, busiest_without_direct_edge, route_columns
from airlake.graph.communities import (
    community_summary, group_sizes, isolated_components, label_propagation, largest_group,
)
from airlake.graph.components import connected_components
from airlake.graph.graph import collapse_routes, degree_centrality, touched_vertices
from airlake.graph.motif import Term, find_motif, parse, reduced, walk
from airlake.graph.pagerank import pagerank, pagerank_sweep, rank_and_degrees
from airlake.graph.cycles import count_four_cycles, four_cycles, neighbours, triangles
from airlake.graph.paths import (
    count_paths, count_stops, extreme_paths, half_walks, outermost_paths, path_counts, paths_up_to, promising, simple_paths,
    stop_counts,
)
from airlake.rounds import RoundLog
from airlake.scratch import _record, cut_lineage, new_path, sweep, working_area

A, B = "{v}.country = 'A'", "{v}.country = 'B'"
PATHS = {
    1: {"1 → 5": 10.0},
    2: {"1 → 3 → 5": 7.0, "2 → 3 → 5": 8.0},
    3: {"1 → 3 → 4 → 6": 12.0, "2 → 3 → 4 → 6": 13.0},
    4: {"2 → 3 → 4 → 1 → 5": 18.0},
}


def routes_of(paths):
    return {r.route: r.distance_km for r in paths.collect()}


def test_graph_needs_its_columns(rows):
    with pytest.raises(ValueError, match="dst"):
        Graph(rows([(1,)], "id INT"), rows([(1,)], "src INT"))


def test_parallel_routes_collapse(rows):
    routes = rows([(1, 2, 7), (1, 2, 7), (1, 2, 8), (2, 1, None)], "src_id INT, dst_id INT, airline_id INT")
    assert pytest.tuples(collapse_routes(routes)) == [(1, 2, 2, 3), (2, 1, 0, 1)]


def test_only_touched_vertices(rows):
    vertices = rows([(1,), (2,), (3,)], "id INT")
    assert pytest.tuples(touched_vertices(vertices, rows([(2, 1)], "src INT, dst INT"))) == [(1,), (2,)]


@pytest.mark.parametrize("segments", [1, 2, 3, 4])
def test_simple_paths(tiny, segments):
    assert routes_of(simple_paths(tiny, segments, A, B)) == PATHS[segments]
    names = "abcdefg"[: segments + 1]
    bound = {names[0]: tiny.vertices.where("country = 'A'"), names[-1]: tiny.vertices.where("country = 'B'")}
    found = find_motif(tiny, walk(names), distinct=True, bound=bound)
    codes = F.concat_ws(" → ", *(f"{n}.code" for n in names))
    assert {r[0] for r in found.select(codes).collect()} == set(PATHS[segments])


def test_paths_of_several_lengths(tiny):
    paths = paths_up_to(tiny, 4, A, B)
    assert pytest.tuples(path_counts(paths)) == [(1, 1), (2, 2), (3, 2), (4, 1)]
    ends = {r.kind: r.route for r in extreme_paths(paths, 1).collect()}
    assert ends == {"shortest": "1 → 3 → 5", "longest": "2 → 3 → 4 → 1 → 5"}
    assert pytest.tuples(stop_counts(simple_paths(tiny, 2, A, B))) == [("3", 2)]
    assert pytest.tuples(stop_counts(paths)) == [("1", 1), ("3", 5), ("4", 3)]
    assert paths_up_to(tiny, 3, "FALSE", B).count() == 0


def test_paths_equal_brute_force(spark):
    graph, pairs = random_graph(spark, 12, vertices=14, edges=50)
    km = {(a, b): float(1 + (a * 7 + b) % 5) for a, b in pairs}
    graph = Graph(graph.vertices, spark.createDataFrame([(a, b, d) for (a, b), d in km.items()], "src BIGINT, dst BIGINT, distance_km DOUBLE"))
    want, frontier = Counter(), [((i,), 0.0) for i in range(14) if i % 3 == 0]
    for _ in range(4):
        frontier = [(p + (b,), d + km[a, b]) for p, d in frontier for a, b in pairs if a == p[-1] and b not in p]
        want.update((len(p) - 1, " → ".join(f"c{i}" for i in p), d) for p, d in frontier if p[-1] % 3 == 1)
    got = paths_up_to(graph, 4, "{v}.country = 'land 0'", "{v}.country = 'land 1'")
    assert Counter(tuple(r) for r in got.collect()) == want


def weighted(spark, seed, vertices, edges):
    graph, pairs = random_graph(spark, seed, vertices=vertices, edges=edges)
    km = {(a, b): float(1 + (a * 7 + b * 3) % 11) for a, b in pairs}
    rows = [(a, b, d) for (a, b), d in km.items()]
    return Graph(graph.vertices, spark.createDataFrame(rows, "src BIGINT, dst BIGINT, distance_km DOUBLE")), km


def walked(km, starts, ends, longest):
    found, frontier = [], [((i,), 0.0) for i in starts]
    for _ in range(longest):
        frontier = [(p + (b,), d + km[a, b]) for p, d in frontier for a, b in km if a == p[-1] and b not in p]
        found += [(p, d) for p, d in frontier if p[-1] in ends]
    return found


def test_counts_and_outermost_paths_equal_brute_force(spark):
    graph, km = weighted(spark, 21, 20, 70)
    land = [{i for i in range(20) if i % 3 == n} for n in range(2)]
    start, end = "{v}.country = 'land 0'", "{v}.country = 'land 1'"
    for longest in (1, 3, 4, 5):
        paths = walked(km, *land, longest)
        assert dict(pytest.tuples(count_paths(graph, longest, start, end))) == Counter(len(p) - 1 for p, _ in paths)
        stops = Counter(f"c{i}" for p, _ in paths for i in p[1:-1])
        assert dict(pytest.tuples(count_stops(graph, longest, start, end))) == stops
        named = [(d, " → ".join(f"c{i}" for i in p)) for p, d in paths]
        for n in (1, 6, 10_000):
            got = [(r.kind, r.distance_km, r.route) for r in extreme_paths(outermost_paths(graph, longest, start, end, n), n).collect()]
            want = [("shortest", *x) for x in sorted(named)[:n]] + [("longest", *x) for x in sorted(named, key=lambda x: (-x[0], x[1]))[:n]]
            assert sorted(got) == sorted(want)
    assert count_paths(graph, 4, "FALSE", end).count() == 0
    assert outermost_paths(graph, 4, start, "FALSE", 3).count() == 0


def test_outermost_paths_join_fewer_halves(spark):
    graph, km = weighted(spark, 22, 24, 140)
    halves = half_walks(graph, "{v}.id < 6", "{v}.id > 17", 4, lambda df: df.cache())
    first, second = halves.meeting(4)
    lengths = sorted(d for p, d in walked(km, range(6), set(range(18, 24)), 4) if len(p) == 5)
    kept = promising(first, second, lengths[0], lengths[-1])
    assert 0 < kept.count() < first.count() / 3


def test_counting_paths_writes_no_path(spark, tmp_path):
    graph, _ = weighted(spark, 23, 12, 40)
    sweep(spark)
    count_paths(graph, 4, "{v}.id < 4", "{v}.id > 8").count()
    assert len(_record(spark)["paths"]) == 2  # the counts, and the edges kept for further searches
    sweep(spark)


def test_counted_halves_are_not_joined(spark):
    """Many halves meet in one vertex and some share others: as many rows as halves, and few for each task."""
    from airlake.graph.paths import _count_apart

    one_way = [(i, 100 + j) for i in range(4) for j in range(12)] + [(100 + j, 50) for j in range(12)]
    other_way = [(50, 100 + j) for j in range(6, 18)] + [(100 + j, 200 + i) for j in range(6, 18) for i in range(3)] + [(50, 2), (2, 200), (2, 3), (3, 50)]
    pairs = one_way + other_way
    ids = sorted({v for pair in pairs for v in pair})
    graph = Graph(
        spark.createDataFrame([(i, f"v{i}") for i in ids], "id BIGINT, code STRING"),
        spark.createDataFrame([(a, b, 1.0) for a, b in pairs + pairs[:3]], "src BIGINT, dst BIGINT, distance_km DOUBLE"),
    )
    start, end = "{v}.id < 4", "{v}.id >= 200"
    expected = dict(pytest.tuples(path_counts(paths_up_to(graph, 4, start, end))))
    assert expected[4] > 400
    halves = half_walks(graph, start, end, 4, lambda df: df.cache(), counted=True)
    for most in (5, 1000):  # vertices where more halves meet are dealt to several tasks
        with working_area(spark) as area:
            counted = _count_apart(halves, range(1, 5), area, most)
            assert dict(pytest.tuples(counted)) == expected
            rows = [half.count() for half in (*halves.onward, *halves.back)]
            assert spark.read.parquet(next(p for p in area.paths if "meeting" in p)).count() <= sum(rows)


def test_cycles_equal_brute_force(spark):
    for seed in (31, 32):
        graph, pairs = random_graph(spark, seed, vertices=18, edges=110)
        pairs = {(a, b) for a, b in pairs if a != b}
        out = defaultdict(set)
        for a, b in pairs:
            out[a].add(b)
        three = {(a, b, c) for a, b in pairs for c in out[b] if a in out[c]}
        four = {(a, b, c, d) for a, b in pairs for c in out[b] for d in out[c] if a in out[d] and len({a, b, c, d}) == 4}
        assert three and four
        doubled = Graph(graph.vertices, graph.edges.union(graph.edges.limit(5)))  # parallel edges are one here
        assert pytest.tuples(triangles(doubled)) == sorted(three)
        assert pytest.tuples(four_cycles(doubled)) == sorted(four)
        assert count_four_cycles(doubled).first().matches == len(four)
        assert count_four_cycles(doubled, wedges_per_task=20).first().matches == len(four)
        found = find_motif(graph, "(p)-[x]->(q); (q)-[y]->(r); (r)-[z]->(s); (s)-[w]->(p)", distinct=True)
        assert found.columns == ["x", "y", "z", "w", "p", "q", "r", "s"]
        assert pytest.tuples(found.select("p.id", "q.id", "r.id", "s.id")) == sorted(four)
        found = find_motif(graph, "(p)-[x]->(q); (q)-[y]->(r); (r)-[z]->(p)", distinct=True)
        assert pytest.tuples(found.select("x.src", "y.src", "z.src")) == sorted(three)
    assert count_four_cycles(Graph(graph.vertices, graph.edges.limit(0))).first().matches == 0


def test_wedges_are_moved_as_lists(spark):
    """A row for each vertex and higher neighbour of it, not for each wedge; busy tops are dealt to several tasks."""
    from airlake.graph.cycles import _numbered_links, _wedge_lists, _wedges

    pairs = [(a, 100 + b) for a in range(30) for b in range(60) if (a * b) % 7] + [(100 + b, a) for a in range(30) for b in range(60) if (a + b) % 3 == 0]
    graph = Graph(spark.range(200), spark.createDataFrame(pairs, "src BIGINT, dst BIGINT"))
    wedges = _wedges(graph).count()
    with working_area(spark) as area:
        links, kind = _numbered_links(graph, area)
        lists, dealt_by, _ = _wedge_lists(links, kind, 10**6, area)
        assert dealt_by == ["top"] and lists.select(F.explode("lows")).count() == wedges
        assert lists.count() <= links.count() / 2 < wedges / 4
        lists, dealt_by, tasks = _wedge_lists(links, kind, 100, area)
        assert dealt_by == ["top", "part"] and tasks > 100 and lists.select(F.explode("lows")).count() == wedges
        shares = lists.groupBy("top", "part").agg(F.sum(F.size("lows")).alias("n"))
        assert shares.groupBy("top").agg(F.max("n").alias("n")).agg(F.max("n")).first()[0] < wedges / 20
    assert count_four_cycles(graph, 100).first().matches == count_four_cycles(graph).first().matches > 0


def test_no_wedge_over_a_busy_vertex(spark):
    """A star's centre has very many pairs of neighbours; none of them is formed."""
    from airlake.graph.cycles import _wedges

    star = [(0, i) for i in range(1, 200)] + [(i, 0) for i in range(1, 200)]
    graph = Graph(spark.range(200), spark.createDataFrame(star + [(1, 2), (2, 3)], "src BIGINT, dst BIGINT"))
    lower = {r.v: r.n for r in neighbours(graph).groupBy("v").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert _wedges(graph).count() <= sum(min(lower[0], lower[i]) for i in range(1, 200)) + 4


def test_bound_walks_use_only_edges_between_the_ends(spark, rows):
    # From 1 a hub leads to 100 vertices, of which one goes on to the end.
    edges = [(1, 2)] + [(2, i) for i in range(10, 110)] + [(50, 3), (60, 61), (4, 3)]
    graph = Graph(spark.range(200), rows(edges, "src BIGINT, dst BIGINT"))
    bound = {"a": graph.vertices.where("id = 1"), "d": graph.vertices.where("id = 3")}
    left = reduced(graph, walk("abcd"), bound)
    assert {name: pytest.tuples(df) for name, df in left.items()} == {"a_b": [(1, 2)], "b_c": [(2, 50)], "c_d": [(50, 3)]}
    found = find_motif(graph, walk("abcd"), bound=bound)
    assert [(r.a.id, r.b.id, r.c.id, r.d.id) for r in found.collect()] == [(1, 2, 50, 3)]


def test_returned_paths_are_read_not_searched_again(tiny, plan):
    shown = plan(extreme_paths(paths_up_to(tiny, 4, A, B), 2))
    assert "Join" not in shown


def test_motifs(tiny, plan):
    assert walk("abc") == [Term("a", "a_b", "b"), Term("b", "b_c", "c")]
    assert parse("(a)-[e1]->(b); (b)-[e2]->(c)") == [Term("a", "e1", "b"), Term("b", "e2", "c")]
    walks = find_motif(tiny, walk("abc"))
    assert walks.columns == ["a_b", "a", "b", "b_c", "c"]
    assert walks.where("a.id = 7 AND c.id = 7").count() == 1
    assert find_motif(tiny, walk("abc"), distinct=True).where("a.id = 7").count() == 0
    loop = find_motif(tiny, "(a)-[x]->(b); (b)-[y]->(a)")
    assert sorted(r.a.id for r in loop.collect()) == [7, 8]
    with pytest.raises(ValueError, match="shares no vertex"):
        find_motif(tiny, "(a)-[x]->(b); (c)-[y]->(d)")
    with pytest.raises(ValueError, match="not a list"):
        find_motif(tiny, "a->b")
    assert "CartesianProduct" not in plan(walks) and "NestedLoop" not in plan(walks)


def test_loops_in_motifs(rows):
    graph = Graph(rows([(1,), (2,)], "id INT"), rows([(1, 1), (1, 2)], "src INT, dst INT"))
    assert [r.a.id for r in find_motif(graph, "(a)-[x]->(a)").collect()] == [1]
    assert find_motif(graph, "(a)-[x]->(a)", distinct=True).count() == 1
    assert [(r.a.id, r.b.id) for r in find_motif(graph, walk("ab"), distinct=True).collect()] == [(1, 2)]


def test_bfs(tiny):
    direct = bfs(tiny, "country = 'A'", "country = 'B'", 3)
    assert direct.columns == ["from", "e0", "to"]
    assert routes_of(route_columns(direct)) == {"1 → 5": 10.0}
    two = bfs(tiny, "id = 2", "country = 'B'", 3)
    assert two.columns == ["from", "e0", "v1", "e1", "to"]
    assert routes_of(route_columns(two)) == {"2 → 3 → 5": 8.0}
    assert bfs(tiny, "id = 2", "id = 6", 2).count() == 0
    assert bfs(tiny, "id = 2", "id = 6", 3).count() == 1
    assert bfs(tiny, "id = 7", "id = 1", 10).count() == 0
    same = bfs(tiny, "country = 'A'", "id = 1", 3)
    assert same.columns == ["from", "to"] and [r.to.id for r in same.collect()] == [1]


def test_busiest_without_direct_edge(tiny):
    row = busiest_without_direct_edge(tiny, "country = 'A'", "country = 'B'").first()
    assert (row.id, row.departures) == (2, 1)


def test_degrees(tiny):
    assert sorted(r.id for r in tiny.degrees().collect()) == [1, 3, 4, 7, 8]
    assert tiny.degrees("outer").count() == 9
    assert [(r.id, r.outDegree) for r in degree_centrality(tiny, 3).collect()] == [(1, 2), (3, 2), (4, 2)]


def random_graph(spark, seed, vertices=40, edges=70, text=False):
    random.seed(seed)
    pairs = {(random.randrange(vertices), random.randrange(vertices)) for _ in range(edges)}
    pairs |= {(0, i) for i in range(1, vertices // 3)}  # a hub
    name = (lambda i: f"n{i:03}") if text else (lambda i: i)
    kind = "STRING" if text else "BIGINT"
    nodes = [(name(i), f"c{i}", f"City {i}", f"land {i % 3}") for i in range(vertices)]
    graph = Graph(
        spark.createDataFrame(nodes, f"id {kind}, code STRING, city STRING, country STRING"),
        spark.createDataFrame([(name(a), name(b)) for a, b in sorted(pairs)], f"src {kind}, dst {kind}"),
    )
    return graph, pairs


def brute_pagerank(n, pairs, reset, rounds):
    out = Counter(a for a, _ in pairs)
    rank = [1.0] * n
    for _ in range(rounds):
        new = [reset] * n
        for a, b in pairs:
            new[b] += (1 - reset) * rank[a] / out[a]
        rank = new
    total = sum(rank)
    return [r * n / total for r in rank]


@pytest.mark.parametrize("links_per_piece", [100_000, 3])
def test_pagerank(spark, links_per_piece):
    graph, pairs = random_graph(spark, 3)
    got = {r.id: r.pagerank for r in pagerank(graph, 0.15, 7, 3, links_per_piece).collect()}
    want = brute_pagerank(40, pairs, 0.15, 7)
    assert sum(got.values()) == pytest.approx(40)
    assert [got[i] for i in range(40)] == pytest.approx(want)


@pytest.mark.parametrize("links_per_piece", [100_000, 2])
def test_pagerank_of_parallel_edges_and_vertices_without_any(spark, links_per_piece):
    pairs = [(0, 1)] * 7 + [(0, 2), (1, 0), (3, 0), (2, 2)]
    graph = Graph(spark.range(6), spark.createDataFrame(pairs, "src BIGINT, dst BIGINT"))
    got = {r.id: r.pagerank for r in pagerank(graph, 0.3, 6, 2, links_per_piece).collect()}
    assert [got[i] for i in range(6)] == pytest.approx(brute_pagerank(6, pairs, 0.3, 6))


def test_pagerank_ends_when_settled(spark, monkeypatch):
    import airlake.graph.pagerank as module

    graph, pairs = random_graph(spark, 3)
    cuts, original = [], module.cut_lineage
    monkeypatch.setattr(module, "cut_lineage", lambda df: cuts.append(1) or original(df))
    got = {r.id: r.pagerank for r in pagerank(graph, 0.5, 200, 5, tol=1e-4).collect()}
    assert len(cuts) < 10
    assert [got[i] for i in range(40)] == pytest.approx(brute_pagerank(40, pairs, 0.5, 200), abs=1e-2)
    cuts.clear()
    pagerank(graph, 0.5, 12, 5).collect()
    assert len(cuts) == 3


def shuffle_files(spark):
    """The names of the shuffle files that are on this machine's disk."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").splitlines()
    return {name.rsplit("/", 1)[-1] for name in files if "/shuffle_" in name}


def gone(spark, before, seconds=20):
    """Whether no shuffle files are left but those there before; Spark removes them a little later."""
    end = time.monotonic() + seconds
    while shuffle_files(spark) - before and time.monotonic() < end:
        time.sleep(0.1)
    return not shuffle_files(spark) - before


@pytest.mark.parametrize("how", ["kept", "bucketed", "cut", "recorded"])
def test_copies_leave_no_shuffle_files(spark, how):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = shuffle_files(spark), spark.conf.get(name, None)
    counts = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    with working_area(spark) as area:
        if how == "kept":
            copy = area.keep(counts)
        elif how == "bucketed":
            copy = area.bucketed(counts, ["k"])
        elif how == "cut":
            copy = cut_lineage(counts)
        else:
            copy = RoundLog(spark, new_path(spark, "rounds")).record(1, counts)
        assert gone(spark, before)
        assert spark.conf.get(name, None) == setting
        assert sorted(r.n for r in copy.collect()) == [142] + [143] * 6


def test_the_latest_copy_takes_the_last_ones_place(spark):
    from pathlib import Path

    with working_area(spark) as area:
        first = area.keep_latest(spark.range(3), "state")
        path = Path(area.paths[-1])
        assert path.exists()
        second = area.keep_latest(first.select((F.col("id") + 1).alias("id")), "state")
        assert not path.exists() and len(area.paths) == 1
        assert pytest.tuples(second) == [(1,), (2,), (3,)]
    assert not _record(spark)["paths"] & set(area.paths)


@pytest.mark.parametrize("links_per_piece", [100_000, 2])
def test_a_round_is_off_the_disk_before_the_next(spark, monkeypatch, links_per_piece):
    """With ``write_rounds`` every state is written from one round, and no shuffle but that round's was ever there."""
    import airlake.graph.pagerank as module
    from airlake.scratch import WorkingArea

    graph, pairs = random_graph(spark, 3)
    before, seen = shuffle_files(spark), []

    def rounds_in(df):
        assert gone(spark, before)
        seen.append(df._jdf.queryExecution().optimizedPlan().toString().count("Join"))

    latest, cut = WorkingArea.keep_latest, module.cut_lineage
    monkeypatch.setattr(WorkingArea, "keep_latest", lambda self, df, label: rounds_in(df) or latest(self, df, label))
    monkeypatch.setattr(module, "cut_lineage", lambda df: rounds_in(df) or cut(df))
    got = {r.id: r.pagerank for r in pagerank(graph, 0.15, 7, 3, links_per_piece, write_rounds=True).collect()}
    assert seen == [1] * 7
    assert [got[i] for i in range(40)] == pytest.approx(brute_pagerank(40, pairs, 0.15, 7))


def test_the_pagerank_query_writes_its_rounds(monkeypatch):
    import airlake.plans.graphs as module
    from airlake.plans.registry import QUERIES

    asked = []
    monkeypatch.setattr(module, "shipments", lambda *_, **__: None)
    monkeypatch.setattr(module, "pagerank", lambda graph, **options: asked.append(options))
    with pytest.raises(AttributeError):  # there is no result to select from
        QUERIES["pagerank"](None, "")
    assert asked == [{"write_rounds": True}]


def test_shipments_look_up_ends_of_kept_pairs(spark, rows, tmp_path, monkeypatch):
    """Missing, repeated and null keys give the rows of the SQL; the lines' join is done before the ends are joined."""
    import airlake.plans.networks as module

    tables = {
        "region": ([(0, "R")], "r_regionkey INT, r_name STRING"),
        "nation": ([(0, "A", 0), (1, "B", 0), (2, "C", 0)], "n_nationkey INT, n_name STRING, n_regionkey INT"),
        "customer": ([(1, "c1", 0), (2, "c2", 1), (None, "c", 1)], "c_custkey BIGINT, c_name STRING, c_nationkey INT"),
        "supplier": ([(1, "s1", 1), (1, "again", 2), (2, "s2", 0), (None, "s", 0)], "s_suppkey BIGINT, s_name STRING, s_nationkey INT"),
        "orders": ([(1, 1), (2, 2), (3, 9), (4, None)], "o_orderkey BIGINT, o_custkey BIGINT"),
        "lineitem": (
            [(1, 1, "R"), (1, 1, "N"), (1, 2, "N"), (2, 2, "R"), (2, 2, "R"), (3, 1, "R"), (4, 1, "R"), (2, None, "R"), (2, 9, "R"), (2, 2, None)],
            "l_orderkey BIGINT, l_suppkey BIGINT, l_returnflag STRING",
        ),
    }
    for name, (data, schema) in tables.items():
        rows(data, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    plans, real = [], module.keep
    monkeypatch.setattr(module, "keep", lambda df, label: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or real(df, label))
    before = set(_record(spark)["paths"])
    graph = module.shipments(spark, str(tmp_path), reused=True)
    assert "Join" in plans[0] and "Aggregate" not in plans[0]
    assert len(set(_record(spark)["paths"]) - before) == 2  # edges and vertices; the pairs are gone
    # Suppliers 3 (twice, of nations 1 and 2) and 5, customers 2 and 4.
    found = sorted((r.src, r.dst, r.airlines) for r in graph.edges.collect())
    assert found == [(2, 3, 1), (2, 3, 1), (3, 2, 2), (3, 2, 2), (4, 5, 2), (5, 2, 1), (5, 4, 3)]
    far = {(r.src, r.dst, round(r.distance_km, 6)) for r in graph.edges.collect()}
    assert len(far) == 7 and {(b, a, km) for a, b, km in far if (a, b) in ((2, 3), (4, 5))} <= far
    assert sorted(r.id for r in graph.vertices.collect()) == [2, 3, 3, 4, 5]


def test_ranks_are_handed_to_links_in_place(spark, monkeypatch, plan):
    """Without a source of several pieces a round has one shuffle, that of what the links hand on."""
    import airlake.graph.pagerank as module

    graph, _ = random_graph(spark, 3)
    seen, original = [], module.cut_lineage
    monkeypatch.setattr(module, "cut_lineage", lambda df: seen.append(plan(df)) or original(df))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pagerank(graph, 0.15, 4, 100).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len([line for line in seen[0].splitlines() if line.startswith("(") and ") Exchange" in line]) == 4


def test_a_sweep_shuffles_one_number_per_link(spark, monkeypatch):
    """However many probabilities: what a round hands on doesn't depend on them."""
    import airlake.graph.pagerank as module

    graph, pairs = random_graph(spark, 3)
    states, original = [], module.cut_lineage
    monkeypatch.setattr(module, "cut_lineage", lambda df: states.append(df._jdf.queryExecution().optimizedPlan().toString()) or original(df))
    resets = [0.05, 0.15, 0.3, 0.5, 0.85]
    got = {(r.reset, r.id): r.pagerank for r in module.pagerank_sweep(graph, resets, 40, 4, checkpoint_interval=4).collect()}
    for reset in resets:
        assert [got[reset, i] for i in range(40)] == pytest.approx(brute_pagerank(40, pairs, reset, 4), abs=1e-6)
    sums = [line for line in states[0].splitlines() if "Aggregate" in line and "sum(" in line]
    assert sums and all(line.count("sum(") == 1 for line in sums)


def test_plan_of_pagerank_grows_with_the_rounds_only(spark, monkeypatch):
    """Hub or not, a round adds one join; nothing is doubled."""
    import airlake.graph.pagerank as module

    graph, _ = random_graph(spark, 3)
    joins = []

    def seen(df):
        joins.append(df._jdf.queryExecution().optimizedPlan().toString().count("Join"))
        return original(df)

    original = module.cut_lineage
    monkeypatch.setattr(module, "cut_lineage", seen)
    for rounds in (2, 4):
        pagerank(graph, 0.15, rounds, 100, links_per_piece=2).collect()
    assert joins == [2, 4]


def test_working_copies_are_removed(spark, tmp_path):
    from pathlib import Path

    sweep(spark)
    graph, _ = random_graph(spark, 3)
    pagerank(graph, max_iter=2).write.parquet(str(tmp_path / "ranks"))
    label_propagation(graph, 2).write.parquet(str(tmp_path / "labels"))
    left = _record(spark)
    assert not left["tables"] and not left["paths"]
    path = paths_up_to(Graph(graph.vertices, graph.edges.withColumn("distance_km", F.lit(1.0))), 2, "{v}.id = 0", "{v}.id = 1")
    path.write.parquet(str(tmp_path / "paths"))
    assert len(left["paths"]) == 2  # the result and the edges kept for further searches
    sweep(spark)
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    assert not left["paths"] and not list(shared.glob("paths-*")) and not list(shared.glob("links-*"))


def test_pagerank_sweep_flattens(spark):
    graph, pairs = random_graph(spark, 3)
    top = pagerank_sweep(graph, [0.05, 0.85], 5, max_iter=6).collect()
    assert len(top) == 10
    best = {reset: max(r.pagerank for r in top if r.reset == reset) for reset in (0.05, 0.85)}
    assert best[0.05] > best[0.85]
    assert best[0.85] == pytest.approx(max(brute_pagerank(40, pairs, 0.85, 6)), abs=1e-6)


def test_pagerank_of_an_empty_graph(spark):
    empty = Graph(spark.range(0), spark.createDataFrame([], "src BIGINT, dst BIGINT"))
    assert pagerank(empty, max_iter=2).count() == 0


def test_bucketed_links_stay_in_place(spark, plan):
    from airlake.scratch import working_area

    links = spark.range(1000).select((F.col("id") % 97).alias("src"), F.col("id").alias("dst"))
    ranks = spark.range(500).groupBy((F.col("id") % 97).alias("src")).agg(F.sum("id").alias("rank"))
    with working_area(spark) as area:
        joined = area.bucketed(links, ["src"]).join(ranks.hint("merge"), "src")
        shown = plan(joined)
        assert shown.count("hashpartitioning(") == 1  # the aggregation's own exchange
        assert joined.count() == 1000


def test_rank_and_degrees(tiny):
    ranked = rank_and_degrees(tiny, pagerank(tiny, max_iter=3))
    assert sorted(r.id for r in ranked.collect()) == [1, 3, 4, 7, 8]


def brute_components(n, pairs):
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return [root(i) for i in range(n)]


@pytest.mark.parametrize("seed,edges", [(1, 20), (2, 45), (4, 0)])
def test_components(spark, seed, edges):
    graph, pairs = random_graph(spark, seed, edges=edges)
    got = {r.id: r.component for r in connected_components(graph).collect()}
    assert [got[i] for i in range(40)] == brute_components(40, pairs)


def test_long_chain_takes_few_rounds(spark, monkeypatch):
    """A path of 200 vertices in random order: rounds grow like the logarithm."""
    import airlake.graph.components as module

    random.seed(9)
    order = random.sample(range(200), 200)
    edges = spark.createDataFrame(list(zip(order, order[1:])), "src BIGINT, dst BIGINT")
    rounds = []
    star = module._large_star
    monkeypatch.setattr(module, "_large_star", lambda *a: rounds.append(1) or star(*a))
    found = connected_components(Graph(spark.range(200), edges))
    assert found.select("component").distinct().collect()[0].component == 0
    assert found.where("component <> 0").count() == 0
    assert len(rounds) <= 9


def test_components_of_text_ids(spark):
    graph, pairs = random_graph(spark, 6, edges=25, text=True)
    got = {r.id: r.component for r in connected_components(graph).collect()}
    want = brute_components(40, pairs)
    assert got == {f"n{i:03}": f"n{want[i]:03}" for i in range(40)}


def test_known_components(tiny):
    found = connected_components(tiny)
    assert {r.id: r.component for r in found.collect()} == {**dict.fromkeys(range(1, 7), 1), **dict.fromkeys((7, 8, 9), 7)}
    sizes = group_sizes(found, "component")
    assert pytest.tuples(sizes) == [(1, 6), (7, 3)]
    assert largest_group(sizes, "component") == 1
    assert pytest.tuples(isolated_components(found)) == [
        (7, 3, "countries", 1, "C"), (7, 3, "members", 1, "7 (City 7)"), (7, 3, "members", 2, "8 (City 8)"),
        (7, 3, "members", 3, "9 (City 9)"),
    ]


def brute_labels(n, pairs, rounds):
    heard = defaultdict(list)
    for a, b in pairs:
        heard[b].append(a)
        heard[a].append(b)
    label = list(range(n))
    for _ in range(rounds):
        label = [
            min(Counter(label[j] for j in heard[i]).items(), key=lambda kv: (-kv[1], kv[0]))[0] if heard[i] else label[i]
            for i in range(n)
        ]
    return label


@pytest.mark.parametrize("links_per_piece,interval", [(100_000, 2), (3, 1)])
def test_label_propagation(spark, links_per_piece, interval):
    graph, pairs = random_graph(spark, 8)
    got = {r.id: r.label for r in label_propagation(graph, 5, interval, links_per_piece).collect()}
    assert [got[i] for i in range(40)] == brute_labels(40, pairs, 5)


def test_community_summary(rows):
    members = rows(
        [(i, f"c{i}", "X" if i < 4 else "Y", 1) for i in range(1, 7)] + [(9, "c9", "Z", 2)],
        "id INT, code STRING, country STRING, label INT",
    )
    degrees = rows([(1, 1, 1), (2, 1, 5), (6, 2, 5)], "id INT, inDegree INT, outDegree INT")
    row = community_summary(members, degrees, at_least=5, hubs=2).collect()
    assert len(row) == 1
    assert row[0].asDict() == {
        "label": 1, "members": 6, "countries": 2, "lead_country": "X", "hubs": "c2, c6", "lead_share": 0.5,
    }
    alone = community_summary(members, degrees.where("id = 9"), at_least=1).where("label = 2").first()
    assert alone.hubs is None


@pytest.mark.parametrize("links_per_piece", [100_000, 2])
def test_label_rounds_write_no_votes(spark, monkeypatch, links_per_piece):
    """Links are written once; a round writes labels only. Ends without a vertex vote for themselves in every round."""
    from airlake.scratch import WorkingArea

    graph, pairs = random_graph(spark, 5)
    written, original = [], WorkingArea.bucketed
    monkeypatch.setattr(WorkingArea, "bucketed", lambda self, df, *rest, **more: written.append(df.columns) or original(self, df, *rest, **more))
    some = Graph(graph.vertices.where("id >= 10"), graph.edges)
    got = {r.id: r.label for r in label_propagation(some, 4, 1, links_per_piece).collect()}
    labels = {i: i for i in range(40)}
    for _ in range(4):
        votes = {i: {} for i in labels}
        for a, b in pairs:
            for x, y in ((a, b), (b, a)):
                votes[x][labels[y]] = votes[x].get(labels[y], 0) + 1
        labels = {i: min((-n, l) for l, n in votes[i].items())[1] if i >= 10 and votes[i] else labels[i] for i in labels}
    assert got == {i: labels[i] for i in range(10, 40)}
    assert len(written) == 1 and "hearers" in written[0]
