from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from airlake.llm.mtree import Search, build, build_index, top_k


def brute_force(stored, query, own, k):
    scores = sorted((-int(np.dot(v, query)), i) for i, v in stored if i != own)
    return [(-s, i) for s, i in scores[:k]]


def clusters(seed, n, width, spread=3, copies=0):
    draw = np.random.default_rng(seed)
    centres = draw.integers(-100, 100, (12, width))
    vectors = centres[draw.integers(0, 12, n)] + draw.integers(-spread, spread + 1, (n, width))
    vectors[:copies] = vectors[0]
    return vectors.astype(float)


def test_tree_is_exact_and_passes_most_vectors_over():
    for seed, copies in ((1, 0), (2, 700)):
        vectors = clusters(seed, 2000, 8, copies=copies)
        ids = np.random.default_rng(seed).permutation(2000)
        longest = float((vectors**2).sum(axis=1).max())
        pages = build(ids, vectors, longest, page=32, fan=4)
        assert sum(len(p.ids) for p in pages if p.ids is not None) == 2000
        tree = Search(pages, longest)
        for q in range(0, 2000, 97):
            got = tree.top(vectors[q], int(ids[q]), 5)
            assert got == brute_force(list(zip(ids.tolist(), vectors)), vectors[q], ids[q], 5)
        assert tree.computed < 0.5 * 21 * 2000


def test_covering_radii_and_parent_distances_hold():
    vectors = clusters(3, 500, 4)
    longest = float((vectors**2).sum(axis=1).max())
    pages = build(np.arange(500), vectors, longest, page=16, fan=4)

    def below(n):
        own = [] if pages[n].ids is None else pages[n].ids.tolist()
        return own + [i for c in pages[n].children for i in below(c)]

    lift = np.sqrt(np.maximum(longest - (vectors**2).sum(axis=1), 0))
    for n, p in enumerate(pages):
        ids = below(n)
        away = np.sqrt(((vectors[ids] - p.pivot) ** 2).sum(axis=1) + (lift[ids] - p.lift) ** 2)
        assert away.max() <= p.radius + 1e-9 and min(ids) == p.least_id


def test_bound_keeps_only_what_is_better():
    vectors = np.array([[1.0], [2.0], [3.0], [3.0]])
    tree = Search(build(np.array([1, 2, 3, 4]), vectors, 9.0), 9.0)
    assert tree.top(np.array([1.0]), 0, 2) == [(3, 3), (3, 4)]
    assert tree.top(np.array([1.0]), 0, 2, (3, 4)) == [(3, 3)]
    assert tree.top(np.array([1.0]), 0, 2, (3, 3)) == []


def test_many_trees_equal_brute_force(spark, rows):
    vectors = clusters(4, 600, 6, copies=200)
    data = [(i, v.tolist()) for i, v in enumerate(vectors)]
    odd = [(900, None), (901, [1.0, None]), (902, [float("nan")] * 6), (903, [float("inf")]), (None, [1.0] * 6), (904, [7.0]), (905, [])]
    repeated = [data[250], data[250], data[0]]
    frame = rows(data + odd + repeated, "id BIGINT, vector ARRAY<DOUBLE>")
    index = build_index(frame, tree_rows=64, page=8, fan=3)
    trees = index.pages.where('parent < 0').select('tree').distinct().count()
    assert len(index.pivots) <= 4 and trees >= 10  # in two levels
    found = top_k(index, frame.where("id % 25 = 0 OR id > 900"), 5).collect()
    stored = [(i, np.pad(np.array(v), (0, 6 - len(v)))) for i, v in data + [odd[5], odd[6]] + repeated]
    by = {}
    for r in sorted(found, key=lambda r: r["rank"]):
        by.setdefault(r.query_id, []).append((r.score, r.id))
    asked = [i for i, v in stored if i % 25 == 0 or i > 900]
    assert set(by) == set(asked)
    for i, v in stored:
        if i in by:
            want = brute_force(stored, v, i, 5)
            assert sorted(by[i]) == sorted(want * asked.count(i))


def test_small_and_empty_tables(spark, rows):
    schema = "id BIGINT, vector ARRAY<DOUBLE>"
    none = rows([], schema)
    assert top_k(build_index(none), none, 5).count() == 0
    two = rows([(1, [1.0, 2.0]), (2, [3.0, -1.0])], schema)
    assert [tuple(r) for r in top_k(build_index(two), two, 5).orderBy("query_id").collect()] == [(1, 1, 2, 1), (2, 1, 1, 1)]
    assert top_k(build_index(two), none, 5).count() == 0


def test_open_pairs_hold_no_vectors(spark, rows):
    from airlake.llm import mtree

    vectors = clusters(5, 300, 4)
    frame = rows([(i, v.tolist()) for i, v in enumerate(vectors)], "id BIGINT, vector ARRAY<DOUBLE>")
    index = build_index(frame, tree_rows=32, page=8, fan=3)
    some = frame.limit(20).select(F.col("id").alias("query"), "vector", F.lit(-1).cast("long").alias("home"), F.lit(1e6).alias("worst"), F.lit(0).cast("long").alias("worst_id"))
    pairs = mtree._promising(index, some)
    assert pairs.columns == ["tree", "query", "worst", "worst_id"] and pairs.count() == 0  # nothing beats that bound
    trees = index.pages.where("parent < 0").count()
    assert mtree._promising(index, some.withColumn("worst", F.lit(-1e9))).count() == 20 * trees


def test_columns_with_clashing_names(spark, rows):
    data = [(i, [float(i % 7), 1.0], 5, "x") for i in range(40)]
    frame = rows(data, "id BIGINT, vector ARRAY<DOUBLE>, tree INT, query STRING")
    found = top_k(build_index(frame), frame.where("id = 3"), 2).collect()
    assert [(r.query_id, r.id, r.score) for r in sorted(found, key=lambda r: r["rank"])] == [(3, 6, 19), (3, 13, 19)]
