from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from airlake.operators.aggregates import concat_sorted, listed, ranked_list, row_counts
from airlake.operators.combiner import combined
from airlake.operators.joins import grid_join, not_in, pair_totals, pairs_by_key
from airlake.operators.quality import airline_totals, exclude_airports, route_quality, with_distances
from airlake.operators.windows import largest_per_group, number_within, top_n_per_group
from airlake.operators.wordcount import (
    heads_of_runs, part_distribution, part_heads, place_words, run_invariants, top_words, word_counts,
)


@pytest.fixture(scope="module")
def skewed(spark):
    """600 rows; a third share one key, some have none."""
    random.seed(5)
    keys = ["hot"] * 200 + [None] * 40 + [f"k{random.randrange(30)}" for _ in range(360)]
    data = [(k, random.randrange(10**6) * 1000 + i) for i, k in enumerate(keys)]
    random.shuffle(data)
    return spark.createDataFrame(data, "k STRING, v BIGINT").repartition(6)


@pytest.mark.parametrize("width", [1, 4, 16])
def test_numbering_is_the_same_for_any_slices(spark, skewed, width):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", width)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = number_within(skewed, ["k"], [F.asc("v")]).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    groups = defaultdict(list)
    for r in skewed.collect():
        groups[r.k].append(r.v)
    want = {(k, v): i + 1 for k, vs in groups.items() for i, v in enumerate(sorted(vs))}
    assert {(r.k, r.v): r.rn for r in got} == want
    assert len(got) == 600


def test_numbering_descending(skewed):
    got = number_within(skewed, ["k"], [F.desc("v")], "rn").where("k = 'hot'").collect()
    ordered = [r.v for r in sorted(got, key=lambda r: r.rn)]
    assert ordered == sorted(ordered, reverse=True) and len(ordered) == 200


def test_filter_goes_below_the_numbered_view(spark, plan):
    from airlake.plans.relational import numbered_view

    view = numbered_view(spark, "/root/testdata/sf0.001")
    shown = plan(spark.table(view).where("address = 77"))
    assert "PushedFilters: [IsNotNull(o_custkey), EqualTo(o_custkey,77)]" in shown


def test_top_n_is_limited_before_the_shuffle(skewed, plan):
    top = top_n_per_group(skewed.where("k = 'hot'"), ["k"], [F.desc("v")], 3)
    best = sorted((r.v for r in skewed.collect() if r.k == "hot"), reverse=True)[:3]
    assert [r.v for r in top.orderBy("rank").collect()] == best
    shown = plan(top)
    assert shown.count("WindowGroupLimit") >= 2


def test_largest_per_group_takes_smallest_item_on_ties(rows):
    df = rows([("a", "x", 2), ("a", "b", 2), ("a", "z", 1), ("b", "q", 5)], "g STRING, item STRING, n BIGINT")
    assert pytest.tuples(largest_per_group(df, ["g"], "n", "item")) == [("a", "b", 2), ("b", "q", 5)]


def test_listed_leaves_nothing_out(skewed):
    df = skewed.where("k IS NOT NULL").select("k", F.col("v").cast("string").alias("s"))
    want = defaultdict(list)
    for r in df.collect():
        want[r.k].append(r.s)
    want = {(k, i + 1, s) for k, items in want.items() for i, s in enumerate(sorted(items))}
    assert {tuple(r) for r in listed(df, ["k"], "s").collect()} == want
    text = concat_sorted(df, ["k"], "s", "all").where("k = 'hot'").first()["all"]
    assert text == ", ".join(s for k, _, s in sorted(want) if k == "hot")


def test_listed_skips_missing_items(rows):
    df = rows([(1, "b"), (1, None), (1, "a"), (2, "c")], "g INT, s STRING")
    assert pytest.tuples(listed(df, ["g"], "s")) == [(1, 1, "a"), (1, 2, "b"), (2, 1, "c")]


def test_ranked_list(rows):
    df = rows([(1, 2, "x"), (1, 1, "z"), (2, 1, "q")], "g INT, rank INT, s STRING")
    assert pytest.tuples(ranked_list(df, ["g"], "rank", "s", "top")) == [(1, "z, x"), (2, "q")]


def test_pairs_equal_the_join(spark, rows, plan):
    random.seed(1)
    left = [(random.choice(["a", "b", "", None]), f"u{random.randrange(9)}") for _ in range(60)]
    right = [(random.choice(["a", "", "c", None]), f"f{random.randrange(9)}") for _ in range(50)]
    u, f = rows(left, "address STRING, edrpou STRING"), rows(right, "address STRING, fio STRING")
    joined = u.join(f, "address")
    want = joined.groupBy("address").agg(
        F.count_distinct("edrpou"), F.count_distinct("fio"), F.count("*")
    )
    assert pytest.tuples(pairs_by_key(u, f, "address", "edrpou", "fio")) == pytest.tuples(want)
    total = pair_totals(u, f, "address").first()
    assert (total.shared_keys, total.pairs) == (joined.select("address").distinct().count(), joined.count())


def test_pairs_of_huge_groups_do_not_overflow(spark):
    counts = spark.range(1).select((F.lit(3 * 10**11)).cast("decimal(19,0)") * F.lit(4 * 10**11).cast("decimal(18,0)"))
    assert counts.first()[0] == 12 * 10**22


@pytest.mark.parametrize("right", [[], [(1,)], [(1,), (1,), (3,)], [(1,), (None,)]])
def test_not_in_follows_sql(spark, rows, plan, right):
    left, keys = rows([(1,), (2,), (None,)], "a INT"), rows(right, "b INT")
    want = spark.sql("SELECT a FROM {l} WHERE a NOT IN (SELECT b FROM {r})", l=left, r=keys)
    got = not_in(left, "a", keys, "b")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert "NestedLoop" not in plan(got)


def test_row_counts(rows):
    assert pytest.tuples(row_counts({"x": rows([(1,), (2,)], "a INT"), "y": rows([], "a INT")})) == [("x", 2), ("y", 0)]


@pytest.fixture
def network(rows):
    airports = rows(
        [(1, "AAA", "X", 0.0, 0.0), (2, "BBB", "Y", 0.0, 90.0), (3, None, "Y", 90.0, 0.0)],
        "id INT, iata STRING, country STRING, latitude DOUBLE, longitude DOUBLE",
    )
    routes = rows(
        [
            (10, 1, 2, None), (10, 1, 2, None), (10, 2, 3, "Y"), (11, 1, 3, None), (None, 1, 2, None),
            (11, None, 2, None), (11, 1, 1, None), (11, 9, 1, None), (12, 2, 1, "Y"),
        ],
        "airline_id INT, src_id INT, dst_id INT, codeshare STRING",
    )
    return routes, airports


def test_route_quality(network):
    assert dict(map(tuple, route_quality(network[0]).collect())) == {
        "all": 9, "no_end": 1, "no_airline": 1, "shared": 2, "loops": 1,
    }


def test_distances_drop_loops_and_unknown_airports(network):
    flown = with_distances(*network)
    quarter = 2 * 3.141592653589793 * 6371 / 4
    got = flown.select("src_id", "dst_id", "distance_km").collect()
    assert len(got) == 6
    assert all(r.distance_km == pytest.approx(quarter) for r in got)
    assert exclude_airports(flown, [3]).count() == 4


def test_airline_totals_count_own_routes_only(network, rows):
    airlines = rows([(10, "Ten", "X"), (11, "Eleven", "Y"), (12, "Twelve", "Y")], "id INT, name STRING, country STRING")
    got = {r.id: (r.carrier, r.legs, r.km) for r in airline_totals(*network, airlines).collect()}
    assert got == {10: ("Ten", 2, 20015.0), 11: ("Eleven", 1, 10008.0)}


def test_wordcount_family(rows):
    lines = ["to be or not to be", "  that\tis the  question ", "", "to\fbe"]
    counts = word_counts(rows([(s,) for s in lines], "value STRING"))
    want = Counter(w for s in lines for w in s.split())
    assert {r.word: r["count"] for r in counts.collect()} == want
    placed = place_words(counts, [1, 2, 4])
    for row in run_invariants(placed).collect():
        assert (row.distinct_words, row.words_in_several_parts, row.occurrences) == (len(want), 0, sum(want.values()))
    parts = part_distribution(placed)
    assert {r.reducers: r.w for r in parts.groupBy("reducers").agg(F.sum("words").alias("w")).collect()} == {
        1: len(want), 2: len(want), 4: len(want)
    }
    assert all(r.words_pct == 100.0 for r in parts.where("reducers = 1").collect())
    heads = part_heads(placed.where("reducers = 1"), 3).orderBy("rank").collect()
    assert [r.word for r in heads] == sorted(want)[:3]
    assert [r.word for r in top_words(counts, 2).collect()] == ["be", "to"]


def test_words_are_combined_before_the_shuffle(rows, plan):
    shown = plan(word_counts(rows([("a b",)], "value STRING")))
    assert 0 < shown.find("partial_count") < shown.find("hashpartitioning(word")


def test_grid_join_forms_every_pair_once(spark, rows):
    draw = random.Random(8)
    left = [(draw.choice(["hot", "hot", "a", "b", None]), i) for i in range(400)]
    right = [(draw.choice(["hot", "hot", "hot", "a", "c", None]), -i) for i in range(300)]
    want = sorted((k, i, j) for k, i in left for m, j in right if k == m and k is not None)
    sides = rows(left, "k STRING, i INT"), rows(right, "k STRING, j INT")
    for cell_rows in (10_000, 50, 7):
        assert pytest.tuples(grid_join(*sides, "k", cell_rows)) == want
    assert grid_join(sides[0].limit(0), sides[1], "k").count() == 0


def test_small_sides_are_dealt_to_tasks_as_well(spark, tmp_path):
    """A pair costs the same however few bytes its rows have: a small file's one split must not form all pairs."""
    side = spark.range(300).select((F.col("id") % 2).alias("k"), F.col("id").alias("i")).coalesce(1)
    side.write.parquet(str(tmp_path / "side"))
    left = spark.read.parquet(str(tmp_path / "side"))
    joined = grid_join(left, left.withColumnRenamed("i", "j"), "k", cell_rows=50)
    sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 2 * 150 * 150 and len(sizes) >= 4 and max(sizes) <= 2 * 150 * 150 / 2


def test_a_hot_key_is_spread_over_tasks(spark, rows):
    left = spark.range(3000).select(F.lit("hot").alias("k"), F.col("id").alias("i"))
    right = spark.range(2000).select(F.lit("hot").alias("k"), F.col("id").alias("j"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        joined = grid_join(left, right, "k", cell_rows=100)
        sizes = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 6_000_000 and len(sizes) == 16 and sizes[-1] <= 3 * sizes[8]


def test_combined_rows_are_those_of_the_plan(spark):
    numbers = spark.range(0, 1000, 1, 4).select((F.col("id") % 10).alias("k"), "id")
    counted = combined(numbers.groupBy("k").agg(F.sum("id")))
    assert counted == [(1000, 40)]  # ten keys in each of four tasks
    assert combined(numbers.where("id < 0").groupBy("k").count()) == []
    exploded = numbers.select(F.explode(F.array("k", "id")).alias("v")).groupBy("v").count()
    (found,) = combined(exploded)
    assert found.rows_in == 2000 and found.rows_shuffled < 2000
    twice = numbers.groupBy("k").count().groupBy("count").agg(F.max("k"))
    assert [c.rows_in for c in combined(twice)][-1] == 1000


def test_heads_of_runs_are_heads_of_placed_words(rows):
    counts = rows([(f"w{i * 7919 % 1000}", i) for i in range(400)], "word STRING, count INT")
    for runs in ([1, 2, 4], [3, 2], [5]):
        found, wanted = heads_of_runs(counts, runs, 3), part_heads(place_words(counts, runs), 3)
        assert pytest.tuples(found) == pytest.tuples(wanted.select(found.columns))
