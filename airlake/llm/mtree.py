"""Exact search for the largest inner products with M-trees.

The largest inner product is the smallest distance in a metric space of one dimension
more: a stored vector x becomes (x, sqrt(M - |x|^2)), where M is the largest squared length,
a query q becomes (q, 0), and d(q, x)^2 = |q|^2 + M - 2 q.x.

Vectors are dealt to trees of bounded size, near ones together: first by pivots whose number is the square
root of the trees', then, within each such region, by pivots of its own. A tree's pages are rows: a
pivot, the covering radius around it, the distance from the parent's pivot, the smallest
id below; leaves also hold vectors and their distances from the pivot. A search goes best
first through the pages by the least distance anything below can have. With |d(q, p) -
d(p, x)| <= d(q, x), known from the stored distances, children and vectors are passed
over without computing theirs.

Each query first searches one tree near it. Only trees whose root may hold something
better than what it found are searched afterwards, with that as the bound.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import isqrt

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airlake.scratch import keep

#: Vectors of a page, children of an inner page, vectors of a tree.
PAGE, CHILDREN, TREE_ROWS = 256, 16, 8192
#: Queries or roots that are compared in one block, vectors that are dealt out together.
BLOCK, DEALT = 1024, 65_536
#: The bits of a tree's number: its region, its part of the region, its piece of the part.
REGION_AT, PART_AT = 47, 30

PAGES = (
    "tree BIGINT, page INT, parent INT, leaf BOOLEAN, pivot BINARY, lift DOUBLE, radius DOUBLE, parent_distance DOUBLE, "
    "least_id BIGINT, ids BINARY, vectors BINARY, distances BINARY"
)
FOUND = "query BIGINT, id BIGINT, score BIGINT"


@dataclass
class Page:
    parent: int
    pivot: np.ndarray
    lift: float
    radius: float
    parent_distance: float
    least_id: int
    ids: np.ndarray | None = None
    vectors: np.ndarray | None = None
    distances: np.ndarray | None = None
    children: list[int] = field(default_factory=list)


def lifts(vectors: np.ndarray, longest: float) -> np.ndarray:
    return np.sqrt(np.maximum(longest - (vectors * vectors).sum(axis=1), 0))


def _distances(vectors: np.ndarray, lift: np.ndarray, pivot: np.ndarray, pivot_lift: float) -> np.ndarray:
    apart = vectors - pivot
    return np.sqrt((apart * apart).sum(axis=1) + (lift - pivot_lift) ** 2)


def build(ids: np.ndarray, vectors: np.ndarray, longest: float, page: int = PAGE, fan: int = CHILDREN) -> list[Page]:
    """The pages of a tree, parents before children; vectors that are all equal are dealt out by id."""
    lift = lifts(vectors, longest)
    pages: list[Page] = []
    waiting = [(-1, np.argsort(ids, kind="stable"))]
    while waiting:
        parent, rows = waiting.pop()
        middle = vectors[rows].mean(axis=0)
        chosen = rows[np.argmin(((vectors[rows] - middle) ** 2).sum(axis=1))]
        away = _distances(vectors[rows], lift[rows], vectors[chosen], lift[chosen])
        above = pages[parent] if parent >= 0 else None
        to_parent = (
            float(_distances(vectors[[chosen]], lift[[chosen]], above.pivot, above.lift)[0]) if above else 0.0
        )
        number = len(pages)
        pages.append(
            Page(parent, vectors[chosen], float(lift[chosen]), float(away.max()), to_parent, int(ids[rows].min()))
        )
        if above:
            above.children.append(number)
        if len(rows) <= page:
            pages[number].ids, pages[number].vectors, pages[number].distances = ids[rows], vectors[rows], away
            continue
        for part in _parts(rows, vectors, lift, fan, page):
            waiting.append((number, part))
    return pages


def _parts(rows: np.ndarray, vectors: np.ndarray, lift: np.ndarray, fan: int, page: int) -> list[np.ndarray]:
    """Rows by the nearest of pivots far from each other; by order where that parts nothing."""
    fan = max(2, min(fan, -(-len(rows) // page)))
    nearest = np.zeros(len(rows), np.int64)
    least = _distances(vectors[rows], lift[rows], vectors[rows[0]], lift[rows[0]])
    for i in range(1, fan):
        pivot = rows[np.argmax(least)]
        away = _distances(vectors[rows], lift[rows], vectors[pivot], lift[pivot])
        nearer = away < least
        nearest[nearer], least[nearer] = i, away[nearer]
    parts = [rows[nearest == i] for i in range(fan)]
    parts = [p for p in parts if len(p)]
    return parts if len(parts) > 1 else np.array_split(rows, fan)


class Search:
    """The ``k`` best of a tree for one query: highest scores, of equal ones the smallest ids.

    Only what is better than ``bound``, a score and an id, is looked for. ``computed``
    counts distances and products.
    """

    def __init__(self, pages: list[Page], longest: float):
        self.pages, self.longest, self.computed = pages, longest, 0
        self.inner = {
            n: (
                np.array(p.children), np.stack([pages[c].pivot for c in p.children]),
                np.array([pages[c].radius for c in p.children]),
                np.array([pages[c].parent_distance for c in p.children]),
                np.array([pages[c].least_id for c in p.children]),
            )
            for n, p in enumerate(pages) if p.children
        }

    def top(self, query: np.ndarray, own: int, k: int, bound: tuple[float, int] = (-np.inf, 0)) -> list[tuple[int, int]]:
        # Scores are whole numbers, so half of one is far above any rounding of the bounds.
        space = float(query @ query) + self.longest
        best: list[tuple[int, int]] = []  # (-score, id), sorted
        worst, worst_id = bound

        def hopeless(distance, least_id):
            most = (space - np.square(np.maximum(distance, 0))) / 2
            return (most < worst - 0.5) | ((most < worst + 0.5) & (least_id > worst_id))

        root = self.pages[0]
        start = float(np.sqrt(max(space - 2 * float(query @ root.pivot), 0)))
        self.computed += 1
        queue = [(max(start - root.radius, 0.0), 0, start)]
        while queue:
            least, number, to_pivot = heapq.heappop(queue)
            page = self.pages[number]
            if hopeless(least, page.least_id):
                continue
            if page.ids is None:
                children, pivots, radii, apart, least_ids = self.inner[number]
                open_ = np.flatnonzero(~hopeless(np.abs(to_pivot - apart) - radii, least_ids))
                away = np.sqrt(np.maximum(space - 2 * (pivots[open_] @ query), 0))
                self.computed += len(open_)
                below = np.maximum(away - radii[open_], 0)
                for child, low, distance in zip(children[open_].tolist(), below.tolist(), away.tolist()):
                    heapq.heappush(queue, (low, child, distance))
                continue
            open_ = np.flatnonzero(~hopeless(np.abs(to_pivot - page.distances), page.ids) & (page.ids != own))
            scores = page.vectors[open_] @ query
            self.computed += len(open_)
            found = np.flatnonzero((scores > worst) | ((scores == worst) & (page.ids[open_] < worst_id)))
            if not len(found):
                continue
            new = list(zip((-scores[found]).astype(np.int64).tolist(), page.ids[open_][found].tolist()))
            best = heapq.nsmallest(k, best + new)
            if len(best) == k and (-best[-1][0], -best[-1][1]) > (worst, -worst_id):
                worst, worst_id = -best[-1][0], best[-1][1]
        return [(-score, i) for score, i in best]


def _page_row(tree: int, number: int, page: Page) -> tuple:
    packed = (x.tobytes() if x is not None else None for x in (page.ids, page.vectors, page.distances))
    return (
        tree, number, page.parent, page.ids is not None, page.pivot.tobytes(), page.lift, page.radius,
        page.parent_distance, page.least_id, *packed,
    )


def _load(rows: pd.DataFrame) -> list[Page]:
    pages: list[Page] = []
    for r in rows.sort_values("page").itertuples():
        pivot = np.frombuffer(r.pivot)
        page = Page(r.parent, pivot, r.lift, r.radius, r.parent_distance, r.least_id)
        if r.leaf:
            page.ids, page.distances = np.frombuffer(r.ids, np.int64), np.frombuffer(r.distances)
            page.vectors = np.frombuffer(r.vectors).reshape(len(page.ids), len(pivot))
        pages.append(page)
        if r.parent >= 0:
            pages[r.parent].children.append(len(pages) - 1)
    return pages


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(column), width))
    for i, x in enumerate(column):
        out[i, : min(len(x), width)] = x[:width]
    return out


@dataclass
class Index:
    """``pages`` of all trees; ``roots`` of each region; the regions' pivots; the space's constants."""

    pages: DataFrame
    roots: DataFrame
    pivots: np.ndarray
    width: int
    longest: float


def _nearest(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return ((pivots * pivots).sum(axis=1) - 2 * (vectors @ pivots.T)).argmin(axis=1)


def _packed(rows: DataFrame, vector: str, *others: str) -> DataFrame:
    """(region, packed): what a region's vectors are dealt by, in one row; as many as a region has trees."""
    return rows.groupBy("region").agg(F.sort_array(F.collect_list(F.struct(vector, *others))).alias("packed"))


def _dealt_within(rows: DataFrame, packed: DataFrame, choose, schema: str) -> DataFrame:
    """``choose(rows, packed)`` for the rows of each region, in shares of bounded size."""
    sizes = rows.groupBy("region").agg(F.ceil(F.count(F.lit(1)) / DEALT).alias("shares"))
    shared = rows.join(sizes, "region").withColumn("share", F.pmod(F.monotonically_increasing_id(), F.col("shares"))).drop("shares")
    each = packed.join(sizes, "region").withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1))).drop("shares")

    def deal(rows: pd.DataFrame, packed: pd.DataFrame) -> pd.DataFrame:
        return choose(rows, packed["packed"].iloc[0]) if len(rows) and len(packed) else pd.DataFrame()

    keys = ["region", "share"]
    return shared.groupBy(*keys).cogroup(each.groupBy(*keys)).applyInPandas(deal, schema)


def build_index(vectors: DataFrame, tree_rows: int = TREE_ROWS, page: int = PAGE, fan: int = CHILDREN) -> Index | None:
    """Index rows (id BIGINT, vector ARRAY of whole numbers); None without rows.

    Null ids and vectors that are null or hold null or non-finite components take no part.
    Shorter vectors are filled up with zeros. Scores must stay below 2^52.
    """
    rows = _usable(vectors)
    square = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    total, width, longest = rows.agg(F.count(F.lit(1)), F.max(F.size("vector")), F.max(square)).first()
    if not total:
        return None
    width = max(width, 1)
    regions = isqrt(-(-total // tree_rows) - 1) + 1  # the root of the trees' number, rounded up
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(regions).collect()
    pivots = np.unique(_matrix(pd.Series([r.vector for r in sample]), width), axis=0)

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield batch.assign(region=_nearest(_matrix(batch["vector"], width), pivots).astype(np.int32))

    def choose(rows: pd.DataFrame, packed: list) -> pd.DataFrame:
        own = _matrix(pd.Series([p["vector"] for p in packed]), width)
        near = _nearest(_matrix(rows["vector"], width), own)
        return rows[["id", "vector", "region"]].assign(part=near.astype(np.int32))

    dealt = keep(rows.mapInPandas(deal, "id BIGINT, vector ARRAY<DOUBLE>, region INT"), "dealt")
    # A region's own pivots: one in ``tree_rows`` of its rows by hash, at least that which hashes lowest, and no more than some
    # times the number of regions, which a row holds.
    of_region = dealt.groupBy("region").agg(F.count(F.lit(1)).alias("size"), F.min(F.struct(F.xxhash64("id"), "id"))["id"].alias("first"))
    share = F.least(F.lit(1.0 / tree_rows), F.lit(max(64, 4 * regions)) / F.col("size"))
    fate = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = dealt.join(F.broadcast(of_region), "region").where((fate < share) | (F.col("id") == F.col("first")))  # a row per region
    own_pivots = keep(_packed(chosen.select("region", "vector").distinct(), "vector"), "pivots")
    placed = keep(_dealt_within(dealt, own_pivots, choose, "id BIGINT, vector ARRAY<DOUBLE>, region INT, part INT"), "placed")
    # What lies around one pivot is as many trees as it needs, also where all its vectors are equal.
    sizes = placed.groupBy("region", "part").agg(F.ceil(F.count(F.lit(1)) / tree_rows).alias("pieces"))
    piece = F.pmod(F.monotonically_increasing_id(), F.col("pieces"))
    tree = F.shiftleft(F.col("region").cast("long"), REGION_AT) + F.shiftleft(F.col("part").cast("long"), PART_AT) + piece

    def pages(group: pd.DataFrame) -> pd.DataFrame:
        found = build(group["id"].to_numpy(np.int64), _matrix(group["vector"], width), longest, page, fan)
        number = int(group["tree"].iloc[0])
        return pd.DataFrame(
            [_page_row(number, i, p) for i, p in enumerate(found)], columns=[c.split()[0] for c in PAGES.split(", ")]
        )

    in_trees = placed.join(sizes, ["region", "part"]).select("id", "vector", tree.alias("tree"))
    built = keep(in_trees.groupBy("tree").applyInPandas(pages, PAGES), "mtree")
    # One tree of each part: others of the same part lie in the same place.
    first = (F.col("parent") < 0) & (F.col("tree").bitwiseAND((1 << PART_AT) - 1) == 0)
    roots = built.where(first).select(F.shiftright("tree", REGION_AT).cast("int").alias("region"), "tree", "pivot")
    return Index(built, keep(_packed(roots, "tree", "pivot"), "roots"), pivots, width, float(longest))


def _usable(vectors: DataFrame) -> DataFrame:
    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    return vectors.select(F.col("id").cast("long").alias("id"), F.col("vector").cast("array<double>").alias("vector")).where(
        F.col("id").isNotNull() & F.col("vector").isNotNull() & F.forall("vector", finite)
    )


def top_k(index: Index | None, queries: DataFrame, k: int) -> DataFrame:
    """The ``k`` best stored rows for every row of queries (id, vector): query_id, rank, id, score.

    Score: the inner product. Stored rows with the query's id are its own and left out;
    of equal scores the smaller id comes first. All rows are given when there are fewer.
    Repeated stored rows are candidates each, a repeated query is answered each time.
    Queries with unusable vectors have no rows, nor has any when nothing is stored.
    """
    spark = queries.sparkSession
    if index is None:
        return spark.createDataFrame([], "query_id BIGINT, rank INT, id BIGINT, score BIGINT")
    width, longest = index.width, index.longest
    asked = keep(_usable(queries).withColumn("query", F.monotonically_increasing_id()), "queries")
    frame = "tree BIGINT, query BIGINT, own BIGINT, vector ARRAY<DOUBLE>, worst DOUBLE, worst_id BIGINT"

    pivots = index.pivots

    def go_home(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                region = (_matrix(b["vector"], width) @ pivots.T).argmax(axis=1).astype(np.int32)
                yield pd.DataFrame({"query": b["query"], "own": b["id"], "vector": b["vector"], "region": region})

    def choose(rows: pd.DataFrame, packed: list) -> pd.DataFrame:
        roots = np.stack([np.frombuffer(p["pivot"]) for p in packed])
        best = (_matrix(rows["vector"], width) @ roots.T).argmax(axis=1)
        trees = np.array([p["tree"] for p in packed])
        return rows[["query", "own", "vector"]].assign(tree=trees[best], worst=-np.inf, worst_id=0)[names]

    names = [c.split()[0] for c in frame.split(", ")]
    regional = keep(asked.mapInPandas(go_home, "query BIGINT, own BIGINT, vector ARRAY<DOUBLE>, region INT"), "regional")
    home = keep(_dealt_within(regional, index.roots, choose, frame), "home")
    first = keep(_searched(index, home, k), "first-found")

    by_score = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    last = first.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") == k)
    bounds = home.select("query", "own", "vector", F.col("tree").alias("home")).join(
        last.select("query", F.col("score").cast("double").alias("worst"), F.col("id").alias("worst_id")), "query", "left"
    )
    rest = keep(_promising(index, bounds), "promising")
    found = first.unionByName(_searched(index, rest.join(home.select("query", "own", "vector"), "query").select(names), k))
    ranked = found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
    return ranked.join(asked.select("query", F.col("id").alias("query_id")), "query").select(
        "query_id", F.col("rank").cast("int").alias("rank"), "id", "score"
    )


def _searched(index: Index, work: DataFrame, k: int) -> DataFrame:
    """Answers of (tree, query) pairs, in groups of one tree and a bounded number of queries."""
    longest, width = index.longest, index.width
    shares = work.groupBy("tree").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("shares"))
    asked = work.join(shares, "tree").withColumn("share", F.pmod(F.xxhash64("query"), F.col("shares"))).drop("shares")
    pages = index.pages.join(shares, "tree").withColumn(
        "share", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares").cast("long") - 1))
    ).drop("shares")

    def search(pages: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(pages) and len(queries):
            tree = Search(_load(pages), longest)
            vectors = _matrix(queries["vector"], width)
            worst = zip(queries["worst"].tolist(), queries["worst_id"].tolist())
            for query, own, vector, bound in zip(queries["query"].tolist(), queries["own"].tolist(), vectors, worst):
                out += [(query, i, score) for score, i in tree.top(vector, own, k, bound)]
        return pd.DataFrame(out, columns=["query", "id", "score"]).astype("int64")

    keys = ["tree", "share"]
    return pages.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(search, FOUND)


def _promising(index: Index, bounds: DataFrame) -> DataFrame:
    """(tree, query, worst, worst_id): the other trees whose root does not rule out something better, block by block."""
    longest, width = index.longest, index.width
    roots = index.pages.where("parent < 0").select("tree", "pivot", "radius", "least_id")
    n_blocks = -(-roots.count() // BLOCK)
    root_blocks = roots.groupBy(F.pmod(F.xxhash64("tree"), F.lit(n_blocks)).alias("root_block")).agg(
        F.collect_list(F.struct("tree", "pivot", "radius", "least_id")).alias("roots")
    )
    n_shares = -(-bounds.count() // BLOCK) or 1
    blocks = (
        bounds.groupBy(F.pmod(F.xxhash64("query"), F.lit(n_shares)).alias("share"))
        .agg(F.collect_list(F.struct("query", "vector", "home", "worst", "worst_id")).alias("queries"))
        .withColumn("root_block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))))
    )

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for roots, queries in zip(batch["roots"], batch["queries"]):
                pivots = np.stack([np.frombuffer(r["pivot"]) for r in roots])
                radii = np.array([r["radius"] for r in roots])
                trees = np.array([r["tree"] for r in roots])
                least = np.array([r["least_id"] for r in roots])
                vectors = _matrix(pd.Series([q["vector"] for q in queries]), width)
                worst = np.array([-np.inf if q["worst"] is None else q["worst"] for q in queries])
                worst_id = np.array([0 if q["worst_id"] is None else q["worst_id"] for q in queries])
                home = np.array([q["home"] for q in queries])
                space = (vectors * vectors).sum(axis=1)[:, None] + longest
                near = np.sqrt(np.maximum(space - 2 * (vectors @ pivots.T), 0)) - radii
                most = (space - np.square(np.maximum(near, 0))) / 2
                ruled_out = (most < worst[:, None] - 0.5) | (
                    (most < worst[:, None] + 0.5) & (least[None, :] > worst_id[:, None])
                )
                for i, j in zip(*np.nonzero(~ruled_out & (trees[None, :] != home[:, None]))):
                    open_pairs.append((trees[j], queries[i]["query"], worst[i], worst_id[i]))
                    if len(open_pairs) >= BLOCK:
                        yield pd.DataFrame(open_pairs, columns=names)
                        open_pairs.clear()
                yield pd.DataFrame(open_pairs, columns=names)
                open_pairs.clear()

    names = ["tree", "query", "worst", "worst_id"]
    open_pairs: list[tuple] = []
    found = "tree BIGINT, query BIGINT, worst DOUBLE, worst_id BIGINT"
    return blocks.join(root_blocks, "root_block").select("roots", "queries").mapInPandas(compare, found)
