"""Near duplicates by ProbMinHash, banding and verification.

A text is a weighted set of five-word shingles, a shingle's weight growing with how often
the text holds it. Each element sends arrivals of a Poisson process with its weight as
rate to random slots; a slot keeps the element that arrived first. Two texts agree in a
slot with a probability equal to their probability Jaccard similarity. Elements whose
next arrival comes after the latest first arrival of all slots can change nothing and are
left out, so most elements are looked at once.

Texts with equal shingles are one set from the start. Links are defined on distinct
shingles, whose weights are all one; there the probability Jaccard similarity is the plain
one. So every set has the bands of its unit weights, which any pair of the threshold shares
but for a known small chance, however often either text repeats its shingles. The weighted
bands of texts that repeat shingles come on top. Sets that agree in a band of slots are
candidates. Pairs within a band are never all listed:

1. Each set is compared with one leader per band, the member that shares most bands with
   others (in a group of edited copies, that is the text they were made from), and
   links of at least the threshold make classes.
2. In bands that still hold several classes, pairs across classes are found exactly by a
   prefix filter: sets of that similarity share one of their rarest shingles, early enough
   in both, and what many texts have in common is not among these.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airlake.graph import Graph
from airlake.graph.components import connected_components
from airlake.llm.batches import chunks
from airlake.llm.prefilter import may_match
from airlake.llm.words import mix, shingle_hashes, word_hashes
from airlake.scratch import keep

SHINGLE_WORDS = 5
THRESHOLD = 0.8
#: Two sets of plain Jaccard similarity 0.8 share no band of unit weights with a probability of 3e-5.
BANDS, ROWS = 20, 4


def weighted_shingles(words: np.ndarray, size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles and their weights, 1 + ln(occurrences)."""
    shingles, counts = np.unique(shingle_hashes(words, size), return_counts=True)
    return shingles, 1 + np.log(counts)


def prob_minhash(elements: np.ndarray, weights: np.ndarray, slots: int) -> np.ndarray:
    """The element that arrives first in each slot. ``elements`` are 64-bit hashes, at least one."""
    first = np.full(slots, np.inf)
    signature = np.zeros(slots, np.uint64)
    elements, scale = elements.copy(), 1 / weights
    reached = np.zeros(len(elements))
    # Enough arrivals at a time to fill all slots, most likely; then as many again, until nothing can change.
    many = max(1, math.ceil(slots * (math.log(slots) + 1) / len(elements)))
    turn = 0
    while len(elements):
        steps = np.arange(turn, turn + many, dtype=np.uint64)
        draws = mix(elements[:, None] + mix(steps + np.uint64(1))[None, :])
        gaps = -np.log(((draws >> np.uint64(12)).astype(np.float64) + 0.5) * 2.0**-52) * scale[:, None]
        times = reached[:, None] + np.cumsum(gaps, axis=1)
        in_time = times < first.max()
        when = times[in_time]
        where = (mix(draws[in_time]) % np.uint64(slots)).astype(np.int64)
        who = np.broadcast_to(elements[:, None], times.shape)[in_time]
        late_first = np.argsort(-when, kind="stable")
        when, where, who = when[late_first], where[late_first], who[late_first]
        arrived = np.full(slots, np.inf)
        arrived[where] = when  # of several, the last assignment stays: the earliest arrival
        by = np.zeros(slots, np.uint64)
        by[where] = who
        earlier = arrived < first
        first[earlier], signature[earlier] = arrived[earlier], by[earlier]
        alive = times[:, -1] < first.max()
        elements, scale, reached = elements[alive], scale[alive], times[alive, -1]
        turn += many
    return signature


def band_hashes(signature: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    out = mix(np.arange(1, bands + 1, dtype=np.uint64))
    for column in signature.reshape(bands, rows).T:
        out = mix(out ^ column)
    return out.view(np.int64)


def set_bands(shingles: np.ndarray, weights: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> tuple[np.ndarray, np.ndarray]:
    """The bands of the distinct shingles, and those of the weighted ones that are not among them."""
    unit = band_hashes(prob_minhash(shingles, np.ones(len(shingles)), bands * rows), bands, rows)
    if (weights == 1).all():
        return unit, np.empty(0, np.int64)
    return unit, np.setdiff1d(band_hashes(prob_minhash(shingles, weights, bands * rows), bands, rows), unit)


def _set_key(shingles: np.ndarray) -> tuple[int, int]:
    """Two 64-bit numbers that stand for a set of shingles."""
    signed = lambda x: int(x.astype(np.int64))
    spread = mix(shingles)
    return (
        signed(np.add.reduce(spread) + np.uint64(len(shingles))),
        signed(np.bitwise_xor.reduce(mix(spread + np.uint64(7)))),
    )


def _lists(values: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    flat = np.concatenate(values) if values else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))


def _word_sets(batch: pa.RecordBatch) -> Iterator[tuple[bytes, np.ndarray]]:
    texts = [t if t is not None else b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
    words, bounds = word_hashes(texts)
    for row, text in enumerate(texts):
        yield text, words[bounds[row] : bounds[row + 1]]


def _sketches(size: int, bands: int, rows: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in chunks(whole, "text"):
                keys, hashes, further = [], [], []
                for text, words in _word_sets(batch):
                    if len(words):
                        shingles, weights = weighted_shingles(words, size)
                        unit, weighted = set_bands(shingles, weights, bands, rows)
                        hashes.append(unit)
                        further.append(weighted)
                        keys.append(_set_key(shingles))
                    else:  # without a word: equal to equal texts only
                        hashes.append(np.empty(0, np.int64))
                        further.append(np.empty(0, np.int64))
                        keys.append(struct.unpack("<qq", xxhash.xxh3_128_digest(text)))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id"), batch.column("text_key"), pa.array([k[0] for k in keys], pa.int64()),
                        pa.array([k[1] for k in keys], pa.int64()), _lists(hashes), _lists(further),
                    ],
                    names=["id", "text_key", "k1", "k2", "bands", "weighted"],
                )

    return sketch


def _shingle_lists(size: int):
    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in chunks(whole, "text"):
                lists = [np.unique(shingle_hashes(words, size)) for _, words in _word_sets(batch) if len(words)]
                keys = [_set_key(shingles)[0] for shingles in lists]
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), _lists(lists)], names=["id", "shingles"])

    return shingle


def _similar(a: Column, b: Column, threshold: float) -> Column:
    """Whether two arrays of distinct shingles have that Jaccard similarity."""
    shared = F.size(F.array_intersect(a, b))
    return shared >= threshold * (F.size(a) + F.size(b) - shared) - 1e-9


def _linked(pairs: DataFrame, shingles: DataFrame, threshold: float) -> DataFrame:
    """The pairs (src, dst) that reach the threshold."""
    left = shingles.select(F.col("id").alias("src"), F.col("shingles").alias("left"))
    right = shingles.select(F.col("id").alias("dst"), F.col("shingles").alias("right"))
    return pairs.join(left, "src").join(right, "dst").where(_similar(F.col("left"), F.col("right"), threshold)).select("src", "dst")


def _leader_pairs(members: DataFrame) -> DataFrame:
    """Every member with its bands' leaders; members are rows (band, id, others)."""
    weight = members.groupBy("id").agg(F.sum("others").alias("weight"))
    leaders = (
        members.join(weight, "id")
        .groupBy("band")
        .agg(F.max(F.struct("weight", (-F.col("id")).alias("negative"))).alias("best"))
        .select("band", (-F.col("best.negative")).alias("dst"))
    )
    return members.join(leaders, "band").where("id <> dst").select(F.col("id").alias("src"), "dst").distinct()


def _classes(ids: DataFrame, links: DataFrame) -> DataFrame:
    """(id, component) of every id."""
    return connected_components(Graph(ids, links)).select("id", "component")


def _prefix_pairs(open_ids: DataFrame, shingles: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Pairs across classes that share one of their rarest shingles, hence all that can reach the threshold."""
    sets = shingles.join(open_ids, "id", "left_semi")
    each = sets.select("id", F.size("shingles").alias("size"), F.explode("shingles").alias("shingle"))
    frequency = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("texts"))
    ranked = each.join(frequency, "shingle").groupBy("id", "size").agg(
        F.sort_array(F.collect_list(F.struct("texts", "shingle"))).alias("ranked")
    )
    length = (F.col("size") - F.ceil(threshold * F.col("size") - 1e-9) + 1).cast("int")
    rare = (
        ranked.select("id", "size", F.posexplode(F.slice("ranked", F.lit(1), length)).alias("place", "r"))
        .where("r.texts > 1")
        .select("id", "size", (F.col("size") - F.col("place")).alias("left"), F.col("r.shingle").alias("shingle"))
        .join(classes, "id")
    )
    rare = keep(rare, "rare-shingles")
    # Per shingle only the classes beside the largest one look for partners.
    parts = rare.groupBy("shingle", "component").agg(F.count(F.lit(1)).alias("texts"))
    largest = (
        parts.groupBy("shingle")
        .agg(F.max_by("component", F.struct("texts", "component")).alias("largest"), F.count(F.lit(1)).alias("classes"))
        .where("classes > 1")
        .select("shingle", "largest")
    )
    met = rare.join(largest, "shingle")
    few = met.where("component <> largest").select("shingle", "id", "size", "left", "component")
    other = [F.col(c).alias(f"other_{c}") for c in ("id", "size", "left", "component")]
    # At the first shingle that two sets share, what is left of either bounds what they share.
    least_shared = threshold / (1 + threshold) * (F.col("size") + F.col("other_size")) - 1e-9
    return (
        few.join(met.select("shingle", *other), "shingle")
        .where((F.col("component") != F.col("other_component")) & (F.least("left", "other_left") >= least_shared))
        .select(F.greatest("id", "other_id").alias("src"), F.least("id", "other_id").alias("dst"))
        .distinct()
    )


def text_key(text: Column) -> Column:
    """128 bits, in hexadecimal digits, that stand for a text."""
    return F.md5(text.cast("string").cast("binary"))


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    threshold: float = THRESHOLD,
    size: int = SHINGLE_WORDS,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """One row per document: its id, ``class_id`` (the smallest id of its class), ``set_id``, ``component`` and ``text_key``.

    Documents are linked when the Jaccard similarity of their distinct ``size``-word
    shingles is at least ``threshold``; a class is what links connect. ``set_id`` is the
    smallest id among documents with the very same shingles. Ids are integers. Where rows
    with different texts share an id, classes may share a ``class_id``; ``component`` is a
    number that each class has for itself, and ``text_key`` (the function of that name)
    tells the rows of an id apart. Both are null for a null text or id.

    A text of fewer than ``size`` words is one shingle. Texts without a word, empty ones
    included, are duplicates only of equal texts. A null text or a null id takes no part:
    such a row is its own class (``class_id`` is its id). Repeated rows come back each,
    with one class. Other columns of ``docs`` are not read. No rows give no rows.
    """
    texts = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    present = texts.where("id IS NOT NULL AND text IS NOT NULL")
    sketches = keep(
        present.withColumn("text_key", text_key(F.col("text"))).mapInArrow(
            _sketches(size, bands, rows),
            "id BIGINT, text_key STRING, k1 BIGINT, k2 BIGINT, bands ARRAY<BIGINT>, weighted ARRAY<BIGINT>",
        ),
        "sketches",
    )
    sets = keep(
        sketches.groupBy("k1", "k2").agg(F.min("id").alias("set_id"), F.first("bands").alias("bands")), "shingle-sets"
    )
    # From here a set is known by k1: two members of shared bands meet in it by chance once in 2^64 pairs.
    # Unit weights give equal sets equal bands; their weighted bands differ and all count.
    weighted = sketches.where(F.size("weighted") > 0).select("k1", "k2", F.explode("weighted").alias("band")).distinct()
    each = sets.select("k1", "k2", "set_id", F.explode("bands").alias("band")).unionByName(
        weighted.join(sets.select("k1", "k2", "set_id"), ["k1", "k2"]).select("k1", "k2", "set_id", "band")
    ).withColumnRenamed("k1", "id")
    shared = each.groupBy("band").agg((F.count(F.lit(1)) - 1).alias("others")).where("others > 0")
    members = keep(each.join(shared, "band"), "band-members")
    pairs = keep(_leader_pairs(members), "leader-pairs")
    ids = members.select("id").distinct()
    set_ids = members.select(F.col("set_id").alias("id")).distinct()
    shingles = keep(
        may_match(present, set_ids, "id")
        .join(set_ids, "id", "left_semi")
        .mapInArrow(_shingle_lists(size), "id BIGINT, shingles ARRAY<BIGINT>")
        .join(ids, "id", "left_semi")
        .dropDuplicates(["id"]),
        "shingles",
    )
    links = keep(_linked(pairs, shingles, threshold), "links")
    classes = keep(_classes(ids, links), "classes")

    open_bands = (
        members.join(classes, "id")
        .groupBy("band")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low <> high")
    )
    open_ids = keep(members.join(open_bands, "band", "left_semi").select("id").distinct(), "open")
    if not open_ids.isEmpty():
        across = _prefix_pairs(open_ids, shingles, classes, threshold)
        more = keep(_linked(across, shingles, threshold), "links")
        if not more.isEmpty():
            classes = _classes(ids, links.unionByName(more))

    # Sets that are no member are known by both keys: one of them alone may be a member's by chance.
    of_members = members.select(F.col("id").alias("k1"), "k2").distinct().join(classes.withColumnRenamed("id", "k1"), "k1")
    of_sets = sets.join(of_members, ["k1", "k2"], "left").select(
        "k1", "k2", "set_id", F.coalesce("component", "k1").alias("component")
    )
    smallest = of_sets.groupBy("component").agg(F.min("set_id").alias("class_id"))
    of_sets = of_sets.join(smallest, "component")
    columns = ["id", "class_id", "set_id", "component", "text_key"]
    found = sketches.select("id", "text_key", "k1", "k2").join(of_sets, ["k1", "k2"]).select(columns)
    alone = texts.where("id IS NULL OR text IS NULL").select(
        "id", F.col("id").alias("class_id"), F.col("id").alias("set_id"),
        F.lit(None).cast("long").alias("component"), F.lit(None).cast("string").alias("text_key"),
    )
    return found.unionByName(alone).withColumnRenamed("id", id_column)
