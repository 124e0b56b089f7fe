"""Document quality by nearest-neighbour voting among labelled latent-semantic vectors.

A text becomes a weighted bag of hashed terms: its words, the shapes its characters form
(three runs of letters, digits, blanks or one mark each), how often a word follows itself,
and its length. A truncated singular value decomposition of labelled texts turns bags into
short unit vectors. The labelled vectors, a bounded number, are sent to every task; each
document is compared with all of them by exact products of blocks, and its nearest ones
vote with their similarity as weight.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlake.llm.batches import chunks, forget
from airlake.llm.prefilter import among_the_lowest, hash_order
from airlake.llm.words import mix, word_hashes

#: The most labelled rows that are learned from; the model's size depends on nothing else.
LABELLED_ROWS = 4096
DIMENSIONS = 64
NEIGHBOURS = 96
THRESHOLD = 0.7

WORD_BUCKETS = SHAPE_BUCKETS = 4096
LENGTHS, REPEATS = 24, 24
FEATURES = WORD_BUCKETS + SHAPE_BUCKETS + LENGTHS + REPEATS
#: Similarities that differ by less are equal; products round in single precision.
TIED = 1e-6
#: Documents in a block of products.
BLOCK = 128

# Classes of bytes: 1 lower case and beyond ASCII, 2 upper case, 3 digits, 4 blanks, 5 line feeds, others themselves.
KIND = np.arange(256, dtype=np.int64)
for _kind, _bytes in (
    (1, [*range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]), (2, range(ord("A"), ord("Z") + 1)),
    (3, range(ord("0"), ord("9") + 1)), (4, b" \t\r\x0b\x0c"), (5, b"\n"),
):
    KIND[list(_bytes)] = _kind


def _counted(buckets: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray]:
    ids, counts = np.unique(buckets, return_counts=True)
    return ids + first, np.log1p(counts)


def bag(text: bytes, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Term numbers and weights of a text and the hashes of its words."""
    kinds = KIND[np.frombuffer(text, np.uint8)]
    if len(kinds):
        kinds = kinds[np.concatenate([[True], kinds[1:] != kinds[:-1]])]
    shapes = kinds[:-2] * 65536 + kinds[1:-1] * 256 + kinds[2:]
    hashed = (mix(shapes.astype(np.uint64) + np.uint64(1)) % np.uint64(SHAPE_BUCKETS)).astype(np.int64)
    terms = [
        _counted((words % np.uint64(WORD_BUCKETS)).astype(np.int64), 0),
        _counted(hashed, WORD_BUCKETS),
    ]
    length = min(LENGTHS - 1, len(words).bit_length())
    repeats = float((words[1:] == words[:-1]).mean()) if len(words) > 1 else 0.0
    levels = np.arange(int(repeats * (REPEATS - 1) + 0.5) + 1)
    terms.append((np.array([WORD_BUCKETS + SHAPE_BUCKETS + length]), np.array([2.0])))
    terms.append((WORD_BUCKETS + SHAPE_BUCKETS + LENGTHS + levels, np.full(len(levels), 2.0)))
    # Words and shapes weigh the same in all, however many there are.
    scaled = [(ids, w / (np.linalg.norm(w) or 1)) for ids, w in terms]
    return np.concatenate([t[0] for t in scaled]), np.concatenate([t[1] for t in scaled])


def bags(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    words, bounds = word_hashes(texts)
    for row, text in enumerate(texts):
        yield bag(text, words[bounds[row] : bounds[row + 1]])


@dataclass
class QualityModel:
    """``terms`` maps bags to vectors, ``vectors`` and ``labels`` are the labelled documents'."""

    terms: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float
    neighbours: int = NEIGHBOURS

    def vector(self, ids: np.ndarray, weights: np.ndarray) -> np.ndarray:
        return weights.astype(np.float32) @ self.terms[ids]

    def scores(self, vectors: np.ndarray) -> np.ndarray:
        """Per row the share of similarity that speaks for label 1."""
        out = np.full(len(vectors), self.prior)
        near = min(self.neighbours, len(self.labels))
        if not near:
            return out
        lengths = np.linalg.norm(vectors, axis=1, keepdims=True)
        vectors = vectors / np.where(lengths > 0, lengths, 1)
        for at in range(0, len(vectors), BLOCK):
            cosines = vectors[at : at + BLOCK] @ self.vectors.T
            if near < len(self.labels):
                # All that are as near as the last one vote too, so ties need no order.
                least = -np.partition(-cosines, near - 1, axis=1)[:, near - 1 : near]
                cosines = np.where(cosines >= least - TIED, cosines, 0)
            votes = np.maximum(cosines, 0).astype(np.float64) ** 4
            total = votes.sum(axis=1)
            said = votes @ self.labels
            out[at : at + BLOCK] = np.where(total > 0, said / np.where(total > 0, total, 1), self.prior)
        return np.clip(out, 0, 1)


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: list[int], dimensions: int = DIMENSIONS) -> QualityModel:
    """Learn from bags and labels. Without rows every score is 1: nothing speaks against a text."""
    if not rows:
        return QualityModel(np.zeros((FEATURES, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0), 1.0)
    matrix = np.zeros((len(rows), FEATURES), np.float32)
    held = np.zeros(FEATURES, np.int64)
    for i, (ids, weights) in enumerate(rows):
        matrix[i, ids] = weights
        held += matrix[i] > 0
    rarity = np.log((1 + len(rows)) / (1 + held)).astype(np.float32) + np.float32(0.1)
    matrix *= rarity
    # Subspace iteration with a fixed start finds the leading right singular vectors.
    rank = min(dimensions, len(rows))
    basis = np.random.default_rng(0).standard_normal((FEATURES, min(rank + 16, len(rows))), np.float32)
    for _ in range(4):
        basis, _ = np.linalg.qr(matrix.T @ (matrix @ basis))
    _, sizes, right = np.linalg.svd(matrix @ basis, full_matrices=False)
    terms = (basis @ right.T[:, :rank]) * rarity[:, None]
    vectors = np.stack([weights.astype(np.float32) @ terms[ids] for ids, weights in rows])
    lengths = np.linalg.norm(vectors, axis=1, keepdims=True)
    labels = np.array(labels, float)
    return QualityModel(terms, vectors / np.where(lengths > 0, lengths, 1), labels, float(labels.mean()))


def _utf8(batch: pa.RecordBatch) -> list[bytes]:
    """The texts, a null one empty."""
    return [t if t is not None else b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]


def _bag_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forget()
    for whole in batches:
        for batch in chunks(whole, "text"):
            found = list(bags(_utf8(batch)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("label"), pa.array([ids.tolist() for ids, _ in found], pa.list_(pa.int32())),
                    pa.array([w.tolist() for _, w in found], pa.list_(pa.float64())),
                ],
                names=["label", "ids", "weights"],
            )


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
    most_rows: int = LABELLED_ROWS,
) -> QualityModel:
    """Fit on at most ``most_rows`` documents, those of the labelled ids that hash lowest.

    Rows with a null id, label or text are left out; labels are 0 or 1, and of several for
    one id the largest counts; of several texts for one id the one that hashes lowest.
    """
    known = labels.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{label_column}`").cast("int").alias("label"))
    known = known.where("id IS NOT NULL AND label IS NOT NULL").groupBy("id").agg(F.max("label").alias("label"))
    share = min(1.0, 4 * most_rows / max(1, known.count()))
    lowest = known.where(among_the_lowest(F.col("id"), share))
    sample = lowest.orderBy(hash_order(F.col("id")), "id").limit(most_rows)
    chosen = (
        docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").cast("string").alias("text"))
        .where("text IS NOT NULL")
        .join(F.broadcast(sample), "id")  # most_rows ids and labels
        .groupBy("id", "label")
        .agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
        .select("label", "text")
        .mapInArrow(_bag_rows, "label INT, ids ARRAY<INT>, weights ARRAY<DOUBLE>")
        .toArrow()
    )
    found = _in_order(chosen)
    del chosen
    return fit([(ids, weights) for ids, weights, _ in found], [label for _, _, label in found])


def _in_order(chosen: pa.Table) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """Bags and labels as arrays, in the order of their term numbers, weights and label.

    No weight is negative, so numbers and weights are in the order of their big-endian bytes.
    """
    found = []
    for batch in chosen.to_batches():
        bounds = batch.column("ids").offsets.to_numpy().tolist()
        ids = batch.column("ids").values.to_numpy(zero_copy_only=False)
        weights = batch.column("weights").values.to_numpy(zero_copy_only=False)
        starts = batch.column("weights").offsets.to_numpy().tolist()
        for row, label in enumerate(batch.column("label").to_pylist()):
            own = ids[bounds[row] : bounds[row + 1]].astype(np.int64), weights[starts[row] : starts[row + 1]].copy()
            found.append((*own, label))
    found.sort(key=lambda bag: (bag[0].astype(">u4").tobytes(), bag[1].astype(">f8").tobytes(), bag[2]))
    return found


def score_quality(docs: DataFrame, model: QualityModel, text_column: str = "text") -> DataFrame:
    """Every document with its score.

    Columns: ``row``, a struct of all columns of ``docs``; ``score`` from 0 to 1, higher
    when label 1 is likelier. Whole texts are scored, a null text like an empty one;
    repeated rows and equal texts get one score. No rows give no rows.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # bounded by LABELLED_ROWS and FEATURES
    # A text goes to the worker once, in its row, unless it must be made a string first.
    inside = dict(docs.dtypes)[text_column] == "string"

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        model = shared.value
        for whole in batches:
            row = whole.column("row")
            text = pc.struct_field(row, docs_columns.index(text_column)) if inside else whole.column("text")
            for batch in chunks(pa.RecordBatch.from_arrays([row, text], names=["row", "text"]), "text"):
                vectors = np.stack([model.vector(*found) for found in bags(_utf8(batch))])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row"), pa.array(model.scores(vectors), pa.float64())], names=["row", "score"]
                )

    docs_columns = docs.columns
    text = [] if inside else [F.col(f"`{text_column}`").cast("string").alias("text")]
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs_columns)).alias("row"), *text)
    return rows.mapInArrow(score, f"row {rows.schema['row'].dataType.simpleString()}, score DOUBLE")
