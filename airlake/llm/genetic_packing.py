"""Training sequences by best fit, improved by a grouping genetic algorithm on islands.

Documents are never cut unless they are longer than a sequence; then all pieces but the first
are whole sequences. What is shorter is packed: these items are dealt evenly to islands
of bounded size. An island's individuals are whole packings, and what they pass on are
bins. A crossover injects well-filled bins of one packing into another, dissolves the bins that
hold a second copy of their documents, and places the displaced documents by best fit,
longest first. After every epoch the best-filled bins of an island's best packing migrate, as the
lengths in them, to the next island, which fills them with documents of its own and injects them.

Islands are rows; an epoch is one pass over them. An island is done when its packing has
no more bins than a lower bound.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from airlake.llm.batches import chunks
from airlake.llm.packing import TOGETHER, word_tokenizer
from airlake.scratch import keep, working_area

MAX_LENGTH = 1024
END_ID = 2
#: Items of an island, its individuals, children per epoch, and epochs at most.
ISLAND, INDIVIDUALS, CHILDREN, EPOCHS = 8192, 4, 48, 3
#: The share of a parent's better half of bins that a crossover injects, the worst bins it dissolves besides.
INJECTED, DISSOLVED = 0.1, 0.02
#: Bins that migrate.
MIGRANTS = 64
#: A row's key: its task and its place among the task's items.
PLACES = 40

PIECES = "id {id_type}, piece INT, start BIGINT, length BIGINT, ids BINARY, key BIGINT"
STATE = "island BIGINT, keys BINARY, lengths BINARY, genomes ARRAY<BINARY>, elite ARRAY<BINARY>, bins BIGINT, bound BIGINT"


class Bins:
    """Open bins by the room they have."""

    def __init__(self, longest: int, rooms: list[int]):
        self.longest, self.n, self.mask = longest, len(rooms), 0
        self.by_room: list[list[int]] = [[] for _ in range(longest + 1)]
        for bin_, room in enumerate(rooms):
            self._put(bin_, room)

    def _put(self, bin_: int, room: int) -> None:
        if room:
            self.by_room[room].append(bin_)
            self.mask |= 1 << room

    def place(self, length: int) -> int:
        """The fullest bin that has room, or a new one."""
        fitting = self.mask >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            bin_ = self.by_room[room].pop()
            if not self.by_room[room]:
                self.mask ^= 1 << room
        else:
            room, bin_ = self.longest, self.n
            self.n += 1
        self._put(bin_, room - length)
        return bin_


class Island:
    """Packings of the same items, longest first; a packing is every item's bin, numbered without gaps."""

    def __init__(self, lengths: np.ndarray, longest: int, random: np.random.Generator):
        self.lengths, self.longest, self.random = lengths.astype(np.int64), longest, random
        total = int(self.lengths.sum())
        #: No packing has fewer bins.
        self.bound = max(-(-total // longest), int((2 * self.lengths > longest).sum()))

    def best_fit(self, order: np.ndarray) -> np.ndarray:
        bins = Bins(self.longest, [])
        packing = np.empty(len(order), np.int64)
        packing[order] = [bins.place(length) for length in self.lengths[order].tolist()]
        return packing

    def first_packings(self, individuals: int) -> list[np.ndarray]:
        """Best fit of the items, longest first, and of slightly disturbed orders."""
        falling = np.arange(len(self.lengths))
        orders = [falling] + [
            np.argsort(-self.lengths * self.random.uniform(0.9, 1.0, len(falling)), kind="stable") for _ in range(individuals - 1)
        ]
        return [self.best_fit(order) for order in orders]

    def fills(self, packing: np.ndarray) -> np.ndarray:
        return np.bincount(packing, self.lengths).astype(np.int64)

    def worth(self, packing: np.ndarray) -> tuple[int, int]:
        """Fewer bins first, then bins of unequal fills: what is left in few bins is easier to place."""
        fills = self.fills(packing)
        return -len(fills), int((fills * fills).sum())

    def inject(self, packing: np.ndarray, items: np.ndarray, bins: np.ndarray) -> np.ndarray:
        """``packing`` with these items in bins of their own, and what that displaces placed by best fit."""
        injected = np.zeros(len(packing), bool)
        injected[items] = True
        fills = self.fills(packing)
        dissolved = np.zeros(len(fills), bool)
        dissolved[packing[items]] = True
        worst = np.argsort(fills + self.random.integers(0, self.longest // 8 + 1, len(fills)))
        dissolved[worst[: max(1, int(DISSOLVED * len(fills)))]] = True
        stay = ~dissolved[packing]
        stay[items] = False
        child = np.full(len(packing), -1, np.int64)
        numbers, child[stay] = np.unique(packing[stay], return_inverse=True)
        names, own = np.unique(bins, return_inverse=True)
        child[items] = len(numbers) + own
        placed = child >= 0
        rooms = self.longest - np.bincount(child[placed], self.lengths[placed], len(numbers) + len(names)).astype(np.int64)
        open_bins = Bins(self.longest, rooms.tolist())
        displaced = np.flatnonzero(~placed)  # in order: longest first
        child[displaced] = [open_bins.place(length) for length in self.lengths[displaced].tolist()]
        return child

    def crossover(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``a`` with some of the fuller bins of ``b``."""
        fills = self.fills(b)
        better = np.flatnonzero(fills >= np.median(fills))
        taken = np.zeros(len(fills), bool)
        taken[self.random.choice(better, max(1, int(INJECTED * len(better))), replace=False)] = True
        items = np.flatnonzero(taken[b])
        return self.inject(a, items, b[items])

    def elite(self, packing: np.ndarray) -> list[bytes]:
        """The lengths in the fullest bins."""
        fullest = np.argsort(-self.fills(packing), kind="stable")[:MIGRANTS]
        order = np.argsort(packing, kind="stable")
        edges = np.searchsorted(packing[order], [fullest, fullest + 1])
        return [self.lengths[order[i:j]].astype("<i4").tobytes() for i, j in edges.T.tolist()]

    def settle(self, packing: np.ndarray, patterns: list[bytes]) -> np.ndarray:
        """``packing`` with bins of such lengths, as far as own items have them."""
        items, bins = [], []
        next_of: dict[int, int] = {}
        for name, pattern in enumerate(patterns):
            wanted, taken = np.frombuffer(pattern, "<i4").tolist(), []
            for length in wanted:
                # Items are ordered by falling length.
                at = next_of.get(length)
                if at is None:
                    at = int(np.searchsorted(-self.lengths, -length))
                if at >= len(self.lengths) or self.lengths[at] != length:
                    break
                taken.append(at)
                next_of[length] = at + 1
            if len(taken) == len(wanted):
                items += taken
                bins += [name] * len(taken)
        return self.inject(packing, np.array(items, np.int64), np.array(bins, np.int64)) if items else packing

    def evolve(self, packings: list[np.ndarray], migrants: list[bytes], children: int) -> list[np.ndarray]:
        """As many packings, the best first."""
        size = len(packings)
        packings = sorted(packings, key=self.worth, reverse=True)
        if migrants and -self.worth(packings[0])[0] > self.bound:
            packings.append(self.settle(packings[0], migrants))
        for _ in range(children):
            packings = sorted(packings, key=self.worth, reverse=True)[:size]
            if -self.worth(packings[0])[0] <= self.bound:
                break
            # The better of two as receiver, any other as giver.
            a = int(self.random.integers(0, size, 2).min())
            b = (a + int(self.random.integers(1, max(size, 2)))) % size
            packings.append(self.crossover(packings[a], packings[b]))
        return sorted(packings, key=self.worth, reverse=True)[:size]


def _cut(docs: DataFrame, tokenizer: str, longest: int, end_id: int) -> DataFrame:
    """All pieces; those below ``longest`` have a key."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end = word_tokenizer(tokenizer), end_id.to_bytes(4, "little")
        context = TaskContext.get()
        key = (context.partitionId() if context else 0) << PLACES
        for whole in batches:
            for batch in chunks(whole, "text", TOGETHER):
                ids, bounds = words.encode_batch(batch.column("text"), end)
                totals = np.diff(bounds)
                count = -(-totals // longest)
                row = np.repeat(np.arange(len(totals)), count)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                first = totals - (count - 1) * longest
                lengths = np.where(piece == 0, first[row], longest)
                starts = np.where(piece == 0, 0, first[row] + (piece - 1) * longest)
                edges = np.concatenate([[0], 4 * np.cumsum(lengths)]).astype(np.int32)
                item = lengths < longest
                keys = key + np.cumsum(item) - 1
                key += int(item.sum())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(starts), pa.array(lengths),
                        pa.BinaryArray.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(edges), pa.py_buffer(ids)]),
                        pa.array(keys, mask=~item),
                    ],
                    names=["id", "piece", "start", "length", "ids", "key"],
                )

    return docs.mapInArrow(cut, PIECES.format(id_type=dict(docs.dtypes)["id"]))


SCHEMA = pa.schema([
    ("island", pa.int64()), ("keys", pa.binary()), ("lengths", pa.binary()), ("genomes", pa.list_(pa.binary())),
    ("elite", pa.list_(pa.binary())), ("bins", pa.int64()), ("bound", pa.int64()),
])


def _epoch(states: DataFrame, number: int, longest: int, individuals: int, children: int) -> DataFrame:
    """Every island's next state; ``states`` also have ``migrants``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for state in batch.to_pylist():
                lengths = np.frombuffer(state["lengths"], "<i4")
                island = Island(lengths, longest, np.random.default_rng([state["island"], number]))
                packings = [np.frombuffer(g, "<i4").astype(np.int64) for g in state["genomes"]] or island.first_packings(individuals)
                packings = island.evolve(packings, state["migrants"] or [], children)
                state |= {
                    "genomes": [p.astype("<i4").tobytes() for p in packings], "elite": island.elite(packings[0]),
                    "bins": int(packings[0].max()) + 1, "bound": island.bound,
                }
                state.pop("migrants")
                yield pa.RecordBatch.from_pylist([state], schema=SCHEMA)

    return states.mapInArrow(run, STATE)


def _dealt(items: DataFrame, islands: int) -> DataFrame:
    """Islands without packings: their items, longest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys, lengths = np.array(row["keys"], np.int64), np.array(row["lengths"], np.int64)
                order = np.lexsort((keys, -lengths))
                state = {
                    "island": row["island"], "keys": keys[order].astype("<i8").tobytes(), "lengths": lengths[order].astype("<i4").tobytes(),
                    "genomes": [], "elite": [], "bins": None, "bound": None,
                }
                yield pa.RecordBatch.from_pylist([state], schema=SCHEMA)

    # Every task deals its items out one by one, each task beginning elsewhere.
    task, place = F.shiftright("key", PLACES), F.col("key").bitwiseAND((1 << PLACES) - 1)
    island = F.pmod(F.pmod(F.xxhash64(task), F.lit(1 << 40)) + place, F.lit(islands))
    dealt = items.select(island.alias("island"), "key", "length").groupBy("island")
    both = dealt.agg(F.collect_list(F.struct("key", "length")).alias("items"))
    return both.select("island", F.col("items.key").alias("keys"), F.col("items.length").alias("lengths")).mapInArrow(run, STATE)


def _places(states: DataFrame) -> DataFrame:
    """Each item's sequence and its place there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for state in batch.to_pylist():
                keys, lengths = np.frombuffer(state["keys"], "<i8"), np.frombuffer(state["lengths"], "<i4").astype(np.int64)
                packing = np.frombuffer(state["genome"], "<i4").astype(np.int64)
                order = np.argsort(packing, kind="stable")
                ends = np.cumsum(lengths[order])
                before = ends - lengths[order]
                first = np.searchsorted(packing[order], packing[order])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[order]), pa.array((state["island"] << 32) + packing[order]), pa.array(before - before[first])],
                    names=["key", "sequence_id", "offset"],
                )

    best = states.select("island", "keys", "lengths", F.element_at("genomes", 1).alias("genome"))
    return best.mapInArrow(run, "key BIGINT, sequence_id BIGINT, offset BIGINT")


def pack_best_fit(
    docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text_column: str = "text", longest: int = MAX_LENGTH,
    end_id: int = END_ID, island: int = ISLAND, individuals: int = INDIVIDUALS, children: int = CHILDREN, epochs: int = EPOCHS,
) -> DataFrame:
    """One row per piece: id, ``piece``, ``start``, ``length``, ``ids``, ``sequence_id``, ``offset``.

    ``ids`` are the piece's tokens as little-endian unsigned 32-bit numbers, ``start`` the
    document's tokens before it; ``offset`` is its place in the sequence, gapless from 0. A document of
    more than ``longest`` tokens has a shorter first piece, unless it is a multiple, and whole ones.

    Null and empty texts are a single ``end_id``. Repeated rows are packed each by itself; ids may
    be null. Other columns of ``docs`` are not read. No rows give no rows. Whole texts are
    tokenized. Sequences of different islands are not merged: each island may end with one ill-filled sequence.
    """
    spark = docs.sparkSession
    chosen = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").alias("text"))
    pieces = keep(_cut(chosen, tokenizer, longest, end_id), "pieces")
    items = pieces.where("key IS NOT NULL")
    islands = max(1, -(-items.count() // island))
    with working_area(spark) as area:
        states = area.keep(_dealt(items, islands), "islands")
        for number in range(epochs):
            visits = states.select(F.pmod(F.col("island") + 1, F.lit(islands)).alias("island"), F.col("elite").alias("migrants"))
            states = area.keep(_epoch(states.join(visits, "island", "left"), number, longest, individuals, children), "islands")
            if states.where("bins > bound").isEmpty():
                break
        places = keep(_places(states), "places")
    columns = [F.col("id").alias(id_column), "piece", "start", "length", "ids", "sequence_id", "offset"]
    packed = items.join(places, "key").select(columns)
    # Whole sequences are numbered below zero, apart from islands.
    alone = pieces.where("key IS NULL").withColumn("sequence_id", -1 - F.monotonically_increasing_id())
    return packed.unionByName(alone.withColumn("offset", F.lit(0).cast("long")).select(columns))
