"""Language identification by cross-parsing entropy.

For each language a suffix automaton holds every substring of some labelled text. A text
is parsed from left to right into the longest phrases the automaton knows; the better the
language fits, the longer they are. A language that needs c phrases for n characters and
learned from m characters gets the entropy estimate c * log2(m) / n, and the lowest wins.
Phrases end at the borders of blocks of ``BLOCK`` characters, which lets all blocks of a
batch be parsed side by side, one character of each at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airlake.llm.batches import chunks
from airlake.llm.prefilter import among_the_lowest, hash_order

#: Documents and characters that a language is learned from at most.
TEXTS_PER_LANGUAGE = 48
CHARS_PER_LANGUAGE = 24_000
#: The most frequent characters have a column in the tables; transitions by others are sorted pairs.
ALPHABET = 127
BLOCK = 512

UNKNOWN_LANGUAGE = "und"
LETTER = regex.compile(r"\p{L}")


def suffix_automaton(codes: np.ndarray, symbols: int) -> np.ndarray:
    """The transitions [state, symbol] of the automaton of all substrings; 0 where there is none.

    State 0 leads nowhere and state 1 is the start. ``codes`` are below ``symbols``.
    """
    return _split(_transitions(codes), symbols)[0]


def _transitions(codes: np.ndarray) -> list[dict[int, int]]:
    """Where each symbol leads from each state."""
    go: list[dict[int, int]] = [{}, {}]
    length, link = [0, 0], [0, 0]
    last = 1
    for c in codes.tolist():
        new = len(go)
        go.append({})
        length.append(length[last] + 1)
        link.append(1)
        p = last
        while p and c not in go[p]:
            go[p][c] = new
            p = link[p]
        if p:
            q = go[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(go)
                go.append(dict(go[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p and go[p].get(c) == q:
                    go[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return go


@dataclass
class Sparse:
    """Transitions by symbols without a column; ``pairs`` are state << 32 | symbol, in order."""

    pairs: np.ndarray
    to: np.ndarray

    def follow(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        if not len(self.pairs):
            return np.zeros(len(states), np.int64)
        wanted = states << 32 | symbols.astype(np.int64)
        at = np.minimum(np.searchsorted(self.pairs, wanted), len(self.pairs) - 1)
        return np.where(self.pairs[at] == wanted, self.to[at], 0)


def _split(go: list[dict[int, int]], symbols: int) -> tuple[np.ndarray, Sparse]:
    """A table of the transitions by symbols below ``symbols``, and the others."""
    table = np.zeros((len(go), symbols), np.uint16 if len(go) < 1 << 16 else np.uint32)
    others: list[tuple[int, int]] = []
    for state, edges in enumerate(go):
        for c, to in edges.items():
            if c < symbols:
                table[state, c] = to
            else:
                others.append((state << 32 | c, to))
    pairs = np.array(sorted(others), np.int64).reshape(-1, 2)
    return table, Sparse(pairs[:, 0].copy(), pairs[:, 1].copy())


@dataclass
class LanguageModel:
    """``codes`` gives a character's symbol by code point, 0 for unknown ones.

    Symbols from the tables' width on are in ``sparse`` only, one for each automaton.
    """

    languages: list[str]
    codes: np.ndarray
    automata: list[np.ndarray]
    sparse: list[Sparse]
    learned: list[int]

    def symbols(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        return self.codes[np.minimum(points, len(self.codes) - 1)]

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrases [text, language] that the parses of the texts' symbols have."""
        out = np.zeros((len(texts), len(self.languages)), np.int64)
        counts = [-(-len(t) // BLOCK) for t in texts]
        blocks = sum(counts)
        if not blocks:
            return out
        pad = self.automata[0].shape[1] - 1
        grid = np.full(blocks * BLOCK, pad, self.codes.dtype)
        at = 0
        for text, n in zip(texts, counts):
            grid[at : at + len(text)] = text
            at += n * BLOCK
        columns = np.ascontiguousarray(grid.reshape(blocks, BLOCK).T)
        rare = [np.flatnonzero(column > pad) for column in columns]
        near = columns
        if any(map(len, rare)):
            near = np.where(columns > pad, 0, columns)  # leads nowhere in the tables
        owner = np.repeat(np.arange(len(texts)), counts)
        for i, (table, sparse) in enumerate(zip(self.automata, self.sparse)):
            flat, width = table.ravel(), table.shape[1]
            start = table[1]
            state = np.ones(blocks, np.int64)
            ended = np.zeros(blocks, np.int64)
            for column, tabled, far in zip(columns, near, rare):
                following = flat[state * width + tabled].astype(np.int64)
                if len(far):
                    following[far] = sparse.follow(state[far], column[far])
                stop = np.flatnonzero(following == 0)
                # A phrase ends before this character, and the next one begins with it.
                again = start[tabled[stop]].astype(np.int64)
                if len(far):
                    beyond = column[stop] > pad
                    again[beyond] = sparse.follow(np.ones(beyond.sum(), np.int64), column[stop][beyond])
                ended[stop] += state[stop] != 1
                ended[stop] += (again == 0) & (column[stop] != pad)
                following[stop] = np.where(again == 0, 1, again)
                state = following
            ended += state != 1
            out[:, i] = np.bincount(owner, ended, len(texts)).astype(np.int64)
        return out

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Language and score of each text; the score is the winner's share of the inverse entropies."""
        symbols = [self.symbols(t or "") for t in texts]
        known = bool(self.languages)
        counts = self.phrases(symbols) if known else np.zeros((len(texts), 0))
        out = []
        for text, row, found in zip(texts, symbols, counts):
            if not known or not text or not LETTER.search(text):
                out.append((UNKNOWN_LANGUAGE, 0.0))
                continue
            entropy = found * np.log2(np.array(self.learned) + 1.0) / len(row)
            best = int(np.argmin(entropy))  # the first of equals, languages are sorted
            inverse = 1 / np.maximum(entropy, 1e-9)
            out.append((self.languages[best], float(inverse[best] / inverse.sum())))
        return out


def fit(texts: dict[str, str]) -> LanguageModel:
    """Learn from one text per language; languages without a character are left out."""
    texts = {k: texts[k] for k in sorted(texts) if texts[k]}
    joined = np.frombuffer("".join(texts.values()).encode("utf-32-le", "surrogatepass"), np.uint32)
    points, counts = np.unique(joined, return_counts=True)
    points = points[np.lexsort((points, -counts))]
    tabled = min(len(points), ALPHABET)
    symbols = np.arange(1, len(points) + 1)
    symbols[tabled:] += 1  # the number between is the padding's
    codes = np.zeros(int(points.max(initial=0)) + 2, np.uint8 if len(points) <= ALPHABET else np.uint32)
    codes[points] = symbols  # the last entry stands for all beyond
    model = LanguageModel(list(texts), codes, [], [], [len(t) for t in texts.values()])
    for text in texts.values():  # unknown characters and the padding match nothing
        table, sparse = _split(_transitions(model.symbols(text)), tabled + 2)
        model.automata.append(table)
        model.sparse.append(sparse)
    return model


def train(
    labelled: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    texts_per_language: int = TEXTS_PER_LANGUAGE,
    chars_per_language: int = CHARS_PER_LANGUAGE,
) -> LanguageModel:
    """Fit on the distinct texts of each language that hash lowest, whole or in pieces.

    Texts are taken until ``chars_per_language`` characters are reached. A text gives an
    equal part of these for ``texts_per_language`` texts at most, from a place that its hash
    chooses; a short one is whole, and the more texts follow. Where all texts of a language
    give too little in this way, longer pieces fill what is left. Rows with null text or
    language are left out; ``id_column`` is not read.
    """
    part = max(1, chars_per_language // texts_per_language)
    rows = labelled.select(
        F.col(f"`{lang_column}`").cast("string").alias("lang"), F.col(f"`{text_column}`").cast("string").alias("text")
    ).where("lang IS NOT NULL AND text <> '' AND lang <> 'und'")
    rows = rows.withColumn("key", F.xxhash64("text"))
    texts = rows.select("lang", "key", F.length("text").alias("chars")).groupBy("lang", "key").agg(F.min("chars").alias("chars"))
    given = F.least("chars", F.lit(part))
    # A row per language, of which there are as many automata.
    totals = texts.groupBy("lang").agg(F.sum(given).alias("total"))
    shares = totals.select("lang", "total", (F.lit(4.0 * chars_per_language) / F.col("total")).alias("share"))
    lowest = Window.partitionBy("lang").orderBy("order", "key").rowsBetween(Window.unboundedPreceding, -1)
    picked = (
        texts.join(F.broadcast(shares), "lang").where(among_the_lowest(F.col("key"), F.col("share")))
        .withColumn("order", hash_order(F.col("key")))
        .withColumn("before", F.coalesce(F.sum(given).over(lowest), F.lit(0)))
        .where(F.col("before") < chars_per_language)
        .select("lang", "key", "order", F.when(F.col("total") < chars_per_language, chars_per_language).otherwise(part).alias("most"))
    )
    # At most a row per character that is learned; few texts are longer than their part.
    spare = F.greatest(F.length("text") - F.col("most"), F.lit(0)) + 1
    place = (F.pmod(F.col("key"), spare.cast("long")) + 1).cast("int")
    chosen = (
        rows.join(F.broadcast(picked), ["lang", "key"])
        .select("lang", "order", "key", F.substring("text", place, F.col("most")).alias("text"))
        .groupBy("lang", "order", "key").agg(F.min("text").alias("text"))
        .collect()
    )
    pieces: dict[str, list[str]] = {}
    for row in sorted(chosen, key=lambda r: (r.lang, r.order, r.key)):
        pieces.setdefault(row.lang, []).append(row.text)
    return fit({k: _filled(v, part, chars_per_language) for k, v in pieces.items()})


def _filled(pieces: list[str], part: int, chars: int) -> str:
    """The pieces, cut to one length, the least from ``part`` on at which they fill ``chars``, if any does."""
    low, high = part, max(part, *map(len, pieces))
    while low < high:
        middle = (low + high) // 2
        if sum(min(len(p), middle) for p in pieces) >= chars:
            high = middle
        else:
            low = middle + 1
    # The line breaks that part the pieces are not counted.
    out, left = [], chars
    for piece in pieces:
        out.append(piece[: min(low, left)])
        left -= len(out[-1])
    return "\n".join(p for p in out if p)


def identify(docs: DataFrame, model: LanguageModel, text_column: str = "text") -> DataFrame:
    """Every document with its language.

    Columns: ``row``, a struct of all columns of ``docs``; ``lang_pred``, a learned
    language, or ``und`` if the text is null or has no letter or nothing was learned;
    ``score`` from 0 to 1. Whole texts are parsed; of equally good languages the first by
    name wins. Repeated rows and equal texts get one result, no rows give no rows.
    """
    # Bounded by the characters learned from, times the number of languages.
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for whole in batches:
            for batch in chunks(whole, "text"):
                found = model.predict(batch.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("row"), pa.array([f[0] for f in found], pa.string()),
                        pa.array([f[1] for f in found], pa.float64()),
                    ],
                    names=["row", "lang_pred", "score"],
                )

    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        F.col(f"`{text_column}`").cast("string").alias("text"),
    )
    return rows.mapInArrow(predict, f"row {rows.schema['row'].dataType.simpleString()}, lang_pred STRING, score DOUBLE")
