"""How far the sources of a language differ in their words, from count-level bitmaps.

The terms that enough documents of a language hold are numbered by falling frequency. For
every group (language, source) and every count that occurs there, the numbers of the terms
with that count are a bitset, stored as its non-zero 64-bit words. Two groups' joint cells
(terms counted a here and b there) are the set bits of the AND of two such words; a cell's
contribution is its size times f(a, b) = |p(a) - p(b)|, the distance of the two smoothed shares.

Cells with a zero need no bitset, they are complements: with n(a, b) the joint cells and
n(a), n(b) the sizes of the levels, the sum of n(a, b) f(a, b) over all counts is

    sum over a, b > 0 of n(a, b) (f(a, b) - f(a, 0) - f(0, b) + f(0, 0))
    + sum over a > 0 of n(a) (f(a, 0) - f(0, 0)) + the same for b + V f(0, 0).

Every addend belongs to one 64-bit word or level, so the sums are taken block by block of
terms and tile by tile of groups, and no task holds more than two tiles' words of one block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airlake.llm.batches import chunks
from airlake.operators.windows import number_within, top_n_per_group
from airlake.scratch import keep

#: A term: letters of ASCII, lower-cased, and everything beyond ASCII.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: Bytes of text whose terms are summed together.
TOGETHER = 4 << 20
#: Documents of its language a kept term is in, at least.
MIN_DOCS = 30
#: Added to every count; what a share of 1 is.
PRIOR, WHOLE = 5, 1_000_000_000
#: Terms listed per group.
LISTED = 50
#: Bits of a bitset's word, terms of a block, groups of a tile.
WORD, BLOCK, TILE = 64, 16_384, 32

PARTS = "lang STRING, a BIGINT, b BIGINT, part BIGINT"


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(WHOLE (count + PRIOR) / (total + PRIOR terms)), exactly; null where there are no terms."""
    wide = (count + F.lit(PRIOR)).cast("decimal(19,0)") * F.lit(WHOLE).cast("decimal(10,0)")
    over = F.nullif(total + F.lit(PRIOR) * terms, F.lit(0).cast("long")).cast("decimal(19,0)")
    return F.call_function("div", wide, over) + F.lit(1).cast("long")


def share_values(counts: np.ndarray, total: int, terms: int) -> np.ndarray:
    """The same for an array, in steps that stay within 64 bits."""
    over = total + PRIOR * terms
    quotient, rest = np.divmod(counts.astype(np.int64) + PRIOR, over)
    for _ in range(3):
        step, rest = np.divmod(rest * 1000, over)
        quotient = quotient * 1000 + step
    return quotient + 1


def term_counts(docs: DataFrame) -> DataFrame:
    """``n`` occurrences of each term in each group, and ``docs`` with it; from one pass over the texts.

    A task sums what a few MB of texts hold before anything is handed on.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in chunks(whole, "text", TOGETHER):
                yield _counted(batch)

    each = docs.select("lang", "source", "text").mapInArrow(count, "lang STRING, source STRING, term STRING, n BIGINT, docs BIGINT")
    return each.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _counted(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Terms of a batch's groups."""
    parts = pc.split_pattern_regex(pc.ascii_lower(batch.column("text")), BETWEEN)
    coded = parts.values.dictionary_encode()
    terms, term_of = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
    doc_of = np.repeat(np.arange(len(batch)), np.diff(parts.offsets.to_numpy()))
    langs, sources = (batch.column(c).dictionary_encode() for c in ("lang", "source"))
    lang_of, source_of = (c.indices.to_numpy().astype(np.int64) for c in (langs, sources))
    group_of = lang_of * len(sources.dictionary) + source_of
    nothing = pc.index(terms, pa.scalar("", terms.type)).as_py()
    if nothing >= 0:  # before the first term, after the last
        some = term_of != nothing
        term_of, doc_of = term_of[some], doc_of[some]
    size = max(len(terms), 1)
    cells, n = np.unique(group_of[doc_of] * size + term_of, return_counts=True)
    once = np.unique(doc_of * size + term_of, return_counts=True)[0]
    docs = np.unique(group_of[once // size] * size + once % size, return_counts=True)[1]
    group, term = cells // size, cells % size
    return pa.RecordBatch.from_arrays(
        [
            langs.dictionary.take(pa.array(group // max(len(sources.dictionary), 1))),
            sources.dictionary.take(pa.array(group % max(len(sources.dictionary), 1))),
            terms.take(pa.array(term)), pa.array(n), pa.array(docs),
        ],
        names=["lang", "source", "term", "n", "docs"],
    )


def level_bitmaps(cells: DataFrame) -> DataFrame:
    """Bitsets per (group, count), a row per group and block of terms: ``word``, ``level`` and ``mask`` in parallel.

    ``cells`` has ``lang, group, id, n`` and what is the same for all cells of a group.
    """
    same = [c for c in cells.columns if c not in ("id", "n")]
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("id", F.lit(WORD)).cast("int"))
    words = cells.groupBy(*same, F.expr(f"id div {WORD}").alias("word"), F.col("n").alias("level")).agg(F.bit_or(bit).alias("mask"))
    entry = F.sort_array(F.collect_list(F.struct("word", "level", "mask")))
    by_block = words.groupBy(*same, F.expr(f"word div {BLOCK // WORD}").alias("block")).agg(entry.alias("entries"))
    return by_block.select(*same, "block", *(F.col(f"entries.{c}").alias(c) for c in ("word", "level", "mask")))


class _Group:
    """One group's bitsets of one block."""

    def __init__(self, row):
        self.group = row.group
        self.words = np.asarray(row.word, np.int64)
        self.masks = np.asarray(row.mask, np.int64).view(np.uint64)
        self.shares = share_values(np.asarray(row.level, np.int64), row.total, row.terms)
        self.zero = int(share_values(np.zeros(1, np.int64), row.total, row.terms)[0])

    def sizes_times(self, other_zero: int) -> int:
        """What the group's own levels add against a group whose share at count 0 is that."""
        f = np.abs(self.shares - other_zero) - abs(self.zero - other_zero)
        return int((np.bitwise_count(self.masks) * f).sum())

    def joint(self, other: _Group) -> int:
        """What the joint cells of both add."""
        first = np.searchsorted(other.words, self.words, "left")
        n = np.searchsorted(other.words, self.words, "right") - first
        mine = np.repeat(np.arange(len(n)), n)
        theirs = np.arange(len(mine)) + np.repeat(first - (np.cumsum(n) - n), n)
        cells = np.bitwise_count(self.masks[mine] & other.masks[theirs]).astype(np.int64)
        hit = cells > 0
        a, b = self.shares[mine[hit]], other.shares[theirs[hit]]
        f = np.abs(a - b) - np.abs(a - other.zero) - np.abs(self.zero - b) + abs(self.zero - other.zero)
        return int((cells[hit] * f).sum())


def _block_parts(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
    """The addends of one block for all pairs between two tiles of a language's groups."""
    lang, left, right, _ = key
    sides = {side: [_Group(r) for r in frame[frame.tile == side].itertuples()] for side in {left, right}}
    out: dict[tuple[int, int], int] = {}

    def add(a: int, b: int, part: int) -> None:
        pair = (a, b) if a < b else (b, a)
        out[pair] = out.get(pair, 0) + part

    for side, groups in sides.items():
        members = frame[frame.tile == side].iloc[0].others if groups else []
        for group in groups:
            for other in members:
                if other["group"] != group.group:
                    zero = share_values(np.zeros(1, np.int64), other["total"], int(frame.terms.iloc[0]))[0]
                    add(group.group, other["group"], group.sizes_times(int(zero)))
    for a in sides[left]:
        for b in sides[right]:
            if left != right or a.group < b.group:
                add(a.group, b.group, a.joint(b))
    return pd.DataFrame([(lang, a, b, part) for (a, b), part in out.items()], columns=["lang", "a", "b", "part"])


def divergence(
    docs: DataFrame, lang_column: str = "lang", source_column: str = "source", text_column: str = "text",
    min_docs: int = MIN_DOCS, listed: int = LISTED,
) -> DataFrame:
    """Per (lang, source) the distances to the language's other sources and the terms it has too much of.

    Columns: ``lang``, ``source``, ``part`` (``pair`` or ``term``), ``item`` (a source or a
    term), ``value``, ``rank`` (from 1, by falling value, equal ones by ``item`` in bytes).
    Terms are listed up to ``listed``, sources all.

    Null texts, languages and sources are empty strings. A group without terms has distances
    like any other (0 where the language keeps no term), and no terms. Repeated rows count
    each. Other columns of ``docs`` are not read. No rows give no rows. Texts are read whole,
    statistics are of all rows; the output has a row per pair of sources by its contract.
    """
    columns = {"lang": lang_column, "source": source_column, "text": text_column}
    docs = docs.select(*(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(name) for name, c in columns.items()))
    counts = keep(term_counts(docs), "counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("in_lang")).where(F.col("docs") >= min_docs)
    numbered = number_within(kept.drop("docs"), ["lang"], [F.desc("in_lang"), F.asc("term")], "id")
    numbered = keep(numbered.withColumn("id", F.col("id") - 1), "terms")
    langs = numbered.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("in_lang").alias("lang_total"))

    cells = keep(counts.select("lang", "source", "term", "n").join(numbered, ["lang", "term"]), "cells")
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.na.fill(0, ["total", "terms", "lang_total"])
    groups = number_within(groups, ["lang"], [F.asc("source")], "group")
    groups = keep(groups.withColumn("group", F.col("group") - 1), "groups")
    return _pairs(cells, groups).unionByName(_terms(cells, groups, listed))


def _terms(cells: DataFrame, groups: DataFrame, listed: int) -> DataFrame:
    """The terms whose share in the group is above that in the language."""
    each = cells.join(groups, ["lang", "source"])
    each = each.withColumn("p", share(F.col("n"), F.col("total"), F.col("terms")))
    each = each.withColumn("q", share(F.col("in_lang"), F.col("lang_total"), F.col("terms"))).where("p > q")
    each = each.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    return top_n_per_group(each, ["lang", "source"], [F.desc("value"), F.asc("item")], listed)


def _pairs(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """The distances between all groups of a language."""
    groups = groups.withColumn("tile", F.expr(f"group div {TILE}"))
    member = F.sort_array(F.collect_list(F.struct("group", "total", "source")))
    tiles = keep(groups.groupBy("lang", "tile", "terms").agg(member.alias("members")), "tiles")
    last = tiles.groupBy("lang").agg(F.max("tile").alias("last"))
    other = tiles.select("lang", F.col("tile").alias("other"), F.col("members").alias("others"))
    # Each two tiles of a language, in both orders: every tile's words go to the places where they meet another's.
    meeting = tiles.join(last, "lang").withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), "last"))).join(other, ["lang", "other"])

    # Words that a block's groups share are found where both tiles' rows of the block meet.
    of_group = groups.select("lang", "source", "group", "tile", "total", "terms")
    bitmaps = level_bitmaps(cells.select("lang", "source", "id", "n").join(of_group, ["lang", "source"]).drop("source"))
    sent = bitmaps.join(meeting.select("lang", "tile", "other", F.transform("others", lambda o: F.struct(o["group"].alias("group"), o["total"].alias("total"))).alias("others")), ["lang", "tile"])
    sent = sent.withColumn("left", F.least("tile", "other")).withColumn("right", F.greatest("tile", "other"))
    parts = sent.groupBy("lang", "left", "right", "block").applyInPandas(_block_parts, PARTS)
    parts = parts.groupBy("lang", "a", "b").agg(F.sum("part").alias("part"))

    ends = meeting.where("tile <= other").select("lang", "terms", F.explode("members").alias("x"), "others")
    ends = ends.select("lang", "terms", "x", F.explode("others").alias("y")).where("x.group < y.group")
    zero = [share(F.lit(0).cast("long"), F.col(f"{end}.total"), F.col("terms")) for end in "xy"]
    at_zero = F.coalesce(F.col("terms") * F.abs(zero[0] - zero[1]), F.lit(0))
    ends = ends.select("lang", F.col("x.group").alias("a"), F.col("y.group").alias("b"), F.col("x.source").alias("s"), F.col("y.source").alias("t"), at_zero.alias("rest"))
    value = F.col("rest") + F.coalesce("part", F.lit(0))
    found = ends.join(parts, ["lang", "a", "b"], "left").select("lang", "s", "t", value.alias("value"))
    both = F.explode(F.array(F.struct(F.col("s").alias("source"), F.col("t").alias("item")), F.struct(F.col("t").alias("source"), F.col("s").alias("item"))))
    both = found.select("lang", both.alias("e"), "value").select("lang", "e.source", F.lit("pair").alias("part"), "e.item", "value")
    return top_n_per_group(both, ["lang", "source"], [F.desc("value"), F.asc("item")], 2**31 - 1)
