"""Benchmark passages in documents, found by winnowing; DataFrame operations only.

A window of ``WINDOW`` words has ``WINDOW - GRAM + 1`` hashes of ``GRAM`` consecutive words;
the smallest is its fingerprint. It depends on the window's words alone, so wherever the
window occurs, the same fingerprint is kept: every shared span of at least ``WINDOW`` words
is found. Neighbouring windows mostly have one fingerprint, which is kept once with the
windows it stands for. Fingerprints of documents are joined with those of the benchmark;
hits are extended to the windows around them and compared word by word, so that what is
reported is exact and hashes only decide where to look.

Benchmark items of fewer words than a window are one window of their own length, with as
many grams as fit.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airlake.llm.prefilter import may_match
from airlake.scratch import keep

WINDOW = 10
GRAM = 5

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOT_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Runs of ASCII digits and letters and of characters beyond ASCII; A-Z are still as they were."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), NOT_WORD, -1), lambda w: w != "")


def lowered(word: Column) -> Column:
    """A-Z lower-cased. Most words have none, and the test is cheaper than the translation."""
    return F.when(word.rlike("[A-Z]"), F.translate(word, UPPER, LOWER)).otherwise(word)


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often it occurs there."""
    return F.transform(F.array(value), use)[0]


def _gram_of(length: int, gram: int) -> int:
    return min(gram, length)


def fingerprints(words: Column, length: int, gram: int) -> Column:
    """Runs of windows with one fingerprint, as structs (print, first, last) of window places.

    ``words`` are lower-cased; empty where there are fewer than ``length``.
    """
    gram = _gram_of(length, gram)
    many = length - gram + 1

    def grams(hashes: Column) -> Column:
        return F.transform(
            F.slice(hashes, F.lit(1), F.size(hashes) - (gram - 1)),
            lambda h, i: F.xxhash64(h, *(F.get(hashes, i + k) for k in range(1, gram))),
        )

    def smallest(of: Column) -> Column:
        if many == 1:
            return of
        return F.transform(
            F.slice(of, F.lit(1), F.size(of) - (many - 1)),
            lambda g, i: F.least(g, *(F.get(of, i + k) for k in range(1, many))),
        )

    def runs(prints: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(0), F.size(prints) - 1),
            lambda i: (i == 0) | (F.get(prints, i) != F.get(prints, i - 1)),
        )
        return _bound(
            starts,
            lambda s: F.transform(
                s,
                lambda first, i: F.struct(
                    F.get(prints, first).alias("print"), first.alias("first"),
                    (F.coalesce(F.get(s, i + 1), F.size(prints)) - 1).alias("last"),
                ),
            ),
        )

    def found(hashes: Column) -> Column:
        return F.when(F.size(hashes) >= length, _bound(grams(hashes), lambda g: _bound(smallest(g), runs)))

    return _bound(F.transform(words, lambda w: F.xxhash64(w)), found)


def _windows(words: Column, first: Column, last: Column, length: int) -> Column:
    """The windows that begin at the places first to last, as structs (first, words)."""
    return F.transform(
        F.sequence(first, last),
        lambda i: F.struct(i.alias("first"), F.array_join(F.slice(words, i + 1, length), " ").alias("words")),
    )


def _text_key(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit("text"), text).alias("t2")]


def _lower_words(text: Column) -> Column:
    return F.transform(words_of(text), lowered)


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
) -> DataFrame:
    """Every document with what it shares with the benchmark.

    Columns: ``row``, a struct of all columns of ``docs``; ``n_words``; ``n_hit``, words
    inside a window of an item; ``spans``, these as sorted structs (first, last) of word
    places; ``items``, the sorted ids (as strings) of the items with such windows;
    ``contaminated``.

    Windows are ``window`` consecutive words of an item, or all of a shorter item. Null
    texts and texts without a word have no windows, neither as documents nor as items.
    Repeated rows and equal texts come back each with the same result; items with equal
    text are all named, a null item id is not. An empty benchmark finds nothing, no
    documents give no rows.
    """
    items = keep(
        benchmark.select(
            F.col(f"`{item_column}`").cast("string").alias("item"),
            _lower_words(F.col(f"`{item_text_column}`").cast("string")).alias("words"),
        )
        .where(F.size("words") > 0)
        .withColumn("length", F.least(F.size("words"), F.lit(window))),
        "benchmark-words",
    )
    # At most ``window`` different lengths, whatever the size of the benchmark.
    lengths = sorted(r.length for r in items.select("length").distinct().collect())

    texts = docs.select(F.col(f"`{text_column}`").cast("string").alias("text"))
    finds = [_finds(texts, items.where(F.col("length") == n), n, gram) for n in lengths]

    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    text = F.col(f"row.`{text_column}`").cast("string")
    n_words = F.size(words_of(text)).cast("long").alias("n_words")
    none = F.array().cast("array<struct<first:int,last:int>>"), F.array().cast("array<string>")
    if not finds:
        found = rows.select("row", n_words, F.lit(0).cast("long").alias("n_hit"), none[0].alias("spans"), none[1].alias("items"))
    else:
        per_text = reduce(DataFrame.unionByName, finds).groupBy("t1", "t2").agg(
            F.sort_array(F.array_distinct(F.flatten(F.collect_set("places")))).alias("places"),
            F.sort_array(F.collect_set("item")).alias("items"),
        )
        per_text = per_text.select("t1", "t2", F.size("places").alias("hit"), _spans(F.col("places")).alias("spans"), "items")
        found = (
            rows.select("row", n_words, *_text_key(text))
            .join(keep(per_text, "contaminated"), ["t1", "t2"], "left")
            .select(
                "row", "n_words", F.coalesce("hit", F.lit(0)).cast("long").alias("n_hit"),
                F.coalesce("spans", none[0]).alias("spans"), F.coalesce("items", none[1]).alias("items"),
            )
        )
    return found.withColumn("contaminated", F.col("n_hit") > 0)


def _finds(texts: DataFrame, items: DataFrame, length: int, gram: int) -> DataFrame:
    """(t1, t2, item, places): for each text and item the word places inside shared windows."""
    prints = (
        items.select(F.explode(fingerprints(F.col("words"), length, gram)).alias("p"))
        .select(F.col("p.print").alias("print"))
        .distinct()
    )
    hits = (
        texts.select(*_text_key(F.col("text")), F.explode(fingerprints(_lower_words(F.col("text")), length, gram)).alias("p"))
        .select("t1", "t2", F.col("p.print").alias("print"), F.col("p.first").alias("first"), F.col("p.last").alias("last"))
        .join(keep(prints, "fingerprints"), "print", "left_semi")
        .groupBy("t1", "t2")
        .agg(F.collect_set(F.struct("first", "last")).alias("runs"))
    )
    # Few texts have a hit; only their words are compared.
    hits = keep(hits, "fingerprint-hits")
    candidates = (
        may_match(texts.select("text", *_text_key(F.col("text"))), hits, "t1")
        .join(hits, ["t1", "t2"])
        .dropDuplicates(["t1", "t2"])
        .select("t1", "t2", "runs", _lower_words(F.col("text")).alias("words"))
    )
    around = F.flatten(F.transform("runs", lambda r: _windows(F.col("words"), r["first"], r["last"], length)))
    own = candidates.select("t1", "t2", F.explode(around).alias("w")).select(
        "t1", "t2", F.col("w.first").alias("first"), F.col("w.words").alias("window")
    )
    every = _windows(F.col("words"), F.lit(0), F.size("words") - length, length)
    windows = (
        items.select("item", F.explode(every).alias("w")).select("item", F.col("w.words").alias("window")).distinct()
    )
    firsts = F.collect_set(F.col("first").cast("int"))
    inside = F.flatten(F.transform(firsts, lambda i: F.sequence(i, i + (length - 1))))
    return own.join(windows, "window").groupBy("t1", "t2", "item").agg(F.array_distinct(inside).alias("places"))


def _spans(places: Column) -> Column:
    """Sorted distinct places as spans without gaps."""

    def spans(p: Column) -> Column:
        firsts = F.filter(p, lambda x, i: (i == 0) | (F.get(p, i - 1) != x - 1))
        lasts = F.filter(p, lambda x, i: F.coalesce(F.get(p, i + 1) != x + 1, F.lit(True)))
        return F.zip_with(firsts, lasts, lambda a, b: F.struct(a.alias("first"), b.alias("last")))

    return _bound(places, spans)
