"""Word counts and checks of how words spread over output parts."""

from __future__ import annotations

from math import lcm

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airlake.functions.text import hash_part, words
from airlake.operators.aggregates import share
from airlake.operators.windows import top_n_per_group


def word_counts(lines: DataFrame, column: str = "value") -> DataFrame:
    """(word, count) over all lines; counts are combined in each task before the shuffle."""
    return (
        lines.select(F.explode(words(F.col(column))).alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def place_words(counts: DataFrame, runs: list[int]) -> DataFrame:
    """(reducers, part, word, count) for each number of output parts in ``runs``."""
    reducers = F.explode(F.array(*(F.lit(r) for r in runs))).alias("reducers")
    placed = counts.select(reducers, "word", "count")
    return placed.withColumn("part", hash_part(F.col("word"), F.col("reducers")))


def part_distribution(placed: DataFrame) -> DataFrame:
    """Distinct words, occurrences and share of all words per part of each run."""
    parts = placed.groupBy("reducers", "part").agg(
        F.count(F.lit(1)).alias("words"), F.sum("count").alias("occurrences")
    )
    whole = parts.groupBy("reducers").agg(F.sum("words").alias("_all"))
    return (
        parts.join(whole, "reducers")
        .withColumn("words_pct", share(100.0 * F.col("words"), F.col("_all"), 1))
        .drop("_all")
    )


def run_invariants(placed: DataFrame) -> DataFrame:
    """Per run: distinct words, words found in more than one part, all occurrences."""
    return placed.groupBy("reducers").agg(
        F.count_distinct("word").alias("distinct_words"),
        (F.count(F.lit(1)) - F.count_distinct("word")).alias("words_in_several_parts"),
        F.sum("count").alias("occurrences"),
    )


def order_of_files(lines: DataFrame) -> DataFrame:
    """Per part: words, the first and the last as they stand, and neighbours out of order.

    ``lines`` are (part, word) of a scan of part files. Lines are compared within each
    piece of a file, where a scan keeps their order, then the last line of each piece with
    the first of the next. No task sorts more than a piece or than the pieces of a part.
    """
    placed = lines.select(
        "part", "word", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("line"),
    )
    piece = ["part", "file", "start"]
    before = F.lag("word").over(Window.partitionBy(*piece).orderBy("line"))
    pieces = placed.withColumn("broken", F.coalesce(F.col("word") < before, F.lit(False))).groupBy(*piece).agg(
        F.count(F.lit(1)).alias("words"), F.min_by("word", "line").alias("first"), F.max_by("word", "line").alias("last"),
        F.count_if("broken").alias("broken"),
    )
    ended = F.lag("last").over(Window.partitionBy("part").orderBy("file", "start"))
    pieces = pieces.withColumn("torn", F.coalesce(F.col("first") < ended, F.lit(False)))
    place = F.struct("file", "start")
    return pieces.groupBy("part").agg(
        F.sum("words").alias("words"), F.min_by("first", place).alias("first_word"), F.max_by("last", place).alias("last_word"),
        (F.sum("broken") + F.count_if("torn")).alias("out_of_order"),
    )


def part_heads(placed: DataFrame, n: int = 8) -> DataFrame:
    """The first words of each part in sorted order."""
    return top_n_per_group(placed, ["reducers", "part"], [F.asc("word")], n)


def heads_of_runs(counts: DataFrame, runs: list[int], n: int = 8) -> DataFrame:
    """(reducers, part, word, count, rank): ``part_heads`` of ``place_words``, without placing every word in every run.

    The parts of a number that all runs divide are pieces of every run's parts, so the first words of a part are among the
    first words of its pieces. Words are placed and ordered once; the runs see ``n`` words per piece.
    """
    pieces = counts.withColumn("piece", hash_part(F.col("word"), lcm(*runs)))
    first = top_n_per_group(pieces, ["piece"], [F.asc("word")], n).select("piece", "word", "count")
    reducers = F.explode(F.array(*(F.lit(r) for r in runs))).alias("reducers")
    placed = first.select(reducers, "piece", "word", "count").withColumn("part", F.pmod("piece", "reducers"))
    return part_heads(placed.select("reducers", "part", "word", "count"), n)


def top_words(counts: DataFrame, n: int = 15) -> DataFrame:
    return counts.orderBy(F.desc("count"), "word").limit(n)
