"""Queries of the word-count family; they read whole document texts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlake.functions.text import hash_part, words
from airlake.operators.wordcount import (
    heads_of_runs, order_of_files, part_distribution, place_words, run_invariants, top_words, word_counts,
)
from airlake.plans.registry import query
from airlake.plans.storage import WORDS
from airlake.plans.tables import table
from airlake.scratch import keep, working_area
from airlake.sinks.wordcount import write_wordcount
from airlake.sources.text import read_part_files, words_of_parts

RUNS = [1, 2, 4]


def _counts(spark, folder):
    return word_counts(table(spark, folder, "documents"), "text")


def _placed(spark, folder):
    return place_words(_counts(spark, folder), RUNS)


@query("str_word_split", r"""
SELECT doc_id, len(list_filter(regexp_split_to_array(text, '[ \t\n\r\f]+'), lambda w: w <> '')) AS words
FROM documents""")
def words_per_document(spark, folder):
    return table(spark, folder, "documents").select("doc_id", F.size(words(F.col("text"))).cast("long").alias("words"))


@query("wordcount", f"WITH {WORDS} SELECT word, count FROM counts")
def counted_words(spark, folder):
    return _counts(spark, folder)


@query("wordcount_partitioned", f"WITH {WORDS} SELECT reducers, part, word, count FROM placed")
def placed_words(spark, folder):
    return _placed(spark, folder)


DISTRIBUTION = f"""
WITH {WORDS},
parts AS (SELECT reducers, part, COUNT(*) AS words, CAST(SUM(count) AS BIGINT) AS occurrences FROM placed GROUP BY ALL),
whole AS (SELECT reducers, CAST(SUM(words) AS BIGINT) AS all_words FROM parts GROUP BY reducers)"""
PERCENT = "((2000 * words + all_words) // (2 * all_words)) / 10"


@query("wordcount_distribution", f"""{DISTRIBUTION}
SELECT p.reducers, part, words, occurrences, {PERCENT} AS words_pct FROM parts p JOIN whole w ON p.reducers = w.reducers""")
def distribution(spark, folder):
    return part_distribution(_placed(spark, folder))


@query("agg_share_of_total", f"""{DISTRIBUTION}
SELECT p.reducers, part, {PERCENT} AS words_pct FROM parts p JOIN whole w ON p.reducers = w.reducers""")
def shares(spark, folder):
    return part_distribution(_placed(spark, folder)).select("reducers", "part", "words_pct")


@query("agg_part_distribution", f"{DISTRIBUTION} SELECT reducers, part, words, occurrences FROM parts")
def parts(spark, folder):
    return _placed(spark, folder).groupBy("reducers", "part").agg(
        F.count(F.lit(1)).alias("words"), F.sum("count").alias("occurrences")
    )


INVARIANTS = f"""
WITH {WORDS}
SELECT reducers, COUNT(DISTINCT word) AS distinct_words, COUNT(*) - COUNT(DISTINCT word) AS words_in_several_parts,
       CAST(SUM(count) AS BIGINT) AS occurrences
FROM placed GROUP BY reducers"""


def _written(spark, folder, area, runs: list[int]) -> DataFrame:
    """Word counts written for each number of parts and read from these files."""
    counts = area.keep(_counts(spark, folder), "counts")
    read = []
    for parts in runs:
        _, path = area.place("wordcount")
        write_wordcount(counts, path, parts)
        read.append(read_part_files(spark, path).withColumn("reducers", F.lit(parts)))
    return reduce(DataFrame.unionByName, read)


@query("wordcount_invariants", INVARIANTS)
def invariants(spark, folder):
    """Whatever the number of parts: each word in one of them, and no occurrence lost."""
    with working_area(spark) as area:
        return keep(run_invariants(_written(spark, folder, area, RUNS)))


@query("agg_integrity", f"""
WITH {WORDS}
SELECT COUNT(DISTINCT word) AS distinct_words, COUNT(*) - COUNT(DISTINCT word) AS words_in_several_parts,
       CAST(SUM(count) AS BIGINT) AS occurrences
FROM placed WHERE reducers = 4""")
def invariants_of_files(spark, folder):
    """The same check on part files written and read back."""
    with working_area(spark) as area:
        return keep(run_invariants(_written(spark, folder, area, [4])).drop("reducers"))


@query("wordcount_heads", f"""
WITH {WORDS}
SELECT reducers, part, word, count, CAST(rank AS INTEGER) AS rank FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY reducers, part ORDER BY word) AS rank FROM placed)
WHERE rank <= 8""")
def heads(spark, folder):
    return heads_of_runs(_counts(spark, folder), RUNS)


@query("wordcount_top", f"WITH {WORDS} SELECT word, count FROM counts ORDER BY count DESC, word LIMIT 15")
def top(spark, folder):
    return top_words(_counts(spark, folder))


@query("nlargest", f"""
WITH {WORDS} SELECT part, word, count FROM placed WHERE reducers = 2 ORDER BY count DESC, part, word LIMIT 15""")
def most_frequent(spark, folder):
    placed = _counts(spark, folder).withColumn("part", hash_part(F.col("word"), 2))
    return placed.orderBy(F.desc("count"), "part", "word").limit(15)


@query("sort_within_parts", f"""
WITH {WORDS}
SELECT part, COUNT(*) AS words, MIN(word) AS first_word, MAX(word) AS last_word, CAST(0 AS BIGINT) AS out_of_order
FROM placed WHERE reducers = 4 GROUP BY part""")
def sorted_files(spark, folder):
    """Neighbouring lines of every file written, checked for order."""
    with working_area(spark) as area:
        _, path = area.place("wordcount")
        write_wordcount(_counts(spark, folder), path, 4)
        return keep(order_of_files(words_of_parts(spark, path)))
