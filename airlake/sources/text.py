"""Lines of text and the part files of a word count."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def read_part_files(spark: SparkSession, path: str, part_is_folder: bool = True) -> DataFrame:
    """(part, word, count) rows; the word ends at the last tab.

    ``part`` is the ``part=`` folder a line was found in, or, for a flat output
    folder, the name of its file.
    """
    location = F.col("_metadata.file_path")
    pattern = r"part=(\d+)/[^/]+$" if part_is_folder else r"([^/]+)$"
    line = r"(?s)^(.*)\t(\d+)$"
    lines = spark.read.option("recursiveFileLookup", True).option("lineSep", "\n").text(path)
    return lines.select(
        F.regexp_extract(location, pattern, 1).alias("part"),
        F.regexp_extract("value", line, 1).alias("word"),
        F.regexp_extract("value", line, 2).cast("long").alias("count"),
    )


def words_of_parts(spark: SparkSession, path: str) -> DataFrame:
    """(part, word) of part files in the order of their lines; ``_metadata`` tells where they stand."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select("part", F.regexp_extract("value", r"(?s)^(.*)\t(\d+)$", 1).alias("word"), "_metadata")
