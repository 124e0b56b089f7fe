"""Word counts as tab-separated text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlake.functions.text import hash_part


def write_wordcount(counts: DataFrame, path: str, parts: int) -> None:
    """``word<TAB>count`` lines in ``part=0 … part=parts-1``, words hashed to parts.

    Words are sorted inside a part. A part is a folder whose files, in name
    order, continue the sorting, so even a single part is written by many tasks.
    """
    placed = counts.withColumn("part", hash_part(F.col("word"), parts))
    (
        placed.repartitionByRange("part", "word")
        .sortWithinPartitions("part", "word")
        .select("part", F.concat_ws("\t", "word", "count").alias("value"))
        .write.mode("overwrite").option("partitionOverwriteMode", "static")
        .partitionBy("part").option("lineSep", "\n").text(path)
    )
