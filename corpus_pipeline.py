"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns what it keeps; ``run`` writes that as
Parquet below the session's shared folder and gives it to the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airlake.llm import quality
from airlake.llm.decontaminate import decontaminate
from airlake.llm.line_dedup import line_dedup
from airlake.llm.near_dup import near_duplicates, text_key
from airlake.llm.packing import pack
from airlake.llm.prefilter import may_match
from airlake.llm.queries import byte_bpe, fold, packing_digest, table
from airlake.scratch import keep, new_path


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches the threshold; learned from the labels outside the held-out fold."""
    labels = table(spark, sf_dir, "labels").where(fold() != 2)
    scored = quality.score_quality(docs, quality.train(docs, labels))
    return scored.where(F.col("score") >= quality.THRESHOLD).select("row.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that ten documents hold; every document stays, ``n_chars`` follows the text."""
    kept = line_dedup(docs)
    changed = F.col("n_dropped") > 0
    values = {"text": F.col("kept"), "n_chars": F.when(changed, F.length("kept")).otherwise(F.col("row.n_chars"))}
    return kept.select(
        *(values.get(c, F.col(f"row.`{c}`")).cast(t).alias(c) for c, t in docs.dtypes)
    )


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every class of near duplicates, that with the smallest id.

    Documents without id or text are in no class and all stay. Rows that share an id are
    told apart by their texts: each is in the class of its text, and of a class's rows with
    the smallest id one stays, of the text whose key is smallest.
    """
    row = F.struct("doc_id", "text_key")
    found = near_duplicates(docs.select("doc_id", "text")).where("component IS NOT NULL")
    texts = found.groupBy("component", row.alias("_row")).agg(F.count(F.lit(1)).alias("n"))
    chosen = keep(texts.groupBy("component").agg(F.min(F.struct("_row", "n")).alias("best")).select("best.*"), "chosen")
    alone = docs.where("doc_id IS NULL OR text IS NULL")
    present = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").withColumn(
        "_row", F.struct(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("text_key"))
    )
    once = present.join(chosen.where("n = 1"), "_row", "left_semi")
    again = chosen.where("n > 1")
    first = may_match(present, again, "_row").join(again, "_row", "left_semi").dropDuplicates(["_row"])
    return alone.unionByName(once.select(docs.columns)).unionByName(first.select(docs.columns))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of words with the benchmark."""
    found = decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return found.where(~F.col("contaminated")).select("row.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed pieces as digests, like the packing query's rows."""
    return packing_digest(pack(docs, byte_bpe()))


STAGES = [
    ("quality", keep_quality),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", one_of_each),
    ("decontaminate", without_benchmark),
    ("packing", packed),
]

#: The first stage's model and the tokenizer's ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
