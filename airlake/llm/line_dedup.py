"""Lines that many documents repeat, found with levelled sorted runs of line hashes.

Documents arrive in batches. A batch becomes a run: the hashes of its lines, sorted,
each with the number of documents that hold it. A run is first merge-anti-joined with
the runs of settled lines, those known to be repeated often enough, so that a settled
line is never counted again; the rest is added as a run of the lowest level. When a
level holds ``FANOUT`` runs they are merged into one of the next level, and lines that
reach the threshold move to the settled runs. Runs are bucketed and sorted by hash, so
anti-joins and merges shuffle nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airlake.llm.batches import chunks
from airlake.scratch import keep, new_path, new_table_name

MIN_DOCS = 10
MIN_CHARS = 1
FANOUT = 2
BATCHES = 4

KEY = ["h1", "h2"]


def line_key(line: str) -> bytes:
    """White space stripped at both ends and A-Z lower-cased, both of ASCII alone."""
    return line.encode("utf-8", "surrogatepass").strip().lower()


def _hash(key: bytes) -> bytes:
    return xxhash.xxh3_128_digest(key)


def _long_enough(key: bytes, least: int) -> bool:
    return len(key) >= least and (len(key) >= 4 * least or len(key.decode("utf-8", "surrogatepass")) >= least)


def _two_longs(digests: list[bytes]) -> list[pa.Array]:
    pairs = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
    return [pa.array(pairs[:, 0]), pa.array(pairs[:, 1])]


class LineRuns:
    """Counts of line hashes in levelled sorted runs.

    ``add`` takes the counts of a batch as rows (h1, h2, docs), one for each key.
    ``close`` merges what is left and drops the runs' tables.
    """

    def __init__(self, spark: SparkSession, min_docs: int = MIN_DOCS, fanout: int = FANOUT):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self.settled: list[str] = []
        self.tables: list[str] = []

    def _write(self, df: DataFrame, label: str) -> str:
        """A sorted run; rows that come out of runs are in the tasks of their buckets already."""
        name = new_table_name(label)
        (
            df.write.format("parquet")
            .bucketBy(self.buckets, *KEY)
            .sortBy(*KEY)
            .option("path", new_path(self.spark, label))
            .saveAsTable(name)
        )
        self.tables.append(name)
        return name

    def add(self, counts: DataFrame) -> None:
        unsettled = reduce(
            lambda df, run: df.join(self.spark.table(run).hint("merge"), KEY, "left_anti"), self.settled, counts
        )
        self._place(self._write(unsettled.select(*KEY, "docs").repartition(self.buckets, *KEY), "run"), 0)

    def _place(self, run: str, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fanout:
            runs, self.levels[level] = self.levels[level], []
            merged = self._merge(runs)
            if merged:
                self._place(merged, level + 1)

    def _merge(self, runs: list[str], last: bool = False) -> str | None:
        """One run of all, and a settled run of its frequent lines."""

        def both(left: DataFrame, right: DataFrame) -> DataFrame:
            right = right.withColumnRenamed("docs", "more")
            total = F.coalesce("docs", F.lit(0)) + F.coalesce("more", F.lit(0))
            return left.join(right.hint("merge"), KEY, "full_outer").select(*KEY, total.alias("docs"))

        merged = reduce(both, map(self.spark.table, runs))
        frequent = F.col("docs") >= self.min_docs
        if last:
            self.settled.append(self._write(merged.where(frequent).select(*KEY), "settled"))
            return None
        all_of_them = self._write(merged, "run")
        self.settled.append(self._write(self.spark.table(all_of_them).where(frequent).select(*KEY), "settled"))
        # Settled counts may stay in the run: the threshold only rises from there.
        return all_of_them

    def frequent(self) -> DataFrame:
        """The keys of all lines that reached the threshold so far (all, after ``close``)."""
        return reduce(DataFrame.union, (self.spark.table(run).select(*KEY) for run in self.settled)).distinct()

    def close(self) -> DataFrame:
        """Merge all runs, keep the frequent keys as plain files and drop the tables."""
        left = [run for level in self.levels for run in level]
        if left:
            self._merge(left, last=True)
        frequent = keep(self.frequent(), "frequent-lines")
        for name in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        return frequent


def _lines_of(min_chars: int, with_place: bool):
    """Rows of a batch of texts: the keys of its lines, once for each text or with their places."""

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in chunks(whole, "text"):
                rows, places, digests = [], [], []
                for row, text in enumerate(batch.column("text").to_pylist()):
                    keys = [line_key(line) for line in (text or "").split("\n")]
                    if with_place:
                        found = [(i, _hash(k)) for i, k in enumerate(keys) if _long_enough(k, min_chars)]
                        places += [i for i, _ in found]
                        digests += [d for _, d in found]
                        rows += [row] * len(found)
                    else:
                        found = {_hash(k) for k in set(keys) if _long_enough(k, min_chars)}
                        digests += found
                        rows += [row] * len(found)
                columns = [batch.column(n).take(pa.array(rows, pa.int64())) for n in batch.schema.names if n != "text"]
                names = [n for n in batch.schema.names if n != "text"]
                columns += ([pa.array(places, pa.int32())] if with_place else []) + _two_longs(digests)
                yield pa.RecordBatch.from_arrays(columns, names=[*names, *(["place"] if with_place else []), *KEY])

    return lines


def _text_key(text: Column) -> list[Column]:
    """Two 64-bit hashes that stand for a text; copies share them and so their result."""
    return [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit("text"), text).alias("t2")]


def _without(text: Column, cuts: Column) -> Column:
    """The lines between the cuts, which start at -1 and end beyond the last line."""

    def kept(lines: Column) -> Column:
        between = F.sequence(F.lit(0), F.size(cuts) - 2)
        return F.flatten(F.transform(between, lambda k: F.slice(lines, cuts[k] + 2, cuts[k + 1] - cuts[k] - 1)))

    # The outer transform binds the split lines, so that they are made once.
    return F.transform(F.array(F.split(text, "\n", -1)), lambda lines: F.array_join(kept(lines), "\n"))[0]


def line_dedup(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    min_docs: int = MIN_DOCS,
    min_chars: int = MIN_CHARS,
    batches: int = BATCHES,
) -> DataFrame:
    """Documents without the lines that at least ``min_docs`` of them hold.

    Columns: ``row``, a struct of all columns of ``docs`` as they were; ``kept``, the text
    that is left; ``n_lines`` before dropping; ``n_dropped``. A line is
    what stands between line feeds; its key is stripped of ASCII white space and A-Z are
    lower-cased. Keys shorter than ``min_chars`` characters are never dropped. A document
    counts once for a key however often it holds it; repeated rows count each. A null or
    empty text is one empty line and stays as it is; a text whose lines all go becomes
    empty. The id only deals documents to ``batches`` batches and may be null. No rows
    give no rows. Every line of every text takes part, whatever its length.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    batch = F.pmod(F.xxhash64("id"), F.lit(batches)).cast("int").alias("batch")
    arrivals = new_path(spark, "arrivals")
    (
        texts.select(batch, "text")
        .mapInArrow(_lines_of(min_chars, with_place=False), "batch INT, h1 BIGINT, h2 BIGINT")
        .groupBy("batch", *KEY)
        .agg(F.count(F.lit(1)).alias("docs"))
        .write.partitionBy("batch")
        .parquet(arrivals)
    )
    counts = spark.read.schema("h1 BIGINT, h2 BIGINT, docs BIGINT, batch INT").parquet(arrivals)
    runs = LineRuns(spark, min_docs)
    for number in range(batches):
        runs.add(counts.where(F.col("batch") == number).drop("batch"))
    frequent = runs.close()

    ends = F.concat(F.array(F.lit(-1)), F.sort_array(F.collect_set("place")), F.array(F.lit(2**31 - 1)))
    cuts = (
        texts.select(*_text_key(F.col("text")), "text")
        .mapInArrow(_lines_of(min_chars, with_place=True), "t1 BIGINT, t2 BIGINT, place INT, h1 BIGINT, h2 BIGINT")
        .join(frequent, KEY, "left_semi")
        .groupBy("t1", "t2")
        .agg(ends.alias("cuts"))
    )
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    text = F.col(f"row.`{text_column}`").cast("string")
    present = F.coalesce(text, F.lit(""))
    return (
        rows.select("row", *_text_key(text))
        .join(cuts, ["t1", "t2"], "left")
        .select(
            "row",
            F.when(F.col("cuts").isNull(), text).otherwise(_without(text, F.col("cuts"))).alias("kept"),
            (F.octet_length(present) - F.octet_length(F.replace(present, F.lit("\n"), F.lit(""))) + 1)
            .cast("long").alias("n_lines"),
            F.coalesce(F.size("cuts") - 2, F.lit(0)).cast("long").alias("n_dropped"),
        )
    )
