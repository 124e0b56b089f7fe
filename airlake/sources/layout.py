"""How tables lie in files, and what a lookup has to read of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airlake.functions.formats import bucket_number, format_bytes


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """(path, bytes) of the data files below ``path``; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", F.col("length").alias("bytes"))


def layout_report(spark: SparkSession, path: str) -> DataFrame:
    """Files and sizes per partition folder (``''`` for files lying flat)."""
    folder = F.regexp_extract("path", r"/([^/=]+=[^/]*)/[^/]+$", 1)
    return (
        file_sizes(spark, path)
        .groupBy(folder.alias("folder"))
        .agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"))
        .withColumn("size", format_bytes(F.col("bytes")))
    )


def bucket_report(spark: SparkSession, path: str) -> DataFrame:
    """Files and sizes per bucket, buckets counted from 1."""
    return (
        file_sizes(spark, path)
        .groupBy(bucket_number(F.col("path")).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"))
        .withColumn("size", format_bytes(F.col("bytes")))
    )


def split_report(scan: DataFrame) -> DataFrame:
    """The pieces a scan is cut into, with the rows found in each; apply to a file scan.

    The piece size is ``spark.sql.files.maxPartitionBytes``.
    """
    return scan.groupBy(
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_block_length").alias("length"),
    ).agg(F.count(F.lit(1)).alias("rows"))


def in_bucket(key: str, bucket: int, buckets: int) -> Column:
    """Condition that a row's key hashes to ``bucket`` (from 1) of ``buckets``.

    The hash is the one bucketed writes use, so the rows are those of that
    bucket's files.
    """
    return F.pmod(F.hash(key), F.lit(buckets)) == bucket - 1


def bucket_sample(df: DataFrame, key: str, bucket: int, buckets: int, stored: bool = False) -> DataFrame:
    """The rows of one bucket (from 1). Of a table stored in such buckets, only that bucket's files are read."""
    rows = df.where(in_bucket(key, bucket, buckets))
    if stored:
        rows = rows.where(F.col("_metadata.file_name").rlike(rf"_{bucket - 1:05d}\."))
    return rows


def bucket_of(spark: SparkSession, value, kind: str, buckets: int) -> int:
    """Bucket, from 1, that holds a key value of the given type."""
    hashed = F.pmod(F.hash(F.lit(value).cast(kind)), F.lit(buckets)) + 1
    return spark.range(1).select(hashed).first()[0]


def scan_work(df: DataFrame) -> dict[str, int]:
    """Files and bytes that the scans of a query are dealt to its tasks, and rows they gave, as Spark has them.

    The query is run and its rows are only counted, where they are; it must need no shuffle.
    """
    execution = df._jdf.queryExecution()
    work = {"answer": execution.toRdd().count(), "files_read": 0, "bytes_read": 0, "rows_read": 0}
    leaves = execution.executedPlan().collectLeaves()
    for i in range(leaves.size()):
        scan, files = leaves.apply(i), set()
        pieces = scan.inputRDD().filePartitions()
        for j in range(pieces.size()):
            for piece in pieces.apply(j).files():
                files.add(piece.filePath().toString())
                work["bytes_read"] += piece.length()
        work["files_read"] += len(files)
        work["rows_read"] += scan.metrics().apply("numOutputRows").value()
    return work


def compare_layouts(spark: SparkSession, lookups: dict[str, dict[str, DataFrame]], paths: dict[str, str]) -> DataFrame:
    """What each lookup reads of each layout, measured by running it.

    ``lookups`` maps a lookup's name to its query per layout, ``paths`` a layout to its
    folder. The queries must need no shuffle. Columns: layout, lookup, answer (rows
    found), files, files_read, bytes, bytes_read, rows_read.
    """
    whole = {
        layout: file_sizes(spark, path).agg(F.count(F.lit(1)), F.sum("bytes")).first() for layout, path in paths.items()
    }
    rows = []
    for lookup, queries in lookups.items():
        for layout, df in queries.items():
            work = scan_work(df)
            files, size = whole[layout]
            rows.append((layout, lookup, work["answer"], files, work["files_read"], size, work["bytes_read"], work["rows_read"]))
    schema = (
        "layout STRING, lookup STRING, answer BIGINT, files BIGINT, files_read BIGINT, bytes BIGINT, bytes_read BIGINT, "
        "rows_read BIGINT"
    )
    return spark.createDataFrame(rows, schema)
