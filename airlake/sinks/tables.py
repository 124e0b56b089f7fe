"""Plain, partitioned and bucketed tables (Parquet).

Each call replaces the table, so a load can be run again. ``overwrite_load`` keeps the old rows readable until the new
ones are complete.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airlake.sinks.publish import publish


def _replace(writer, df: DataFrame, name: str, path: str) -> DataFrame:
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    writer.mode("overwrite").format("parquet").option("path", path).saveAsTable(name)
    return spark.table(name)


def write_plain(df: DataFrame, name: str, path: str) -> DataFrame:
    return _replace(df.write, df, name, path)


def write_partitioned(df: DataFrame, name: str, path: str, key: str) -> DataFrame:
    """One folder per value of ``key``, the partition column last.

    Rebalancing by the key brings a value's rows together, so a value is not
    spread over one small file per task, and splits a value too large for a task.
    """
    return _replace(df.hint("rebalance", key).write.partitionBy(key), df, name, path)


def load_partitions(df: DataFrame, path: str, key: str) -> None:
    """Replace only the partitions present in ``df``; running it twice changes nothing."""
    (
        df.hint("rebalance", key).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)
    )


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """Hash ``key`` into ``buckets``; Spark then prunes buckets and joins without a shuffle.

    Rows are brought together per bucket, so a bucket is one file, unless it is too
    large for a task (many rows, or one hot key): rebalancing then splits it into
    several files of the same bucket.
    """
    placed = (
        df.withColumn("_bucket", F.pmod(F.hash(key), F.lit(buckets)))
        .hint("rebalance", buckets, "_bucket")
        .drop("_bucket")
    )
    return _replace(placed.write.bucketBy(buckets, key), df, name, path)


def overwrite_load(df: DataFrame, name: str, path: str) -> DataFrame:
    """Create if missing and load again; a load that fails leaves the old rows.

    The rows are written beside ``path`` and published by a rename, so ``df`` may read the table itself.
    """
    spark = df.sparkSession
    publish(spark, path, lambda staged: df.write.parquet(staged))
    if spark.catalog.tableExists(name):
        spark.catalog.refreshTable(name)
    else:
        spark.catalog.createTable(name, path=path, source="parquet", schema=df.schema)
    return spark.table(name)


def analyze(spark: SparkSession, name: str, columns: list[str] | None = None) -> DataFrame:
    """Refresh the optimizer's statistics and return what it knows about the table."""
    scope = f"FOR COLUMNS {', '.join(columns)}" if columns else ""
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS {scope}")
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where(F.col("col_name") == "Statistics")
    return described.select(
        F.regexp_extract("data_type", r"(\d+) bytes", 1).cast("long").alias("bytes"),
        F.regexp_extract("data_type", r"(\d+) rows", 1).cast("long").alias("rows"),
    )


def column_statistics(spark: SparkSession, name: str, columns: list[str]) -> DataFrame:
    """What the optimizer knows of analyzed columns: column, nulls, distinct, least, most, bins.

    ``distinct`` is an estimate, ``bins`` the number of the histogram's bins (0 without one).
    """
    rows = []
    for column in columns:
        known = {r.info_name: r.info_value for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name} `{column}`").collect()}
        known = {k: None if v == "NULL" else v for k, v in known.items()}
        bins = re.search(r"num_of_bins: (\d+)", known.get("histogram") or "")
        counts = [int(known[k]) if known.get(k) else None for k in ("num_nulls", "distinct_count")]
        rows.append((column, *counts, known.get("min"), known.get("max"), int(bins[1]) if bins else 0))
    return spark.createDataFrame(rows, "column STRING, nulls BIGINT, distinct BIGINT, least STRING, most STRING, bins INT")


def optimizing_session(spark: SparkSession) -> SparkSession:
    """A session of the same application whose optimizer orders joins by statistics, histograms among them.

    Tables analyzed in it get histograms; tables of the catalog are shared, settings are its own.
    """
    own = spark.newSession()
    for name in ("spark.sql.cbo.enabled", "spark.sql.cbo.joinReorder.enabled", "spark.sql.statistics.histogram.enabled", "spark.sql.cbo.planStats.enabled"):
        own.conf.set(name, "true")
    return own


def join_depths(df: DataFrame, tables: dict[str, str]) -> dict[str, int]:
    """Below how many joins of the optimized plan each table is read; the deepest are joined first."""
    depths, lines = {}, df._jdf.queryExecution().optimizedPlan().treeString().splitlines()
    above: list[int] = []
    for line in lines:
        indent = len(line) - len(line.lstrip(" :+-"))
        above = [i for i in above if i < indent]
        if line.lstrip(" :+-").startswith("Join"):
            above.append(indent)
        depths |= {key: len(above) for key, name in tables.items() if f".{name}[" in line or f".{name.lower()}[" in line}
    return depths
