"""Session settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# AQE re-plans joins from measured sizes, coalesces small shuffle partitions and splits
# skewed ones; every operator here counts on it being on. A split that costs a further
# shuffle is made as well, for a hot key must not land in one task.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: int = 8, memory: str = "8g", **extra: str) -> SparkSession:
    """A session on this machine, for tests and benchmarks.

    On a cluster the caller brings its own session and sizes
    ``spark.sql.shuffle.partitions`` for the data.
    """
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("airlake")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
    )
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
