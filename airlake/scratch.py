"""Intermediate data in the folder that every executor can reach.

A cluster names that folder in ``spark.checkpoint.dir``. Lineage is cut only by
writing there, so a lost executor never takes the only copy of a result with it.
A loop keeps its copies in a ``working_area``, which is removed when the loop is done;
what a returned DataFrame still reads stays until ``sweep``.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Paths and tables made here, by application.
_made: dict[str, dict[str, set[str]]] = {}


def shared_folder(spark: SparkSession) -> str:
    """The session's shared folder; a temporary one where none is set and all run in one process."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="airlake-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def _record(spark: SparkSession) -> dict[str, set[str]]:
    return _made.setdefault(spark.sparkContext.applicationId, {"paths": set(), "tables": set()})


def new_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing else uses."""
    path = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _record(spark)["paths"].add(path)
    return path


def new_table_name(label: str, spark: SparkSession | None = None) -> str:
    name = f"{label}_{uuid.uuid4().hex}"
    spark = spark or SparkSession.getActiveSession()
    if spark:
        _record(spark)["tables"].add(name)
    return name


def _delete(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
    _record(spark)["paths"].discard(path)


def _drop(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    _record(spark)["tables"].discard(name)


def sweep(spark: SparkSession) -> None:
    """Remove every copy and table made here for this application.

    For the end of a piece of work: DataFrames that read them are of no use afterwards.
    """
    made = _record(spark)
    for name in list(made["tables"]):
        _drop(spark, name)
    for path in list(made["paths"]):
        _delete(spark, path)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Executions planned here remove their shuffle files when they end.

    Else the files stay until the driver's garbage is collected, which may be never. For work whose result is written
    and read from there; were a lost file asked for all the same, Spark would run its stage again.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise a loop's state reliably and forget how it was computed.

    The files go with the DataFrame where ``spark.cleaner.referenceTracking.cleanCheckpoints``
    is set, as in ``airlake.session``.
    """
    shared_folder(df.sparkSession)
    with shuffles_freed(df.sparkSession):
        return df.select("*").checkpoint(eager=True)  # a plan of its own, made with the setting


def _write(df: DataFrame, path: str) -> DataFrame:
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keep(df: DataFrame, label: str = "kept") -> DataFrame:
    """Write a result that is scanned several times and read it back as columns."""
    return _write(df, new_path(df.sparkSession, label))


def shuffle_width(spark: SparkSession) -> int:
    """The session's number of shuffle partitions before any are coalesced."""
    return int(
        spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
        or spark.conf.get("spark.sql.shuffle.partitions")
    )


class WorkingArea:
    """Copies that live as long as the work that needs them."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths, self.tables = spark, [], []
        self.latest: dict[str, str] = {}

    def keep(self, df: DataFrame, label: str = "kept") -> DataFrame:
        path = new_path(self.spark, label)
        self.paths.append(path)
        return _write(df, path)

    def keep_latest(self, df: DataFrame, label: str) -> DataFrame:
        """A copy that takes the place of the last one of that label, which it may be made of."""
        kept = self.keep(df, label)
        old, self.latest[label] = self.latest.get(label), self.paths[-1]
        if old:
            self.paths.remove(old)
            _delete(self.spark, old)
        return kept

    def place(self, label: str) -> tuple[str, str]:
        """A table name and a path for it."""
        name, path = new_table_name(label, self.spark), new_path(self.spark, label)
        self.tables.append(name)
        self.paths.append(path)
        return name, path

    def bucketed(self, df: DataFrame, keys: list[str], label: str = "bucketed", placed: bool = False) -> DataFrame:
        """A copy hashed by ``keys``, so that joins on them need not move it.

        The bucket count equals the session's shuffle width, hence only the other side of
        such a join is shuffled. A bucket is written and read by one task: split keys with
        many rows by a further key. ``placed``: the rows lie that way already, as a join with such a copy leaves them.
        """
        buckets = shuffle_width(self.spark)
        name, path = self.place(label)
        with shuffles_freed(self.spark):
            (
                (df if placed else df.repartition(buckets, *keys))
                .write.format("parquet").bucketBy(buckets, *keys).option("path", path).saveAsTable(name)
            )
        return self.spark.table(name)

    def remove(self) -> None:
        for name in self.tables:
            _drop(self.spark, name)
        for path in self.paths:
            _delete(self.spark, path)


@contextmanager
def working_area(spark: SparkSession) -> Iterator[WorkingArea]:
    area = WorkingArea(spark)
    try:
        yield area
    finally:
        area.remove()
