from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from airlake.scratch import new_path, new_table_name
from airlake.sinks.tables import analyze, load_partitions, overwrite_load, write_bucketed, write_partitioned, write_plain
from airlake.sources.layout import (
    bucket_of, bucket_report, bucket_sample, compare_layouts, file_sizes, layout_report, scan_work, split_report,
)


@pytest.fixture(scope="module")
def companies(spark):
    state = F.when(F.col("id") % 3 == 0, "F").when(F.col("id") % 3 == 1, "O").otherwise("it's")
    return spark.range(3000).select(
        F.format_string("%08d", "id").alias("code"), (F.col("id") % 50).alias("address"), state.alias("stan")
    )


def test_partition_pruning(spark, companies, plan):
    path = new_path(spark, "t")
    stored = write_partitioned(companies, new_table_name("t"), path, "stan")
    assert stored.columns == ["code", "address", "stan"]
    one = stored.where(F.col("stan") == "F")
    assert one.count() == 1000
    assert "PartitionFilters: [isnotnull(stan" in plan(one)
    report = {r.folder: r for r in layout_report(spark, path).collect()}
    assert set(report) == {"stan=F", "stan=O", "stan=it%27s"}  # names as they are on disk
    needed = compare_layouts(spark, {"filter": {"t": one}}, {"t": path}).first()
    assert needed.files_read == 1 and needed.bytes_read == report["stan=F"].bytes < needed.bytes
    assert (needed.answer, needed.rows_read) == (1000, 1000)


def test_loading_a_partition_again_changes_nothing(spark, companies):
    path = new_path(spark, "t")
    load_partitions(companies, path, "stan")
    load_partitions(companies.where(F.col("stan") == "O"), path, "stan")
    counts = spark.read.parquet(path).groupBy("stan").count()
    assert pytest.tuples(counts) == [("F", 1000), ("O", 1000), ("it's", 1000)]


def test_buckets(spark, companies, plan):
    path = new_path(spark, "t")
    stored = write_bucketed(companies, new_table_name("t"), path, "code", 10)
    report = bucket_report(spark, path).collect()
    assert sorted(r.bucket for r in report) == list(range(1, 11))
    assert [r.files for r in report] == [1] * 10
    point = stored.where(F.col("code") == "00000042")
    # Spark prunes buckets with or without this setting, but shows it only for bucketed scans.
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", False)
    try:
        assert "SelectedBucketsCount: 1 out of 10" in plan(point)
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    bucket = bucket_of(spark, "00000042", "string", 10)
    assert scan_work(point)["files_read"] == 1
    assert scan_work(bucket_sample(stored, "code", bucket, 10))["files_read"] == 10
    sample = bucket_sample(stored, "code", bucket, 10, stored=True)
    assert scan_work(sample.select("code"))["files_read"] == 1
    files = sample.select(F.regexp_extract(F.col("_metadata.file_name"), r"_(\d{5})\.", 1).alias("b")).distinct()
    assert [int(r.b) + 1 for r in files.collect()] == [bucket]
    assert sample.where(F.col("code") == "00000042").count() == 1
    sizes = [bucket_sample(companies, "code", b, 10).count() for b in range(1, 11)]
    assert sum(sizes) == 3000


def test_bucketed_join_needs_no_shuffle(spark, companies, plan):
    a = write_bucketed(companies, new_table_name("a"), new_path(spark, "a"), "code", 4)
    b = write_bucketed(companies, new_table_name("b"), new_path(spark, "b"), "code", 4)
    joined = a.hint("merge").join(b.withColumnRenamed("stan", "other"), "code")
    assert "Exchange" not in plan(joined)
    assert joined.count() == 3000


def test_hot_bucket_is_split_into_files(spark):
    """A third of the rows share one key; no task writes them all."""
    text = F.concat(F.sha2(F.col("id").cast("string"), 512), F.sha2((-F.col("id")).cast("string"), 512))
    rows = spark.range(60000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("code"), text.alias("text")
    ).repartition(8)
    path = new_path(spark, "hot")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        stored = write_bucketed(rows, new_table_name("hot"), path, "code", 4)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    hot_bucket = bucket_of(spark, 7, "bigint", 4)
    files = {r.bucket: r.files for r in bucket_report(spark, path).collect()}
    assert files[hot_bucket] > 1
    assert stored.count() == 60000 and stored.where("code = 7").count() == 20001


def test_plain_rebuild_load_and_statistics(spark, companies):
    name, path = new_table_name("t"), new_path(spark, "t")
    write_plain(companies, name, path)
    assert write_plain(companies, name, path).count() == 3000
    assert overwrite_load(companies.limit(10), name, path).count() == 10
    row = analyze(spark, name, ["code"]).first()
    assert row.rows == 10 and row.bytes > 0


def test_splits_follow_the_block_size(spark, companies):
    path = new_path(spark, "lines")
    companies.coalesce(1).write.csv(path)
    size = file_sizes(spark, path).first().bytes
    spark.conf.set("spark.sql.files.maxPartitionBytes", 8192)
    try:
        splits = split_report(spark.read.csv(path)).orderBy("start").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(splits) == -(-size // 8192)
    assert sum(r.rows for r in splits) == 3000
    assert sum(r.length for r in splits) == size


def test_a_failed_load_leaves_the_old_rows(spark, companies):
    from airlake.sinks.delimited import write_quoted_csv
    from airlake.sources.delimited import read_quoted_csv, strings

    path, name = new_path(spark, "t"), new_table_name("t")
    stored = overwrite_load(companies, name, path)
    broken = companies.withColumn("code", F.when(F.col("code") < "00002990", F.col("code")).otherwise(F.raise_error(F.lit("no"))))
    with pytest.raises(Exception, match="no"):
        overwrite_load(broken.repartition(3), name, path)
    assert spark.table(name).count() == 3000
    # A load may read what it replaces.
    assert overwrite_load(stored.where("stan = 'F'"), name, path).count() == 1000
    assert spark.read.parquet(path).count() == 1000

    text = new_path(spark, "csv")
    write_quoted_csv(companies.limit(10), text)
    with pytest.raises(Exception, match="line break"):
        write_quoted_csv(companies.withColumn("code", F.concat("code", F.lit("\n"))), text)
    assert read_quoted_csv(spark, text, strings("code", "address", "stan")).count() == 10
    from pathlib import Path

    beside = {f.name for f in Path(path).parent.iterdir()}
    assert not any("-staged-" in n or "-old-" in n for n in beside)


def test_publishing_what_cannot_be_moved_leaves_the_old(spark, tmp_path, monkeypatch):
    import airlake.sinks.publish as module

    target = tmp_path / "data"
    spark.range(5).write.parquet(str(target))
    real = module._file_system

    class Stuck:
        def __init__(self, files):
            self.files = files

        def __getattr__(self, name):
            return getattr(self.files, name)

        def rename(self, a, b):
            return "-staged-" not in a.getName() and self.files.rename(a, b)

    monkeypatch.setattr(module, "_file_system", lambda s, p: (Stuck(real(s, p)[0]), real(s, p)[1]))
    with pytest.raises(OSError, match="published"):
        module.publish(spark, str(target), lambda staged: spark.range(9).write.parquet(staged))
    assert spark.read.parquet(str(target)).count() == 5
    assert {f.name for f in tmp_path.iterdir()} == {"data"}


def test_rounds_go_on_after_the_last_recorded_one(spark):
    from airlake.rounds import RoundLog, run_rounds

    folder, steps = new_path(spark, "rounds"), []

    def step(df):
        steps.append(1)
        return df.select((F.col("id") * 2).alias("id"))

    def first():
        return spark.range(3)

    assert pytest.tuples(run_rounds(RoundLog(spark, folder), first, step, 4, every=2)) == [(0,), (16,), (32,)]
    assert RoundLog(spark, folder).rounds() == [2, 4] and len(steps) == 4
    assert pytest.tuples(run_rounds(RoundLog(spark, folder), first, step, 7, every=2)) == [(0,), (128,), (256,)]
    assert len(steps) == 7 and RoundLog(spark, folder).rounds() == [6, 7]
    assert pytest.tuples(run_rounds(RoundLog(spark, folder), first, step, 7, every=2)) == [(0,), (128,), (256,)]
    assert len(steps) == 7


def test_pagerank_goes_on_after_a_stop(spark, monkeypatch):
    import airlake.graph.pagerank as module
    from airlake.graph import Graph
    from airlake.rounds import RoundLog

    edges = [(i, (i * 7 + j) % 30) for i in range(30) for j in range(1, 4)]
    graph = Graph(spark.range(30), spark.createDataFrame(edges, "src BIGINT, dst BIGINT"))
    whole = {r.id: r.pagerank for r in module.pagerank(graph, max_iter=20).collect()}
    log, seen = RoundLog(spark, new_path(spark, "rounds")), []
    module.pagerank(graph, max_iter=10, log=log)
    assert log.rounds()[-1] == 10
    real = RoundLog.record
    monkeypatch.setattr(RoundLog, "record", lambda self, n, df: seen.append(n) or real(self, n, df))
    assert {r.id: r.pagerank for r in module.pagerank(graph, max_iter=20, log=log).collect()} == pytest.approx(whole)
    assert seen == [15, 20]


def test_column_statistics(spark, companies):
    from airlake.sinks.tables import column_statistics, optimizing_session

    name = new_table_name("t")
    write_plain(companies.withColumn("address", F.when(F.col("address") > 0, F.col("address"))), name, new_path(spark, "t"))
    assert [(r.column, r.nulls, r.bins) for r in column_statistics(spark, name, ["address"]).collect()] == [("address", None, 0)]
    own = optimizing_session(spark)
    analyze(own, name, ["address", "stan"])
    known = {r.column: r for r in column_statistics(own, name, ["address", "stan"]).collect()}
    assert (known["address"].nulls, known["address"].least, known["address"].most) == (60, "1", "49")
    assert known["stan"].distinct == 3 and abs(known["address"].distinct - 49) <= 4 and known["address"].bins > 0
    assert spark.conf.get("spark.sql.cbo.enabled") == "false"
