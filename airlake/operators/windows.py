"""Numbering, top rows and best rows per group."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airlake.scratch import keep


def number_within(df: DataFrame, keys: list[str], order: list[Column], name: str = "rn") -> DataFrame:
    """Add the row's position within its group; ``order`` must be a total order.

    All rows are cut into ordered slices by range partitioning, whatever the sizes of the
    groups. Each slice numbers its own rows, and a group that began in earlier slices is
    moved by the rows it has there. No task sorts more than a slice.
    """
    columns = [F.col(k) for k in keys]
    # Written once: range boundaries come from a sample, so both uses below must see the same slices.
    slices = keep(df.repartitionByRange(*columns, *order).withColumn("_slice", F.spark_partition_id()), "slices")
    in_slice = Window.partitionBy(*keys, "_slice").orderBy(*order)
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    here = [*keys, "_slice"]
    # Only the first group of a slice can have begun before it: no more rows than slices.
    moved = (
        slices.groupBy(*here)
        .agg(F.count(F.lit(1)).alias("_size"))
        .withColumn("_before", F.sum("_size").over(earlier))
        .where("_before > 0")
        .select(*(F.col(k).alias(f"_of_{k}") for k in here), "_before")
    )
    same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in here))
    return (
        slices.withColumn("_position", F.row_number().over(in_slice))
        .join(F.broadcast(moved), same, "left")
        .withColumn(name, (F.col("_position") + F.coalesce("_before", F.lit(0))).cast("long"))
        .select(*df.columns, name)
    )


def top_n_per_group(df: DataFrame, keys: list[str], order: list[Column], n: int, name: str = "rank") -> DataFrame:
    """The first ``n`` rows per group.

    The rank filter is pushed below the shuffle, so each task forwards no more
    than ``n`` rows of a group however many it holds.
    """
    by_group = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(by_group)).where(F.col(name) <= n)


def largest_per_group(df: DataFrame, keys: list[str], value: str, item: str) -> DataFrame:
    """The item with the largest value per group, the smallest item on ties.

    An aggregate with map-side combining, not a window: nothing is sorted.
    """
    best = F.min(F.struct((-F.col(value)).alias("neg"), F.col(item).alias("item")))
    return (
        df.groupBy(*keys)
        .agg(best.alias("_best"))
        .select(*keys, F.col("_best.item").alias(item), (-F.col("_best.neg")).alias(value))
    )
