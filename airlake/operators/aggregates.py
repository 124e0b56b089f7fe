"""Aggregates that need more than one built-in function."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airlake.operators.windows import number_within


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its number of rows."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def listed(df: DataFrame, keys: list[str], item: str, tie_break: list[str] | None = None) -> DataFrame:
    """(keys, position, item): the sorted list of each group, an item a row.

    The long form holds groups of any size. NULL items are skipped.
    """
    order = [F.col(item), *(F.col(c) for c in tie_break or [])]
    present = df.where(F.col(item).isNotNull()).select(*keys, item, *(tie_break or []))
    return number_within(present, keys, order, "position").select(*keys, "position", F.col(item).alias("item"))


def concat_sorted(df: DataFrame, keys: list[str], item: str, name: str, separator: str = ", ") -> DataFrame:
    """The sorted list of each group as one text, for groups known to fit in one; ``listed`` for others."""
    return df.groupBy(*keys).agg(F.array_join(F.sort_array(F.collect_list(item)), separator).alias(name))


def ranked_list(df: DataFrame, keys: list[str], rank: str, item: str, name: str, separator: str = ", ") -> DataFrame:
    """Already limited items joined in rank order (for top-n results)."""
    ordered = F.array_sort(F.collect_list(F.struct(rank, item)))
    return df.groupBy(*keys).agg(F.array_join(ordered[item], separator).alias(name))


def share(part: Column, whole: Column, digits: int) -> Column:
    return F.round(part / whole, digits)
