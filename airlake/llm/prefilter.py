"""Cheap reductions of rows before they are shuffled or sampled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Different hash values that are broadcast at most, 16 bytes each in a task's table.
BUCKETS = 1 << 20


def may_match(rows: DataFrame, keys: DataFrame, column: str, how: str = "left_semi") -> DataFrame:
    """Rows whose ``column`` hashes like one of ``keys``, hence all that an inner or semi join keeps.

    With ``left_anti`` the other rows, which match none. What is broadcast are hash values
    below ``BUCKETS``, however many keys there are. Few keys leave few rows to be shuffled;
    with very many, all rows pass as without it. Null keys match nothing.
    """
    bucket = F.pmod(F.xxhash64(column), F.lit(BUCKETS)).cast("int")
    present = keys.where(F.col(column).isNotNull()).select(bucket.alias("_bucket")).distinct()
    return rows.join(F.broadcast(present), bucket == F.col("_bucket"), how)


def among_the_lowest(key: Column, share: Column | float) -> Column:
    """Whether a row's ``key`` hashes into the lowest ``share`` of all values.

    Taken before the lowest ``n`` of very many rows are looked for, with a share that leaves
    some times ``n``: what tasks then send to one place doesn't grow with their number.
    """
    return F.pmod(F.xxhash64(key), F.lit(1 << 30)) < F.lit(float(1 << 30)) * (share if isinstance(share, Column) else F.lit(share))


def hash_order(key: Column) -> Column:
    """The order in which ``among_the_lowest`` has its rows first."""
    return F.pmod(F.xxhash64(key), F.lit(1 << 30))
