"""Many-to-many joins, formed or only counted, and NOT IN."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlake.scratch import keep, shuffle_width


def _pairs(left: str, right: str):
    # A hot key on both sides can have more pairs than a BIGINT holds.
    return F.col(left).cast("decimal(19,0)") * F.col(right).cast("decimal(18,0)")


def pairs_by_key(
    left: DataFrame, right: DataFrame, key: str, left_item: str, right_item: str,
    left_name: str = "left_count", right_name: str = "right_count",
) -> DataFrame:
    """Per shared key: distinct items on each side and the number of joined pairs.

    No pair is built. Both sides shrink to one row per key before they meet, and
    distinct items are counted from (key, item) groups, which spread a hot key
    over all tasks.
    """
    rows = F.count(F.lit(1))
    per_left = left.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.count_distinct(left_item).alias(left_name), rows.alias("_left_rows")
    )
    per_right = right.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.count_distinct(right_item).alias(right_name), rows.alias("_right_rows")
    )
    return per_left.join(per_right, key).select(
        key, left_name, right_name, _pairs("_left_rows", "_right_rows").alias("pairs")
    )


def pair_totals(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Number of keys present on both sides and of joined pairs over all keys."""
    rows = F.count(F.lit(1))
    per_left = left.where(F.col(key).isNotNull()).groupBy(key).agg(rows.alias("_left_rows"))
    per_right = right.where(F.col(key).isNotNull()).groupBy(key).agg(rows.alias("_right_rows"))
    return per_left.join(per_right, key).agg(
        F.count(F.lit(1)).alias("shared_keys"), F.sum(_pairs("_left_rows", "_right_rows")).alias("pairs")
    )


#: Rows of one side that meet in a cell of a hot key's grid.
CELL_ROWS = 20_000
#: Tasks for each cell, so that few cells share one; and no more tasks than these.
TASKS_PER_CELL, MOST_TASKS = 4, 50_000


def grid_join(left: DataFrame, right: DataFrame, key: str, cell_rows: int = CELL_ROWS) -> DataFrame:
    """All pairs of rows with equal ``key``; the sides' other columns must have different names.

    Both sides' rows are counted per key. A key with more than ``cell_rows`` rows on a side is cut into as many pieces
    there as it needs; each row goes to one piece of its own side and to all pieces of the other. So the pairs of a key that
    is hot on both sides are a grid of cells, each no more than ``cell_rows`` rows square, in as many tasks.
    Other keys are one cell. Nulls join nothing.

    Both sides are dealt to a fixed number of tasks, several for each cell: what a task does is its pairs, so small
    partitions must neither be coalesced by their bytes nor the splits of a small file be joined as they are.
    """

    def pieces(side: DataFrame, name: str) -> DataFrame:
        rows = side.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
        return rows.select(key, F.ceil(F.col("_rows") / F.lit(cell_rows)).cast("int").alias(name))

    # A row per key that both sides have; only keys of more than one cell are joined to their rows.
    shape = pieces(left, "_rows_down").join(pieces(right, "_rows_across"), key)
    grid = keep(shape.where("_rows_down > 1 OR _rows_across > 1"), "grid")
    cells = grid.agg(F.sum(F.col("_rows_down").cast("long") * F.col("_rows_across"))).first()[0] or 0
    tasks = max(shuffle_width(left.sparkSession), min(TASKS_PER_CELL * cells, MOST_TASKS))

    def placed(side: DataFrame, own: str, other: str, cell: str, other_cell: str) -> DataFrame:
        mixed = F.xxhash64(*side.columns)
        at = side.join(grid, key, "left").withColumn(cell, F.coalesce(F.pmod(mixed, F.col(own)).cast("int"), F.lit(0)))
        everywhere = F.sequence(F.lit(0), F.coalesce(F.col(other), F.lit(1)) - 1)
        return at.withColumn(other_cell, F.explode(everywhere)).drop(own, other).repartition(tasks, key, "_down", "_across")

    down = placed(left, "_rows_down", "_rows_across", "_down", "_across")
    across = placed(right, "_rows_across", "_rows_down", "_across", "_down")
    return down.join(across, [key, "_down", "_across"]).drop("_down", "_across")


def not_in(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    """``left`` rows whose key is NOT IN the keys of ``right``, with SQL's rules for NULL.

    A NULL among the keys of ``right`` leaves nothing; a NULL key on the left stays only
    if ``right`` is empty. Written out as an anti join on distinct keys, because a
    null-aware anti join has to broadcast ``right`` whatever its size.
    """
    keys = keep(right.select(F.col(right_key).alias("_not_in")).distinct(), "keys")
    total, missing = keys.agg(F.count(F.lit(1)), F.count_if(F.col("_not_in").isNull())).first()
    if total == 0:
        return left
    if missing:
        return left.where(F.lit(False))
    present = left.where(F.col(left_key).isNotNull())
    return present.join(keys, F.col(left_key) == F.col("_not_in"), "left_anti")
