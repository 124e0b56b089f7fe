"""Dialogues rendered from every participant's perspective.

For each speaker of a conversation that speaker's turns become the assistant's, all
others are users with their names, and the mask covers what the assistant says. Turns come
as rows in order with their place in the rendered text, so that a dialogue of any length is
whole without being gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airlake.scratch import keep

SYSTEM = "system"
NOBODY = "unknown"


def escaped(text: Column) -> Column:
    """Text that cannot be taken for a mark of the format."""
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def header(own: Column, speaker: Column) -> Column:
    name = F.regexp_replace(speaker, "[^A-Za-z0-9_.-]", "_")
    return (
        F.when(speaker == SYSTEM, "<|im_start|>system\n")
        .when(own, "<|im_start|>assistant\n")
        .otherwise(F.concat(F.lit("<|im_start|>user name="), name, F.lit("\n")))
    )


def running_start(df: DataFrame, keys: list[str], order: list[str], size: str, name: str) -> DataFrame:
    """Add the sum of ``size`` over the earlier rows of the group; ``order`` must be total.

    Rows are cut into ordered slices whatever the sizes of the groups; each slice is summed
    by itself and moved by what its group holds in earlier slices.
    """
    # Written once: the borders of the slices come from a sample.
    sliced = keep(df.repartitionByRange(*keys, *order).withColumn("_slice", F.spark_partition_id()), "slices")
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # A slice begins within one group at most, so there are no more such rows than slices.
    moved = (
        sliced.groupBy(*keys, "_slice")
        .agg(F.sum(size).alias("_size"))
        .withColumn("_before", F.sum("_size").over(earlier))
        .where("_before > 0")
        .select(*(F.col(k).alias(f"_of_{k}") for k in [*keys, "_slice"]), "_before")
    )
    same = [F.col(k) == F.col(f"_of_{k}") for k in [*keys, "_slice"]]
    inside = Window.partitionBy(*keys, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        sliced.withColumn("_inside", F.coalesce(F.sum(size).over(inside), F.lit(0)))
        .join(F.broadcast(moved), same, "left")
        .withColumn(name, (F.col("_inside") + F.coalesce("_before", F.lit(0))).cast("long"))
        .select(*df.columns, name)
    )


def perspectives(
    turns: DataFrame,
    conversation_column: str = "conv_id",
    turn_column: str = "turn",
    speaker_column: str = "role",
    text_column: str = "text",
) -> DataFrame:
    """Every dialogue once for each participant, a row per turn.

    Columns: ``conversation``, ``perspective`` (the participant), ``turn``, ``speaker``,
    ``rendered``, ``start`` and ``end`` (characters in the whole rendering, end exclusive),
    ``mask_start`` and ``mask_end`` (what is learned, the end mark included; null for
    others' turns).

    Participants are the speakers other than ``system``, whose turns nobody's rendering
    lacks and nobody learns; a conversation of system turns alone has no rows. A null
    speaker is ``unknown``, a null text is empty, null turns come first. Rows of a null
    conversation are left out. Turns of one number are ordered by speaker, then by the MD5
    of their texts; repeated rows are turns each. Names keep ASCII letters, digits and
    ``._-``, ``<|`` in a text becomes ``< |``. No rows give no rows.
    """
    rows = (
        turns.select(
            F.col(f"`{conversation_column}`").alias("conversation"), F.col(f"`{turn_column}`").alias("turn"),
            F.coalesce(F.col(f"`{speaker_column}`").cast("string"), F.lit(NOBODY)).alias("speaker"),
            escaped(F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit(""))).alias("text"),
        )
        .where("conversation IS NOT NULL")
        .withColumn("place", F.monotonically_increasing_id())  # parts rows that are equal
    )
    participants = (
        rows.where(F.col("speaker") != SYSTEM)
        .select("conversation", F.col("speaker").alias("perspective"))
        .distinct()
    )
    own = F.col("speaker") == F.col("perspective")
    each = rows.join(participants, "conversation").withColumn("header", header(own, F.col("speaker")))
    each = each.select(
        "conversation", "perspective", "turn", "speaker", "place", F.md5(F.col("text").cast("binary")).alias("digest"),
        F.length("header").alias("head"), F.concat("header", "text", F.lit("<|im_end|>\n")).alias("rendered"),
    ).withColumn("size", F.length("rendered").cast("long"))
    started = running_start(each, ["conversation", "perspective"], ["turn", "speaker", "digest", "place"], "size", "start")
    end = F.col("start") + F.col("size")
    return started.select(
        "conversation", "perspective", "turn", "speaker", "rendered", "start", end.alias("end"),
        F.when(own, F.col("start") + F.col("head")).alias("mask_start"), F.when(own, end - 1).alias("mask_end"),
    )


def as_examples(rendered: DataFrame) -> DataFrame:
    """Whole dialogues in one row each, for conversations that are known to be short.

    Columns: ``conversation``, ``perspective``, ``text``, ``masks`` (spans to learn).
    """
    pieces = F.sort_array(F.collect_list(F.struct("start", "rendered")))["rendered"]
    mask = F.when(F.col("mask_start").isNotNull(), F.struct("mask_start", "mask_end"))
    return rendered.groupBy("conversation", "perspective").agg(
        F.array_join(pieces, "").alias("text"), F.sort_array(F.collect_list(mask)).alias("masks")
    )
