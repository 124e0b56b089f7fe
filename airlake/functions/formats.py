"""Readable sizes, labels and file numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNITS = ("B", "KB", "MB", "GB")  # fixed values


def format_bytes(size: Column) -> Column:
    """Bytes as text in the unit that keeps the number below 1024; one decimal from KB on."""
    def shown(power: int) -> Column:
        # Halves go to the even digit: 1.25 KB is shown as 1.2 KB.
        return F.format_string(f"%.1f {UNITS[power]}", F.bround(size.cast("double") / 1024**power, 1))

    return (
        F.when(size < 1024, F.format_string(f"%d {UNITS[0]}", size.cast("long")))
        .when(size < 1024**2, shown(1))
        .when(size < 1024**3, shown(2))
        .otherwise(shown(3))
    )


def label_with_value(label: Column, value: Column) -> Column:
    """``CODE (12.3)``."""
    return F.format_string("%s (%.1f)", label, value)


def bucket_number(file_name: Column) -> Column:
    """Bucket, counted from 1, that a bucketed table's file belongs to."""
    return F.regexp_extract(file_name, r"_(\d{5})\.", 1).cast("int") + 1
