"""Data that appears whole or not at all."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def publish(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Write to a folder beside ``path``, then put it in that place.

    ``write`` gets the folder to write to. If it fails, that folder goes and what was at ``path`` stays; it may
    read ``path`` as well. The old data are moved aside by one rename and the new ones moved in by another, and
    moved back if that fails. On file systems without renames, such as object stores, Hadoop copies instead.
    """
    files, target = _file_system(spark, path.rstrip("/"))
    mark, parent = uuid.uuid4().hex, target.getParent()
    named = spark._jvm.org.apache.hadoop.fs.Path
    staged, aside = (named(parent, f".{target.getName()}-{kind}-{mark}") for kind in ("staged", "old"))
    try:
        write(staged.toString())
        files.mkdirs(parent)
        there = files.exists(target)
        if there and not files.rename(target, aside):
            raise OSError(f"{target} could not be moved aside")
        if not files.rename(staged, target):
            if there:
                files.rename(aside, target)
            raise OSError(f"{target} could not be published")
        if there:
            files.delete(aside, True)
    finally:
        if files.exists(staged):
            files.delete(staged, True)
