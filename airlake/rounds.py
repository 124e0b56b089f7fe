"""Loops whose rounds are recorded, so that a new driver goes on where the last one stopped."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from airlake.scratch import shuffles_freed
from airlake.sinks.publish import publish


class RoundLog:
    """States of a loop below a folder, one per recorded round.

    A state appears by one rename after it is written, so every state listed is whole. The folder belongs to one loop
    over one input; a loop over other input needs another folder.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def rounds(self) -> list[int]:
        """The recorded rounds in order."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(path):
            return []
        names = [status.getPath().getName() for status in files.listStatus(path)]
        return sorted(int(name.removeprefix("round=")) for name in names if name.startswith("round="))

    def record(self, round_: int, state: DataFrame) -> DataFrame:
        """Keep a round's state and read it back; earlier states but the last go."""
        path = f"{self.folder}/round={round_}"
        with shuffles_freed(self.spark):
            publish(self.spark, path, lambda staged: state.write.parquet(staged))
        for old in self.rounds()[:-2]:
            hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/round={old}")
            hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(hadoop, True)
        return self.spark.read.schema(state.schema).parquet(path)

    def last(self, at_most: int) -> tuple[int, DataFrame] | None:
        """The last recorded round up to ``at_most`` and its state."""
        known = [r for r in self.rounds() if r <= at_most]
        return (known[-1], self.spark.read.parquet(f"{self.folder}/round={known[-1]}")) if known else None


def run_rounds(
    log: RoundLog, initial: Callable[[], DataFrame], step: Callable[[DataFrame], DataFrame], rounds: int, every: int = 5
) -> DataFrame:
    """The state after ``rounds`` steps, of which those up to the last recorded one are not taken again."""
    found = log.last(rounds)
    done, state = found if found else (0, initial())
    for round_ in range(done + 1, rounds + 1):
        state = step(state)
        if round_ % every == 0 or round_ == rounds:
            state = log.record(round_, state)
    return state
