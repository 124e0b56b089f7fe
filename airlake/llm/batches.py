"""Arrow batches in and out of Python tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc

CHUNK_CHARS = 1 << 20
#: What gives back the memory of ``remembered`` functions.
_clearing: list[Callable[[], None]] = []


def remembered(most: int) -> Callable:
    """``lru_cache`` for what a worker keeps from task to task, until ``forget``."""

    def cached(function: Callable) -> Callable:
        found = lru_cache(maxsize=most)(function)
        _clearing.append(found.cache_clear)
        return found

    return cached


def forget() -> None:
    """Give back what earlier tasks remembered; workers are used again by stages that have no use for it."""
    for clear in _clearing:
        clear()
    pa.default_memory_pool().release_unused()


def chunks(batch: pa.RecordBatch, column: str, most: int = CHUNK_CHARS) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``most`` bytes of text each, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = held = 0
    for i, size in enumerate(sizes):
        if held and held + size > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield batch.slice(start)

