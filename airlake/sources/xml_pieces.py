"""Records of a text scan that was cut at closing tags, put together where a tag was only text.

A scan's pieces end at every closing tag, also at one inside a comment or a CDATA section. Which state a piece begins in
depends on all before it in its file. So each split of the scan first says where it ends, and how many records end in
it, for each state it may begin in; a row per split is followed along the file; then every split, which now knows its
state, gives its records. Only records that reach over splits are gathered afterwards.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlake.scratch import keep

#: States: text, inside a CDATA section, inside a comment; what opens and closes the latter two.
TEXT, CDATA, COMMENT = range(3)
MARK = re.compile(rb"<!\[CDATA\[|\]\]>|<!--|-->")
OPENS = {b"<![CDATA[": CDATA, b"<!--": COMMENT}
CLOSES = {CDATA: b"]]>", COMMENT: b"-->"}

SUMMARY = "file STRING, start BIGINT, ends ARRAY<INT>, records ARRAY<BIGINT>"
BEGIN = "file STRING, start BIGINT, state INT, record BIGINT"
PIECE = "file STRING, record BIGINT, start BIGINT, whole BOOLEAN, value BINARY"


def state_after(piece: bytes, state: int) -> int:
    for mark in MARK.findall(piece):
        if state == TEXT:
            state = OPENS.get(mark, TEXT)
        elif mark == CLOSES[state]:
            state = TEXT
    return state


def element_of(record: bytes, tag: re.Pattern) -> bytes:
    """What begins with the first opening tag outside comments and CDATA; nothing where there is none."""
    state, at = TEXT, 0
    for mark in [*MARK.finditer(record), None]:
        end = mark.start() if mark else len(record)
        found = tag.search(record, at, end + 1) if state == TEXT else None
        if found and found.start() < end:
            return record[found.start() :]
        if mark:
            state, at = state_after(mark.group(), state), mark.end()
    return b""


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def _batches(rows: Iterator[tuple], schema: pa.Schema, most: int = 1000) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == most:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _mapped(df: DataFrame, function, ddl: str) -> DataFrame:
    """``function`` over a task's rows as they come."""
    types = {"STRING": pa.string(), "BIGINT": pa.int64(), "INT": pa.int32(), "BOOLEAN": pa.bool_(), "BINARY": pa.binary(),
             "ARRAY<INT>": pa.list_(pa.int32()), "ARRAY<BIGINT>": pa.list_(pa.int64())}
    schema = pa.schema([(name, types[kind]) for name, kind in (field.split() for field in ddl.split(", "))])
    return df.mapInArrow(lambda batches: _batches(function(_rows(batches)), schema), ddl)


def _summaries(rows: Iterator[tuple]) -> Iterator[tuple]:
    for (file, start), pieces in groupby(rows, key=lambda row: row[:2]):
        states, records = [TEXT, CDATA, COMMENT], [0, 0, 0]
        for *_, value in pieces:
            for i, state in enumerate(states):
                states[i] = state_after(value, state)
                records[i] += states[i] == TEXT
        yield file, start, states, records


def _followed(rows: Iterator[tuple]) -> Iterator[tuple]:
    for file, splits in groupby(rows, key=lambda row: row[0]):
        state, record = TEXT, 0
        for _, start, ends, records in splits:
            yield file, start, state, record
            state, record = ends[state], record + records[state]


def whole_records(pieces: DataFrame, closing: str, row_tag: str) -> DataFrame:
    """(value): records of a scan's pieces, each from its opening tag on, its last closing tag left out as in the pieces.

    Records may span pieces and splits; one is held whole by a task.
    """
    between, tag = closing.encode(), re.compile(rf"<{row_tag}[\s>]".encode())

    def records(rows: Iterator[tuple]) -> Iterator[tuple]:
        for (file, start, state, record), own in groupby(rows, key=lambda row: row[:4]):
            held, whole = [], state == TEXT
            for *_, value in own:
                held.append(value)
                state = state_after(value, state)
                if state == TEXT:
                    yield file, record, start, whole, between.join(held)
                    held, whole, record = [], True, record + 1
            if held:
                yield file, record, start, False, between.join(held)

    def elements(rows: Iterator[tuple]) -> Iterator[tuple]:
        for (value,) in rows:
            yield (element_of(value, tag),)

    scan = pieces.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").cast("binary").alias("value")
    )
    splits = _mapped(scan, _summaries, SUMMARY)
    begins = keep(_mapped(splits.repartition("file").sortWithinPartitions("file", "start"), _followed, BEGIN), "splits")
    # A row per split of the scan; the pieces stay in their order.
    placed = scan.join(F.broadcast(begins), ["file", "start"]).select("file", "start", "state", "record", "value")
    found = keep(_mapped(placed, records, PIECE), "records")
    parts = F.sort_array(F.collect_list(F.struct("start", F.col("value").cast("string").alias("value"))))["value"]
    torn = found.where("NOT whole").groupBy("file", "record").agg(F.array_join(parts, closing).alias("value"))
    every = found.where("whole").select("value").union(torn.select(F.col("value").cast("binary")))
    return _mapped(every, elements, "value BINARY").select(F.col("value").cast("string").alias("value"))
