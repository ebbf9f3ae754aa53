"""Quoted CSV read in byte ranges (S1): records with embedded newlines, over every split of a file.

Spark's multi-line reader gives a whole file to one task.  Here the file is read as physical lines, whose scan is
split like any text.  Whether a line starts a record depends on the quotes before it, so every split is looked at
under both assumptions (it starts outside or inside a quoted field): a split is a function of two values, with the
number of records it starts under each.  Composing these functions along a file gives every split its true start
and the number of its first record.  A second scan then cuts the records; only those that cross a split border
travel, to be joined, and fields are parsed by ``from_csv``.

A line's function is that of the quotes in it: a quote opens a field only at the field's start, two quotes inside
are one, and after a closing quote the field runs on to the delimiter.  Lines without a quote change nothing.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stored

#: Up to so many splits (one row of some 40 bytes each) their table is broadcast; beyond, lines are dealt by split.
BROADCAST_SPLITS = 100_000

SPLITS = "file STRING, start BIGINT, out_inside BOOLEAN, out_records BIGINT, in_inside BOOLEAN, in_records BIGINT"
STARTS = "file STRING, start BIGINT, inside BOOLEAN, first BIGINT"
PARTS = "file STRING, record BIGINT, start BIGINT, crossing BOOLEAN, text STRING"


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a quoted field is open at the end of a physical line that starts outside or inside one."""
    if '"' not in line:
        return inside
    at = 0
    while True:
        if not inside:
            if not line.startswith('"', at):
                at = line.find(",", at) + 1
                if not at:
                    return False
                continue
            at += 1
        quote = line.find('"', at)
        if quote < 0:
            return True
        inside = line.startswith('"', quote + 1)
        at = quote + 2
        if not inside:  # closed: on to the delimiter
            at = line.find(",", quote + 1) + 1
            if not at:
                return False


def _lines(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows ``(file, start, *rest, value)`` in scan order; a carriage return before the line end is part of it."""
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns))


def _plain(line: str) -> str:
    return line[:-1] if line.endswith("\r") else line


def summarise(lines: Iterable[str]) -> tuple[bool, int, bool, int]:
    """``(ends inside, records started)`` of a split that starts outside, then of one that starts inside a quoted field."""
    state, count = [False, True], [0, 0]
    for line in lines:
        line = _plain(line)
        for k in (0, 1):
            if not state[k] and line:
                count[k] += 1
        state = [ends_inside(line, s) for s in state]
    return state[0], count[0], state[1], count[1]


def _summaries(batches):
    schema = pa.schema([("file", pa.string()), ("start", pa.int64()), ("out_inside", pa.bool_()), ("out_records", pa.int64()),
                        ("in_inside", pa.bool_()), ("in_records", pa.int64())])
    rows = [(*key, *summarise(line for *_, line in lines)) for key, lines in groupby(_lines(batches), key=lambda r: r[:2])]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _compose(table: pa.Table) -> pa.Table:
    """One file's splits, in order: the state and the record number that each starts with."""
    rows = table.sort_by("start").to_pydict()
    inside, first, out = False, 0, []
    for start, *f in zip(rows["start"], rows["out_inside"], rows["out_records"], rows["in_inside"], rows["in_records"]):
        out.append((start, inside, first))
        first += f[3 if inside else 1]
        inside = f[2 if inside else 0]
    return pa.table([pa.array(rows["file"], pa.string()), *(pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.bool_(), pa.int64())))],
                    names=["file", "start", "inside", "first"])


def records(lines: Iterable[str], inside: bool, first: int) -> Iterator[tuple[int, bool, str]]:
    """``(record number, crosses a border, text)`` of one split's records and parts of records."""
    held: list[str] = []
    number, crossing = first - 1, inside
    for line in lines:
        line = _plain(line)
        if not inside:
            if not line:
                continue
            number += 1
        held.append(line)
        inside = ends_inside(line, inside)
        if not inside:
            yield number, crossing, "\n".join(held)
            held, crossing = [], False
    if held:
        yield number, True, "\n".join(held)


def _records(batches):
    schema = pa.schema([("file", pa.string()), ("record", pa.int64()), ("start", pa.int64()), ("crossing", pa.bool_()), ("text", pa.string())])
    rows: list[tuple] = []
    size = 0
    for (file, start, inside, first), lines in groupby(_lines(batches), key=lambda r: r[:4]):
        for number, crossing, text in records((line for *_, line in lines), inside, first):
            rows.append((file, number, start, crossing, text))
            size += len(text) + 64
            if size > 4 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                rows, size = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def read_records(spark: SparkSession, path: str, broadcast_splits: int = BROADCAST_SPLITS) -> DataFrame:
    """``(file, record, text)``: every CSV record of the files at ``path`` with its number in its file, blank lines left out."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.input_file_name().alias("file"), F.input_file_block_start().alias("start"), "value")
    starts = stored(lines.mapInArrow(_summaries, SPLITS).groupBy("file").applyInArrow(_compose, STARTS), "csv-splits")
    if starts.count() <= broadcast_splits:
        known = lines.join(F.broadcast(starts), ["file", "start"])  # keeps the scan's order
    else:
        known = (lines.withColumn("line", F.monotonically_increasing_id()).join(starts, ["file", "start"])
                 .repartition("file", "start").sortWithinPartitions("file", "start", "line"))
    parts = stored(known.select("file", "start", "inside", "first", "value").mapInArrow(_records, PARTS), "csv-records")
    joined = (parts.where("crossing").groupBy("file", "record").agg(F.sort_array(F.collect_list(F.struct("start", "text"))).alias("p"))
              .select("file", "record", F.array_join("p.text", "\n").alias("text")))
    return parts.where("NOT crossing").select("file", "record", "text").unionByName(joined)
