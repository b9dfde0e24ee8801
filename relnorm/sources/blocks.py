"""Records of large JSON arrays and quoted CSVs, read by many tasks.

Where a record ends depends on everything before it: a line break counts only
outside quotes, a comma only at the array's own level.  But a block of bytes
changes that state in a way that can be computed without knowing it: it flips
"inside quotes" or not, and it moves the bracket depth by one amount if it
starts outside a string and by another if inside.  So files are cut into
blocks, each is summarised by its own task, a running sum over a file's few
block rows gives every block its state, and a second pass reads the records
that start in each block, running on past its end for the last one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from relnorm.session import stage
from relnorm.sources.files import open_input

BLOCK_BYTES = 32 << 20
#: Small blocks share tasks: by bytes, but up to this many tasks have one block each.
TASK_BYTES, MIN_TASKS = 32 << 20, 64
AHEAD_BYTES = 1 << 20
BATCH_ROWS, BATCH_BYTES = 4096, 8 << 20

_QUOTE, _BACKSLASH, _NEWLINE, _RETURN = 34, 92, 10, 13
_OPEN, _CLOSE = (91, 123), (93, 125)
_SUMMARY = pa.schema([("path", pa.string()), ("length", pa.int64()), ("block", pa.int64()), ("start", pa.int64()),
                      ("stop", pa.int64()), ("flips", pa.int64()), ("depth0", pa.int64()), ("depth1", pa.int64()),
                      ("bad0", pa.bool_()), ("bad1", pa.bool_())])
_RECORDS = pa.schema([("path", pa.string()), ("at", pa.int64()), ("text", pa.string())])


def _cut(fh, at: int, length: int) -> int:
    """The block edge ``at`` moved on past a run of backslashes, so that no escape is cut."""
    if at <= 0 or at >= length:
        return min(max(at, 0), length)
    fh.seek(at - 1)
    before = fh.read(1)
    while before == b"\\" and at < length:
        at += 1
        before = fh.read(1)
    return at


class _Json:
    """Top-level elements of an array: strings with escapes, brackets outside of them."""

    @staticmethod
    def quotes(data: np.ndarray) -> np.ndarray:
        """Places of quotes that open or close a string (an escaped one does neither)."""
        places = np.flatnonzero(data == _QUOTE)
        slash = data == _BACKSLASH
        if not slash.any():
            return places
        # length of the run of backslashes that ends before each place
        last_other = np.maximum.accumulate(np.where(slash, -1, np.arange(len(data))))
        run = places - 1 - np.where(places > 0, last_other[places - 1], -1)
        return places[run % 2 == 0]

    @classmethod
    def summary(cls, data: np.ndarray, before: int, after: int):
        toggles = np.zeros(len(data), np.int8)
        toggles[cls.quotes(data)] = 1
        inside = (np.cumsum(toggles, dtype=np.int64) & 1).astype(bool)
        step = np.isin(data, _OPEN).astype(np.int64) - np.isin(data, _CLOSE)
        return int(toggles.sum()), int(step[~inside].sum()), int(step[inside].sum()), False, False

    @classmethod
    def bounds(cls, data: np.ndarray, inside: bool, depth: int):
        """Places of what parts the elements: the opening bracket, commas and the closing bracket of the array."""
        toggles = np.zeros(len(data), np.int8)
        toggles[cls.quotes(data)] = 1
        out = ((np.cumsum(toggles, dtype=np.int64) + inside) & 1) == 0
        opens, closes = np.isin(data, _OPEN) & out, np.isin(data, _CLOSE) & out
        level = depth + np.cumsum(opens.astype(np.int64) - closes)   # after each byte
        comma = (data == 44) & out & (level == 1)
        return np.flatnonzero(comma | (opens & (level == 1)) | (closes & (level == 0)))


class _Csv:
    """Lines outside quotes; every quote flips, a doubled one twice."""

    @staticmethod
    def summary(data: np.ndarray, before: int, after: int):
        quote = data == _QUOTE
        odd = np.cumsum(quote, dtype=np.int64) & 1
        places = np.flatnonzero(quote)
        around = np.concatenate([[before], data, [after]])
        parts = np.array([44, _NEWLINE, _RETURN, -1])
        starts_field, ends_field = np.isin(around[places], parts), np.isin(around[places + 2], parts)
        doubled = (around[places] == _QUOTE) | (around[places + 2] == _QUOTE)
        opening = odd[places] == 1
        # a quote must open at a field's start, close at its end or be one of two
        bad0 = bool((~np.where(opening, starts_field, ends_field) & ~doubled).any())
        bad1 = bool((~np.where(opening, ends_field, starts_field) & ~doubled).any())
        return int(quote.sum()), 0, 0, bad0, bad1

    @staticmethod
    def bounds(data: np.ndarray, inside: bool, depth: int):
        out = ((np.cumsum(data == _QUOTE, dtype=np.int64) + inside) & 1) == 0
        return np.flatnonzero((data == _NEWLINE) & out)


_KINDS = {"json": _Json, "csv": _Csv}


def _summaries(kind: str, block_bytes: int, parts: Iterator[pa.RecordBatch]):
    for part in parts:
        rows = []
        for r in part.to_pylist():
            with open_input(r["path"]) as fh:
                start = _cut(fh, r["block"] * block_bytes, r["length"])
                stop = _cut(fh, (r["block"] + 1) * block_bytes, r["length"])
                fh.seek(max(start - 1, 0))
                raw = fh.read(stop - max(start - 1, 0) + 1)
            before = raw[0] if start else -1
            data = np.frombuffer(raw, np.uint8).astype(np.int16)[1 if start else 0:]
            after = int(data[stop - start]) if len(data) > stop - start else -1
            rows.append({**r, "start": start, "stop": stop, **dict(zip(
                ("flips", "depth0", "depth1", "bad0", "bad1"),
                _KINDS[kind].summary(data[:stop - start], before, after)))})
        yield pa.RecordBatch.from_pylist(rows, schema=_SUMMARY)


def _block_records(kind: str, r: dict):
    """``(place, bytes)`` of the records that start in a block; the array's or file's start opens the first one."""
    machine = _KINDS[kind]
    with open_input(r["path"]) as fh:
        fh.seek(r["start"])
        data = fh.read(r["stop"] - r["start"])
        size, end = len(data), r["stop"]
        numbers = np.frombuffer(data, np.uint8)
        bounds = machine.bounds(numbers, bool(r["inside"]), r["depth"])
        starts = (bounds + 1).tolist()
        if kind == "csv" and r["start"] == 0:
            starts.insert(0, 0)
        starts = [s for s in starts if s < size or s == size]
        if not starts:
            return
        # run on to the first bound after the block, at which its last record ends
        while end < r["length"]:
            more_start = end
            end = _cut(fh, min(end + AHEAD_BYTES, r["length"]), r["length"])
            fh.seek(more_start)
            data += fh.read(end - more_start)
            bounds = machine.bounds(np.frombuffer(data, np.uint8), bool(r["inside"]), r["depth"])
            if len(bounds) and bounds[-1] >= size:
                break
    ends = bounds.tolist()
    for s in starts:
        k = np.searchsorted(bounds, s)
        stop = ends[k] if k < len(ends) else len(data)
        yield r["start"] + s, data[s:stop]


def _records(kind: str, parts: Iterator[pa.RecordBatch]):
    for part in parts:
        rows, held = [], 0
        for r in part.to_pylist():
            for at, raw in _block_records(kind, r):
                text = raw.decode("utf-8", "replace").strip("\r\n" if kind == "csv" else None)
                if text:
                    rows.append({"path": r["path"], "at": at, "text": text})
                    held += len(raw)
                    if len(rows) >= BATCH_ROWS or held >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema=_RECORDS)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_RECORDS)


def split_records(files: DataFrame, kind: str, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, list[str]]:
    """``(path, at, text)`` of every record of the files ``(path, length)``, and
    the files that can't be split this way (a CSV with a quote inside an
    unquoted field), which are left out.

    ``json``: elements of an array; ``csv``: lines, the header included.
    """
    total = files.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, min(-(-total // block_bytes), max(MIN_TASKS, -(-total // TASK_BYTES))))
    blocks = files.select("path", "length", F.explode(F.sequence(
        F.lit(0).cast("long"), F.greatest(F.expr(f"(length - 1) div {block_bytes}"), F.lit(0).cast("long")))).alias("block"))
    schema = ("path string, length long, block long, start long, stop long, flips long, depth0 long, depth1 long, "
              "bad0 boolean, bad1 boolean")
    seen = stage(blocks.repartition(tasks, "path", "block").mapInArrow(partial(_summaries, kind, block_bytes), schema))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    states = seen.withColumn("inside", F.coalesce(F.sum("flips").over(before), F.lit(0)) % 2)
    states = states.withColumn("depth", F.coalesce(F.sum(
        F.when(F.col("inside") == 0, F.col("depth0")).otherwise(F.col("depth1"))).over(before), F.lit(0)))
    states = stage(states)
    wrong = states.filter(F.when(F.col("inside") == 0, F.col("bad0")).otherwise(F.col("bad1")))
    refused = [r[0] for r in wrong.select("path").distinct().collect()]
    good = states.filter(~F.col("path").isin(refused)) if refused else states
    records = good.select("path", "length", "start", "stop", "inside", "depth").repartition(tasks, "path", "start").mapInArrow(
        partial(_records, kind), "path string, at long, text string")
    return records, refused


def listed(spark: SparkSession, path: str, glob: str | None, recursive: bool) -> DataFrame:
    """``(path, length)`` of the files a reader of ``path`` would take."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select("path", "length")
