"""Zip archives and loose files as a data source whose tasks follow bytes.

``archive_entries`` reads ``format("zip_entries")``, a Python data source.
Planning lists the files with their sizes only (as Spark's own file sources
do), lays them end to end, and cuts that line into splits of ``split_bytes``:
a large archive spreads over many tasks and a thousand small ones share one.
A task opens the archives its split touches, reads their central directories
and takes the entries whose local header lies in its part, so no entry ever
reaches the driver.

Without ``content`` nothing is inflated: names, sizes and CRCs come from the
directory alone.  ``read_entries`` reads the content of chosen entries later,
dealt by the same splits, with the columns in ``keep`` (a key, …) beside it.

A damaged entry is an error or a row with an ``error``; it never comes back
cut.  An archive that cannot be opened or is no zip gives one row with
``entry_index`` -1 and an ``error``.

Paths must be reachable from executors (shared file system or object store
URI understood by ``pyarrow.fs``).
"""

from __future__ import annotations

import re
import struct
import zlib
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import (BinaryType, IntegerType, LongType, StringType, StructField, StructType)

from relnorm.sources.files import list_files, open_input, qualified

ENTRY_SCHEMA = StructType([
    StructField("archive", StringType()), StructField("archive_size", LongType()),
    StructField("entry_index", LongType()), StructField("entry_name", StringType()),
    StructField("file_size", LongType()), StructField("compress_size", LongType()),
    StructField("header_offset", LongType()), StructField("compress_type", IntegerType()),
    StructField("crc", LongType()), StructField("error", StringType()), StructField("split", IntegerType()),
])

CONTENT_SCHEMA = StructType([
    StructField("archive", StringType()), StructField("entry_index", LongType()),
    StructField("entry_name", StringType()), StructField("content", BinaryType()),
    StructField("error", StringType()),
])

#: ``compress_type`` of a loose file: the entry is the whole file.
WHOLE_FILE = -1

SPLIT_BYTES = 64 << 20
#: Opening a file counts like reading one of so many parts of a split.
OPEN_FILES = 256
BATCH_ROWS, BATCH_BYTES = 256, 16 << 20


class DamagedEntry(Exception):
    pass


def archive_manifest(spark: SparkSession, path: str, glob: str = "*.zip",
                     recursive: bool = True) -> DataFrame:
    """``(path, length, modificationTime, archive_name, collection)``; the
    collection is the archive's parent directory name."""
    df = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
          .option("recursiveFileLookup", str(recursive).lower()).load(path))
    return df.select("path", "length", "modificationTime",
                     file_name(F.col("path")).alias("archive_name"), parent_name(F.col("path")).alias("collection"))


def archive_list(spark: SparkSession, path: str, glob: str = "*.zip", recursive: bool = True) -> DataFrame:
    """``(path, length, archive_name, collection)`` of the archives that
    ``archive_entries`` reads, without empty files (as in ``archive_manifest``),
    from their listing alone: no file is opened."""
    spark.dataSource.register(ZipEntries)
    listed = spark.read.format("zip_entries").options(
        path=qualified(spark, path), glob=glob, recursive=str(recursive).lower(), listing="true").load()
    return listed.filter(F.col("archive_size") > 0).select(
        F.col("archive").alias("path"), F.col("archive_size").alias("length"),
        file_name(F.col("archive")).alias("archive_name"), parent_name(F.col("archive")).alias("collection"))


def file_name(path):
    return F.regexp_extract(path, r"([^/]+)$", 1)


def parent_name(path):
    return F.regexp_extract(path, r"([^/]+)/[^/]+$", 1)


def _inflate(fh, offset: int, csize: int, method: int, size: int, crc: int):
    """The entry's bytes, whole and checked against the directory's length and CRC; None for other methods."""
    fh.seek(offset)
    head = fh.read(30)
    if len(head) < 30 or head[:4] != b"PK\x03\x04":
        raise DamagedEntry("damaged entry: bad local header")
    n_len, x_len = struct.unpack("<HH", head[26:30])
    fh.seek(offset + 30 + n_len + x_len)
    data = fh.read(csize)
    if method not in (0, 8):
        return None
    whole = len(data) == csize
    if method == 8:
        stream = zlib.decompressobj(-15)
        try:
            data = stream.decompress(data)
        except zlib.error:
            raise DamagedEntry("damaged entry: cannot be inflated") from None
        whole = whole and stream.eof
    if not whole or len(data) != size or zlib.crc32(data) != crc:
        raise DamagedEntry("damaged entry: cut short or another CRC")
    return data


def xml_as_utf8(data: bytes) -> bytes:
    """An XML document's bytes in UTF-8, decoded by its byte order mark or
    declared encoding (UTF-8 when there is none)."""
    if data[:2] in (b"\xff\xfe", b"\xfe\xff"):
        encoding = "utf-16"
    else:
        declared = re.match(rb"(?:\xef\xbb\xbf)?\s*<\?xml[^>]*?encoding\s*=\s*[\"']([A-Za-z0-9._-]+)", data)
        encoding = declared.group(1).decode() if declared else "utf-8"
    try:
        return data.decode("utf-8-sig" if encoding.lower() in ("utf-8", "utf8") else encoding).encode("utf-8")
    except LookupError:
        raise DamagedEntry(f"unknown encoding {encoding}") from None
    except UnicodeError:
        raise DamagedEntry(f"not valid {encoding}") from None


CONVERSIONS = {"": None, "xml": xml_as_utf8}


def entry_content(fh, index: int, offset, csize, method, size, crc, convert=None) -> bytes:
    """The whole bytes of one entry of an open archive (or loose file), or ``DamagedEntry``."""
    import zipfile
    if method == WHOLE_FILE:
        fh.seek(0)
        data = fh.read()
    else:
        data = _inflate(fh, int(offset), int(csize), int(method), int(size), int(crc))
    if data is None:  # other methods: fall back to the zip module
        try:
            archive = zipfile.ZipFile(fh)
            data = archive.read(archive.infolist()[index])
        except (zipfile.BadZipFile, NotImplementedError, EOFError) as e:
            raise DamagedEntry(f"damaged entry: {type(e).__name__}") from None
    return convert(data) if convert else data


class Split(InputPartition):
    """Consecutive parts ``(file, size, from, to, loose)`` of the listed files."""

    def __init__(self, number: int, parts: list):
        super().__init__(number)
        self.number, self.parts = number, parts


def plan_splits(files: list[tuple[str, int, bool]], split_bytes: int) -> list[Split]:
    """Cut files ``(URI, size, loose)``, laid end to end, at multiples of
    ``split_bytes``.  A loose file is one entry and belongs to where it starts.
    A file takes up at least an ``OPEN_FILES``-th of a split, for the work of
    opening it, so that a split has few of them, however small they are."""
    splits: dict[int, list] = {}
    start, least = 0, split_bytes // OPEN_FILES
    for uri, size, loose in files:
        first, last = start // split_bytes, max(start + size - 1, start) // split_bytes
        for number in range(first, last + 1 if not loose else first + 1):
            low = max(number * split_bytes - start, 0)
            high = size if loose or number == last else (number + 1) * split_bytes - start
            splits.setdefault(number, []).append((uri, size, low, high, loose))
        start += max(size, least)
    return [Split(k, parts) for k, (_, parts) in enumerate(sorted(splits.items()))] or [Split(0, [])]


def _entries_of(part):
    """``(rows of ENTRY_SCHEMA but split, open file or None)`` of one part of a file."""
    import zipfile
    uri, size, low, high, loose = part
    unreadable = [(uri, size, -1, None, None, None, None, None, None, "unreadable archive")] if low == 0 else []
    if loose:
        return [(uri, size, 0, uri, size, size, 0, WHOLE_FILE, None, None)], partial(open_input, uri)
    try:
        fh = open_input(uri)
    except (FileNotFoundError, PermissionError, IsADirectoryError):
        return unreadable, None
    try:
        infos = zipfile.ZipFile(fh).infolist()
    except (zipfile.BadZipFile, ValueError):  # ValueError: places outside the file, undecodable names
        return unreadable, lambda: fh
    rows = [(uri, size, i, x.filename, x.file_size, x.compress_size, x.header_offset, x.compress_type, x.CRC, None)
            for i, x in enumerate(infos) if not x.is_dir() and (
                low <= x.header_offset < high or (high == size and x.header_offset >= size))]
    return rows, lambda: fh


class ZipEntriesReader(DataSourceReader):
    def __init__(self, options, schema: StructType):
        self.options, self.schema = dict(options), schema
        self.content = "content" in schema.fieldNames()

    def partitions(self):
        o = self.options
        recursive = o.get("recursive", "true") == "true"
        files = [(uri, size, False) for uri, size in list_files(o["path"], o.get("glob", "*.zip"), recursive)]
        if o.get("looseglob"):
            files += [(uri, size, True) for uri, size in list_files(o["path"], o["looseglob"], recursive)]
        return plan_splits(files, int(o.get("splitbytes", SPLIT_BYTES)))

    def read(self, partition):
        import pyarrow as pa
        kinds = {LongType: pa.int64(), IntegerType: pa.int32(), StringType: pa.string(), BinaryType: pa.binary()}
        schema = pa.schema([(f.name, kinds[type(f.dataType)]) for f in self.schema])
        suffix, strict = self.options.get("suffix", ""), self.options.get("onerror", "report") == "raise"
        convert = CONVERSIONS[self.options.get("convert", "")]

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

        if self.options.get("listing", "false") == "true":
            files = [part[:2] for part in partition.parts if part[2] == 0]
            if files:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*files), schema.types)], schema=schema)
            return
        out, held = [], 0
        for part in partition.parts:
            rows, opened = _entries_of(part)
            fh = opened() if opened and (self.content or not part[4]) else None
            try:
                for row in rows:
                    if row[3] is not None and not row[3].endswith(suffix):
                        continue
                    data, error = None, row[9]
                    if self.content and error is None:
                        try:
                            data = entry_content(fh, row[2], row[6], row[5], row[7], row[4], row[8], convert)
                        except DamagedEntry as e:
                            error = str(e)
                    if strict and error is not None:
                        raise IOError(f"{error} ({row[3]} in {row[0]})")
                    out.append(row[:9] + (error, partition.number) + ((data,) if self.content else ()))
                    held += len(data or b"") + 200
                    if held >= BATCH_BYTES or len(out) >= (BATCH_ROWS if self.content else 50 * BATCH_ROWS):
                        yield batch(out)
                        out, held = [], 0
            finally:
                if fh is not None:
                    fh.close()
        if out:
            yield batch(out)


class ZipEntries(DataSource):
    """``format("zip_entries")``; options ``path``, ``glob``, ``looseGlob``,
    ``recursive``, ``content``, ``convert``, ``suffix``, ``onError``, ``splitBytes``,
    ``listing`` (archives and sizes only)."""

    @classmethod
    def name(cls):
        return "zip_entries"

    def schema(self):
        if self.options.get("listing", "false") == "true":
            return StructType(ENTRY_SCHEMA.fields[:2])
        content = [StructField("content", BinaryType())] if self.options.get("content", "false") == "true" else []
        return StructType(ENTRY_SCHEMA.fields + content)

    def reader(self, schema):
        return ZipEntriesReader(self.options, schema)


def archive_entries(spark: SparkSession, path: str, glob: str = "*.zip", loose_glob: str | None = None,
                    recursive: bool = True, content: bool = False, convert: str = "", suffix: str = "",
                    on_error: str = "report", split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """One row per file entry of the archives below ``path`` (and per loose
    file that matches ``loose_glob``), see ``ENTRY_SCHEMA``.

    ``content`` adds the entry's bytes, converted by one of ``CONVERSIONS``.
    Only entries whose name ends with ``suffix`` are listed and read.  With
    ``on_error="raise"`` a damaged entry or archive ends the read instead of
    being a row with an ``error``.
    """
    if on_error not in ("raise", "report"):
        raise ValueError(f"unknown on_error {on_error}")
    if convert not in CONVERSIONS:
        raise ValueError(f"unknown convert {convert}")
    spark.dataSource.register(ZipEntries)
    options = {"path": qualified(spark, path), "glob": glob, "recursive": str(recursive).lower(),
               "content": str(content).lower(), "convert": convert, "suffix": suffix, "onError": on_error,
               "splitBytes": split_bytes}
    if loose_glob:
        options["looseGlob"] = loose_glob
    return spark.read.format("zip_entries").options(**options).load()


def _read_chosen(keep, convert, strict, batches):
    import pandas as pd
    names = CONTENT_SCHEMA.fieldNames() + keep
    convert = CONVERSIONS[convert]
    uri, fh = None, None
    for pdf in batches:
        out, held = [], 0
        for r in pdf.itertuples(index=False):
            data, error = None, r.error
            if error is None:
                if r.archive != uri:
                    if fh is not None:
                        fh.close()
                    uri, fh = r.archive, open_input(r.archive)
                try:
                    data = entry_content(fh, r.entry_index, r.header_offset, r.compress_size, r.compress_type,
                                         r.file_size, r.crc, convert)
                except DamagedEntry as e:
                    error = str(e)
            if strict and error is not None:
                raise IOError(f"{error} ({r.entry_name} in {r.archive})")
            out.append((r.archive, r.entry_index, r.entry_name, data, error) + tuple(getattr(r, c) for c in keep))
            held += len(data or b"")
            if len(out) >= BATCH_ROWS or held >= BATCH_BYTES:
                yield pd.DataFrame(out, columns=names)
                out, held = [], 0
        if out:
            yield pd.DataFrame(out, columns=names)


def read_entries(entries: DataFrame, keep=(), convert: str = "", on_error: str = "raise") -> DataFrame:
    """Entry rows (see ``archive_entries``) → ``(archive, entry_index, entry_name, content, error, keep…)``.

    The rows go back to the splits they were listed in, so tasks follow the
    bytes of the archives; ``entries`` should be a staged table, for its
    number of splits is read first.  With ``on_error="report"`` a damaged entry
    has NULL content and an ``error``; with ``"raise"`` it ends the read.
    """
    if on_error not in ("raise", "report"):
        raise ValueError(f"unknown on_error {on_error}")
    keep = list(keep)
    schema = StructType(CONTENT_SCHEMA.fields + [entries.schema[c] for c in keep])
    plain = {c: f"k_{i}" for i, c in enumerate(keep)}  # plain names, readable as attributes
    work = entries.select(*ENTRY_SCHEMA.fieldNames(), *[F.col(c).alias(k) for c, k in plain.items()])
    n = (entries.agg(F.max("split")).first()[0] or 0) + 1
    dealt = work.repartitionById(n, F.col("split")).sortWithinPartitions("archive", "header_offset")
    read = dealt.mapInPandas(
        partial(_read_chosen, list(plain.values()), convert, on_error == "raise"),
        StructType(CONTENT_SCHEMA.fields + [StructField(k, entries.schema[c].dataType) for c, k in plain.items()]))
    return read.toDF(*schema.fieldNames())
