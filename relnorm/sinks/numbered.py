"""Numbered text files as a data source writer: one file per number, no folder per file.

Rows are ``(number, line)``, sorted by number within each partition, and all
rows of a number lie in one partition.  A task streams each number into a
file of its own in a hidden folder beside the target; a commit message names
its finished files.  Only when every task has ended does the commit remove
what other attempts left and put the folder in the target's place, so readers
see the old files or the new ones, and nothing of a failed job.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from relnorm.sources import files

PAD = 6
BUFFER_BYTES = 1 << 20
#: Longer files of lines are sorted and written in parts of so many records, then put together.
PART_ROWS = 100_000
PART = ".part-"
#: File name ending and the name pyarrow has for each codec.
CODECS = {None: ("", None), "none": ("", None), "gzip": (".gz", "gzip"), "bzip2": (".bz2", "bz2"),
          "zstd": (".zst", "zstd"), "lz4": (".lz4", "lz4")}


@dataclass
class Written(WriterCommitMessage):
    names: list


class _Out:
    """One numbered file: hidden under a name of its own until it is whole."""

    def __init__(self, folder: str, name: str, codec, head: bytes, between: bytes, tail: bytes):
        import pyarrow as pa
        self.folder, self.name, self.between, self.tail = folder, name, between, tail
        self.draft = f".{name}.{uuid.uuid4().hex}"
        store, path = files.filesystem(files.join(folder, self.draft))
        self.sink = store.open_output_stream(path)
        self.stream = pa.CompressedOutputStream(self.sink, codec) if codec else self.sink
        self.held, self.size, self.first = [head] if head else [], 0, True

    def write(self, line: bytes) -> None:
        if not self.first:
            self.held.append(self.between)
        self.held.append(line)
        self.first = False
        self.size += len(line)
        if self.size >= BUFFER_BYTES:
            self.flush()

    def append(self, uri: str) -> None:
        """The bytes of a file."""
        self.flush()
        with files.open_input(uri) as fh:
            while piece := fh.read(BUFFER_BYTES):
                self.stream.write(piece)

    def flush(self) -> None:
        self.stream.write(b"".join(self.held))
        self.held, self.size = [], 0

    def finish(self) -> str:
        self.held.append(self.tail)
        self.flush()
        self.close()
        files.move(files.join(self.folder, self.draft), files.join(self.folder, self.name))
        return self.name

    def close(self) -> None:
        if self.stream is not self.sink:
            self.stream.close()
        self.sink.close()

    def discard(self) -> None:
        self.close()
        store, path = files.filesystem(files.join(self.folder, self.draft))
        store.delete_file(path)


class NumberedFilesWriter(DataSourceArrowWriter):
    def __init__(self, options, overwrite: bool):
        self.options, self.overwrite = dict(options), overwrite
        self.target = self.options["path"].rstrip("/")
        parent, _, name = self.target.rpartition("/")
        self.staging = f"{parent}/.{name}-{uuid.uuid4().hex}"
        files.create_folder(self.staging)

    def _name(self, number: int) -> str:
        o = self.options
        return f"{o.get('prefix', 'part')}-{number:0{o.get('pad', PAD)}}{o.get('ending', '')}"

    def write(self, iterator):
        o = self.options
        codec = CODECS[o.get("codec", "none")][1]
        head, between, tail = (o.get(k, "").encode() for k in ("head", "between", "tail"))
        joining, parts = o.get("join", "false") == "true", int(o.get("parts", 1))
        names, out, number = [], None, None
        try:
            for batch in iterator:
                for n, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    if n != number:
                        if out is not None:
                            names.append(out.finish())
                            out = None
                        if number is not None and n < number:
                            raise ValueError(f"rows are not sorted by number: {n} after {number}")
                        number = n
                        # the parts of a file are numbered one after the other; only its first has the head
                        name, part = self._name(n // parts), n % parts
                        out = _Out(self.staging, f"{name}{PART}{part:0{PAD}}" if part else name, codec,
                                   b"" if part else head, between, tail)
                    if joining:
                        out.append(line)
                    else:
                        out.write(line.encode())
            if out is not None:
                names.append(out.finish())
        except BaseException:
            if out is not None:
                out.discard()
            raise
        return Written(names)

    def commit(self, messages):
        names = [n for m in messages if m is not None for n in m.names]
        wanted = set(names)
        if len(wanted) < len(names):
            self.abort(messages)
            raise ValueError("rows of one number lie in several partitions")
        store, path = files.filesystem(self.staging)
        import pyarrow.fs as pafs
        for found in store.get_file_info(pafs.FileSelector(path)):
            if found.base_name not in wanted:  # an attempt that was lost
                store.delete_file(found.path)
        try:
            files.publish(self.staging, self.target, self.overwrite)
        except FileExistsError:
            self.abort(messages)
            raise

    def abort(self, messages):
        files.remove_folder(self.staging)


class NumberedFiles(DataSource):
    """``format("numbered_files")``; options ``path``, ``prefix``, ``ending``,
    ``pad``, ``head``, ``between``, ``tail``, ``codec``, ``parts`` (numbers a
    file is written under, 1), ``join`` (a line is the URI of a file to copy)."""

    @classmethod
    def name(cls):
        return "numbered_files"

    def schema(self):
        return StructType.fromDDL("number bigint, line string")

    def writer(self, schema, overwrite):
        return NumberedFilesWriter(self.options, overwrite)


def write_numbered(df: DataFrame, path: str, number: Column, line: Column, order, prefix: str, ending: str,
                   head: str = "", between: str = "\n", tail: str = "\n", compression: str | None = None,
                   mode: str = "overwrite", pad: int = PAD, gate=None, part: Column | None = None,
                   parts: int = 1) -> None:
    """Write ``line`` of each row into the file ``<prefix>-<number><ending>``, in ``order`` within a file.

    Numbers are dealt over tasks by one shuffle, and one task streams a number's
    rows.  Where a number may have many rows, ``part`` (0 to ``parts`` - 1, in
    ``order``) cuts them: parts are sorted and written by tasks of their own,
    and a second job copies the parts of each file one after the other, so no
    task sorts more than a part.  That needs plain lines (``between`` and
    ``tail`` a line break, no compression).

    ``mode`` is ``overwrite`` (the whole folder is replaced at commit) or
    ``error`` (the folder must not exist).  ``gate`` is called between writing
    and publishing; if it raises, nothing is published.
    """
    if mode not in ("overwrite", "error"):
        raise ValueError(f"unknown mode {mode}")
    if compression not in CODECS:
        raise ValueError(f"unknown compression {compression}")
    if parts > 1 and (part is None or between != "\n" or tail != "\n" or CODECS[compression][1]):
        raise ValueError("only plain lines can be written in parts")
    spark = df.sparkSession
    spark.dataSource.register(NumberedFiles)
    target = files.qualified(spark, path).rstrip("/")
    if mode == "error" and files.exists(target):
        raise FileExistsError(f"{target} exists")
    parent, _, name = target.rpartition("/")
    pending = f"{parent}/.{name}-{uuid.uuid4().hex}" if gate or parts > 1 else target
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    number = number.cast("bigint")
    if parts > 1:
        number = number * F.lit(parts) + part.cast("bigint")
    rows = df.select(number.alias("number"), line.alias("line"), *[c.alias(f"_o{i}") for i, c in enumerate(order)])
    rows = (rows.repartition("number").sortWithinPartitions("number", *[f"_o{i}" for i in range(len(order))])
            .select("number", "line"))

    def save(rows, folder, **options):
        (rows.write.format("numbered_files").mode("overwrite" if mode == "overwrite" else "append")
         .options(path=folder, prefix=prefix, ending=ending + CODECS[compression][0], pad=pad,
                  codec=compression or "none", **options).save())

    save(rows, pending, head=head, between=between, tail=tail, parts=parts)
    if pending == target:
        return
    try:
        if parts > 1:
            pending = _joined(spark, pending, save)
        if gate:
            gate()
    except BaseException:
        files.remove_folder(pending)
        raise
    files.publish(pending, target, mode == "overwrite")


def _joined(spark, folder: str, save) -> str:
    """The folder with the files of ``folder`` whose parts are put together; ``folder`` itself if there are none."""
    found = files.list_files(folder, "*")
    if not any(PART in uri.rpartition("/")[2] for uri, _ in found):
        return folder
    # by name: a file comes before its parts, and these by number
    whole = [(int(re.search(r"-(\d+)[^-/]*$", uri.rpartition(PART)[0] or uri).group(1)), uri) for uri, _ in found]
    out = f"{folder}-whole"
    rows = spark.createDataFrame(whole, "number bigint, line string")
    try:
        save(rows.repartition("number").sortWithinPartitions("number", "line"), out, join="true")
    finally:
        files.remove_folder(folder)
    return out
