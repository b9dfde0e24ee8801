"""Zip archives written from tables, for the catalogued jobs."""

from __future__ import annotations

import io
import time
import zipfile
import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relnorm.sources import files

_KEYS = ["folder", "archive", "method"]


def _add(packed: zipfile.ZipFile, entry: str, body: bytes, now: tuple) -> None:
    """``packed.writestr`` for a small whole entry: its header is written once,
    after its sizes are known, which takes a fifth of the time."""
    if entry.endswith("/"):
        packed.writestr(entry, body)
        return
    info = zipfile.ZipInfo(entry, now)
    info.compress_type, info.external_attr = packed.compression, 0o600 << 16
    data = body
    if info.compress_type == zipfile.ZIP_DEFLATED:
        deflate = zlib.compressobj(zlib.Z_DEFAULT_COMPRESSION, zlib.DEFLATED, -15)
        data = deflate.compress(body) + deflate.flush()
    info.file_size, info.compress_size, info.CRC = len(body), len(data), zlib.crc32(body)
    info.header_offset = packed.fp.tell()
    packed.fp.write(info.FileHeader())
    packed.fp.write(data)
    packed.start_dir = packed.fp.tell()
    packed.filelist.append(info)


def _write_sorted(batches):
    """One file per run of rows of one archive: a zip of its entries, or (``raw``) the bytes of its only row."""
    import pyarrow as pa
    kinds = {"stored": zipfile.ZIP_STORED, "deflated": zipfile.ZIP_DEFLATED}
    folders, key, data, packed, n, names, counts = {}, None, None, None, 0, [], []
    now = time.localtime()[:6]

    def finish():
        folder, name, method = key
        if packed is not None:
            packed.close()
        if folder not in folders:
            files.create_folder(folder)
            folders[folder] = files.filesystem(folder)
        store, path = folders[folder]
        with store.open_output_stream(files.join(path, name)) as out:
            out.write(data.getvalue())
        names.append(name)
        counts.append(n)

    for batch in batches:
        for folder, name, method, entry, body in zip(*[batch.column(i).to_pylist() for i in range(5)]):
            if (folder, name, method) != key:
                if key is not None:
                    finish()
                key, data, packed, n = (folder, name, method), io.BytesIO(), None, 0
                if method != "raw":
                    packed = zipfile.ZipFile(data, "w", kinds[method])
            if packed is not None:
                _add(packed, entry, body, now)
            elif n == 0:
                data.write(body)
            n += 1
    if key is not None:
        finish()
    yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(counts, pa.int64())], ["archive", "n"])


def write_archives(rows: DataFrame, **made) -> int:
    """Write rows ``(folder, archive, method, entry, body)``, folders as URIs, entries by name;
    the files of one archive must fit a task.  Returns the number of files.

    Rows come sorted by archive, so a task streams through its archives and
    holds one at a time, however many there are.  ``made`` has columns that are
    worked out of ``rows`` only after these are dealt, so that no ``body`` of
    theirs crosses the shuffle or is sorted."""
    if made:
        # as many tasks as the session deals to: what they write is far more than what they read
        tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        dealt = rows.repartition(tasks, *[made.get(k, F.col(k)) for k in _KEYS]).withColumns(
            {k: c for k, c in made.items() if k != "body"})
    else:
        dealt = rows.select(*_KEYS, "entry", "body").repartition(*_KEYS)
    # `body` decides between entries of one name
    body = made.get("body", F.col("body"))
    ranked = dealt.sortWithinPartitions(*_KEYS, F.col("entry").asc_nulls_last(), body)
    return ranked.select(*_KEYS, "entry", body.alias("body")).mapInArrow(_write_sorted, "archive string, n long").count()
