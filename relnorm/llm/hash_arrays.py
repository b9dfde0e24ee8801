"""Sorted hash arrays in files of the shared folder, mapped into memory by tasks.

A file holds the columns of one hash range, sorted by the first; each of the
others takes the narrowest unsigned integers that hold it.  Where the
folder is a mounted path the file is memory-mapped, so that all tasks of a
machine share its pages; from another store it is read through Arrow's file
systems.  A file appears under its name only when it is complete, and a rerun
task replaces it with the same bytes.
"""

from __future__ import annotations

import os
import uuid
from urllib.parse import urlparse

import numpy as np
import pyarrow.fs as fs


def _local(path: str) -> str | None:
    parts = urlparse(path)
    return (parts.path if parts.scheme == "file" else path) if parts.scheme in ("", "file") else None


def write_columns(path: str, columns: list[np.ndarray]) -> None:
    """Write equally long columns of non-negative integers as one file."""
    columns = [columns[0].astype("<u8")] + [
        c.astype(f"<{np.min_scalar_type(int(c.max(initial=0))).str[1:]}") for c in columns[1:]]
    head = np.array([len(columns[0])] + [c.itemsize for c in columns], "<i8")
    parts = [head.tobytes()] + [c.tobytes() for c in columns]
    draft, local = f"{path}.{uuid.uuid4().hex}", _local(path)
    if local is not None:
        draft = _local(draft)
        os.makedirs(os.path.dirname(local), exist_ok=True)
        with open(draft, "wb") as f:
            f.writelines(parts)
        os.replace(draft, local)
    else:
        store, name = fs.FileSystem.from_uri(path)
        _, draft_name = fs.FileSystem.from_uri(draft)
        with store.open_output_stream(draft_name) as f:
            for part in parts:
                f.write(part)
        store.move(draft_name, name)


def read_columns(path: str, number: int) -> list[np.ndarray]:
    """The ``number`` columns of a file; every range has one, so a missing file is an error."""
    local = _local(path)
    if local is not None:
        data = np.memmap(local, np.uint8, "r")
    else:
        store, name = fs.FileSystem.from_uri(path)
        with store.open_input_file(name) as f:
            data = np.frombuffer(f.read(), np.uint8)
    n, *sizes = data[:8 * (number + 1)].view("<i8").tolist()
    at, out = 8 * (number + 1), []
    for size in sizes:
        out.append(data[at:at + size * n].view(f"<u{size}"))
        at += size * n
    return out


def look_up(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each wanted key in the sorted ``keys``, and whether it is there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted
