"""Files by URI, for Python that runs in tasks and in data source planning."""

from __future__ import annotations

import fnmatch
import os
import posixpath

from pyspark.sql import SparkSession


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its scheme: one without is on the default file system, as Spark's own readers take it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return store.makeQualified(p).toString()


def filesystem(uri: str):
    """``(file system, path on it)`` of a URI; one without a scheme is local."""
    import pyarrow.fs as pafs
    scheme, _, rest = uri.partition(":")
    if not rest or "/" in scheme:
        return pafs.LocalFileSystem(), uri
    if scheme == "file":
        return pafs.LocalFileSystem(), "/" + rest.lstrip("/")
    if scheme in ("s3a", "s3n"):
        uri = f"s3:{rest}"
    return pafs.FileSystem.from_uri(uri)


def open_input(uri: str):
    """A seekable binary file object."""
    import pyarrow.fs as pafs
    store, path = filesystem(uri)
    return open(path, "rb") if isinstance(store, pafs.LocalFileSystem) else store.open_input_file(path)


def list_files(uri: str, pattern: str, recursive: bool = True) -> list[tuple[str, int]]:
    """``(URI, size)`` of the files below a folder (or of one file) whose name
    matches, by URI; hidden ones are left out."""
    import pyarrow.fs as pafs
    store, path = filesystem(uri)
    info = store.get_file_info(path)
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(f"no such path: {uri}")
    infos = [info] if info.type == pafs.FileType.File else store.get_file_info(
        pafs.FileSelector(path, recursive=recursive))
    prefix = uri[:len(uri) - len(path)] if uri.endswith(path) else uri.partition(":")[0] + ":"
    below = len(path.rstrip("/"))
    out = []
    for i in infos:
        parts = [x for x in i.path[below:].split("/") if x] or [posixpath.basename(i.path)]
        if i.type == pafs.FileType.File and fnmatch.fnmatch(parts[-1], pattern) \
                and not any(x.startswith((".", "_")) for x in parts):
            out.append((prefix + i.path, i.size))
    return sorted(out)


def create_folder(uri: str) -> None:
    store, path = filesystem(uri)
    store.create_dir(path, recursive=True)


def exists(uri: str) -> bool:
    import pyarrow.fs as pafs
    store, path = filesystem(uri)
    return store.get_file_info(path).type != pafs.FileType.NotFound


def remove_folder(uri: str) -> None:
    if exists(uri):
        store, path = filesystem(uri)
        store.delete_dir(path)


def move(source: str, target: str) -> None:
    store, a = filesystem(source)
    _, b = filesystem(target)
    store.move(a, b)


def publish(folder: str, target: str, overwrite: bool) -> None:
    """Put a finished folder in the target's place: by renames, so readers see the old one or the new one."""
    if not exists(target):
        move(folder, target)
    elif overwrite:
        move(target, f"{folder}-old")
        move(folder, target)
        remove_folder(f"{folder}-old")
    else:
        raise FileExistsError(f"{target} exists")


def join(uri: str, *names: str) -> str:
    return os.path.join(uri.rstrip("/"), *names)
