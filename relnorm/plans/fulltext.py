"""Fulltext job: article text in zip archives (and loose ``.txt`` files) →
one ``fulltext`` table with provenance and a continuous key.

Order of keys: archives by path, entries by path components, loose files
last.  A path present in several archives keeps the first archive's text and
provenance.  Invalid UTF-8 and a damaged entry give ``''`` and an error message
(never fatal).

Names are chosen and keyed first; texts are read once, afterwards, and cross
no shuffle before the sink.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relnorm.functions.text import decode_text
from relnorm.operators.dedupe import keep_first
from relnorm.operators.keys import dense_key
from relnorm.operators.sets import union_with_ordinal
from relnorm.session import stage, staging
from relnorm.sources.archives import SPLIT_BYTES, WHOLE_FILE, archive_entries, read_entries

MODEL = "fulltext.fulltext"
MAX_RECORDS_PER_FILE = 100


def text_entries(spark: SparkSession, path: str, loose: bool = True, archive_glob: str = "*.zip",
                 text_glob: str = "*.txt", text_suffix: str = ".txt", split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Names and places of every text, nothing inflated; ``_src`` is 0 in archives,
    1 for loose files.  The first archive (by path) wins for a repeated name."""
    listed = archive_entries(spark, path, archive_glob, text_glob if loose else None, split_bytes=split_bytes)
    is_loose = F.col("compress_type") == WHOLE_FILE
    packed = listed.filter(F.col("error").isNull() & ~is_loose & F.col("entry_name").endswith(text_suffix))
    parts = [keep_first(packed, ["entry_name"], ["archive", "entry_index"])]
    if loose:
        parts.append(listed.filter(is_loose))
    return union_with_ordinal(parts, "_src")


def unreadable_archives(spark: SparkSession, path: str, archive_glob: str = "*.zip") -> DataFrame:
    """``(archive, error)`` of archives whose directory cannot be read."""
    return archive_entries(spark, path, archive_glob).filter(F.col("entry_index") == -1).select("archive", "error")


def fulltext_table(spark: SparkSession, path: str, initial_pk: int = 1, loose: bool = True,
                   archive_glob: str = "*.zip", text_glob: str = "*.txt",
                   split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """``(pk, text, path, compressed_path, errors)``."""
    entries = text_entries(spark, path, loose, archive_glob, text_glob, split_bytes=split_bytes)
    in_archive = F.when(F.col("_src") == 0, F.col("archive"))
    keyed = dense_key(entries, ["_src", F.coalesce(in_archive, F.lit("")), F.split("entry_name", "/")],
                      pk="pk", start=initial_pk)
    texts = read_entries(keyed, keep=["pk", "_src"], on_error="report")
    t = decode_text(F.col("content"))
    return texts.select("pk", t["text"].alias("text"), F.col("entry_name").alias("path"),
                        in_archive.alias("compressed_path"), F.coalesce("error", t["error"]).alias("errors"))


def run(spark: SparkSession, path: str, output: str, initial_pk: int = 1,
        max_records_per_file: int = MAX_RECORDS_PER_FILE, compression: str | None = None) -> dict:
    """Write the table as numbered fixture JSON to ``<output>/fulltext`` and the
    archives that could not be read to ``<output>/unreadable_archives``;
    returns the number of records of each, counted while writing."""
    from relnorm.operators.checks import Checks
    from relnorm.sinks.fixtures import write_fixture_json
    checks = Checks()
    with staging(spark):
        table = stage(checks.count(fulltext_table(spark, path, initial_pk), "fulltext"))
        write_fixture_json(table, f"{output}/fulltext", MODEL, chunk_size=max_records_per_file,
                           initial_pk=initial_pk, compression=compression)
        checks.count(unreadable_archives(spark, path), "unreadable_archives").write.mode("overwrite").json(
            f"{output}/unreadable_archives")
    return checks.counts()
