"""Chunked record output: numbered files of N records each.

Records are ``{pk, model, fields}``.  File ⌊(pk − initial)/N⌋ + 1 holds a
chunk's records in pk order; see ``numbered`` for how files appear.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from relnorm.operators.keys import chunk_number
from relnorm.operators.records import wrap_records
from relnorm.sinks.numbered import PART_ROWS, write_numbered


def _prefix(path: str, prefix: str | None) -> str:
    return prefix if prefix is not None else os.path.basename(path.rstrip("/")).split(".")[0]


def _parts(pk, chunk_size: int, initial_pk: int, plain: bool) -> dict:
    """Parts of long files of plain lines (see ``write_numbered``)."""
    if not plain or chunk_size <= PART_ROWS:
        return {}
    within = F.pmod(F.col(pk) - F.lit(initial_pk), F.lit(chunk_size))
    return {"part": F.floor(within / F.lit(PART_ROWS)), "parts": -(-chunk_size // PART_ROWS)}


def write_fixture_json(df: DataFrame, path: str, model: str, pk: str = "pk",
                       chunk_size: int = 2_000_000, initial_pk: int = 1, array: bool = False,
                       compression: str | None = None, mode: str = "overwrite", prefix: str | None = None,
                       gate=None) -> None:
    """Write ``<path>/<prefix>-<number>`` files: JSON Lines (``.jsonl``, default) or one JSON array each (``.json``).

    ``prefix`` is by default the folder's name up to its first dot; ``gate``
    is called when all files are written and can still stop their publication.
    """
    rec = wrap_records(df, model, pk)
    ends = {"head": "[", "between": ",\n", "tail": "]\n"} if array else {}
    write_numbered(rec, path, chunk_number(F.col("pk"), chunk_size, initial_pk),
                   F.to_json(F.struct("pk", "model", "fields")), ["pk"], _prefix(path, prefix),
                   ".json" if array else ".jsonl", compression=compression, mode=mode, gate=gate, **ends,
                   **_parts("pk", chunk_size, initial_pk, not array and not compression))


def _flat_for_csv(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (ArrayType, MapType, StructType)):
            cols.append(F.to_json(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def write_fixture_csv(df: DataFrame, path: str, pk: str = "pk", chunk_size: int = 2_000_000,
                      initial_pk: int = 1, compression: str | None = None,
                      mode: str = "overwrite", prefix: str | None = None, gate=None) -> None:
    """Flat CSV files with a header, chunked; arrays/structs as JSON text."""
    # pk first: a CSV read with an explicit schema is positional
    flat = _flat_for_csv(df.select(pk, *[c for c in df.columns if c != pk]))
    head = ",".join('"' + c.replace('"', '""') + '"' if set(c) & set(',"\n\r') else c for c in flat.columns)
    line = F.to_csv(F.struct(*flat.columns), {"quote": '"', "escape": '"'})
    write_numbered(flat, path, chunk_number(F.col(pk), chunk_size, initial_pk), line, [pk], _prefix(path, prefix),
                   ".csv", head=head + "\n", compression=compression, mode=mode, gate=gate,
                   **_parts(pk, chunk_size, initial_pk, not compression))


def export_tables(tables: dict, base: str, formats=("json", "csv"), chunk_size: int = 2_000_000,
                  compression: str | None = None, gates: dict | None = None) -> dict:
    """Write several ``name → DataFrame`` tables in several formats; returns
    ``{(name, format): path}``.  ``gates`` has a table's gate (see ``write_fixture_json``)."""
    out = {}
    for fmt in formats:
        if fmt not in ("json", "csv", "parquet"):
            raise ValueError(f"unknown format {fmt}")
    for name, df in tables.items():
        gate = (gates or {}).get(name)
        for fmt in formats:
            p = os.path.join(base, f"{name}.{fmt}")
            if fmt == "json":
                write_fixture_json(df, p, name, chunk_size=chunk_size, compression=compression, gate=gate)
            elif fmt == "csv":
                write_fixture_csv(df, p, chunk_size=chunk_size, compression=compression, gate=gate)
            else:
                w = df.write.mode("overwrite")
                (w.option("compression", compression) if compression else w).parquet(p)
            out[(name, fmt)] = p
    return out


def table_to_records(df: DataFrame, model: str, json_columns: dict | None = None,
                     pk: str = "pk") -> DataFrame:
    """Flat table (e.g. read back from CSV) → records: JSON-text columns are
    decoded to typed values (``{"prices": "array<bigint>"}``)."""
    json_columns = json_columns or {}
    typed = df.withColumns({c: F.from_json(F.col(c), t) for c, t in json_columns.items()}) \
        if json_columns else df
    return wrap_records(typed, model, pk)
