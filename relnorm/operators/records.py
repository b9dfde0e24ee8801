"""Record shape: ``{pk, model, fields}`` wrapping, flattening, audit stamps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def wrap_records(df: DataFrame, model: str, pk: str = "pk") -> DataFrame:
    """Flat row → ``(pk, model, fields struct<…>)``; model is lower-cased."""
    others = [c for c in df.columns if c != pk]
    return df.select(F.col(pk).alias("pk"), F.lit(model.lower()).alias("model"),
                     F.struct(*others).alias("fields"))


def flatten_records(df: DataFrame, pk: bool = True) -> DataFrame:
    """``{pk, fields{…}}`` → flat row with pk first (pk optional)."""
    cols = ["pk"] if pk and "pk" in df.columns else []
    return df.select(*cols, "fields.*")


def stamp(df: DataFrame, run_ts: str) -> DataFrame:
    """Set ``created_at``/``updated_at`` to one run timestamp (overwrites)."""
    ts = F.lit(run_ts)
    return df.withColumns({"created_at": ts, "updated_at": ts})


def rename_relational(df: DataFrame, mapping: dict | None = None, suffix: bool = False) -> DataFrame:
    """Rename ``part1__part2`` columns: by an explicit mapping, or (with
    ``suffix=True``) to the part after ``__``."""
    mapping = dict(mapping or {})
    if suffix:
        for c in df.columns:
            if "__" in c and c not in mapping:
                mapping[c] = c.split("__", 1)[1]
    return df.withColumnsRenamed(mapping) if mapping else df
