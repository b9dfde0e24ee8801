"""Words of texts as native columns: runs of ``[a-z0-9]`` and non-ASCII after A-Z is lower-cased."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# `lower` also changes letters outside ASCII; only texts that hold one take the per-character path.
_OTHER_UPPER = r"[[^\x00-\x7F]&&[\p{Lu}\p{Lt}\p{Nl}\p{So}]]"


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z lower-cased and nothing else changed; null is empty."""
    text = F.coalesce(text, F.lit(""))
    other = (F.octet_length(text) != F.length(text)) & text.rlike(_OTHER_UPPER)
    return F.when(other, F.translate(
        text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise(F.lower(text))


def words(text: Column) -> Column:
    """Array of the words of ``text``; empty for null and for texts without words."""
    return F.array_remove(F.split(lower_ascii(text), SEPARATORS), "")


def broadcast_if_small(df: DataFrame, most_rows: int) -> DataFrame:
    """Hint a broadcast when ``df`` (a written table) has at most ``most_rows`` rows; else leave a shuffle join."""
    return F.broadcast(df) if df.count() <= most_rows else df
