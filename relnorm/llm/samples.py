"""Bounded samples of labelled rows, on which the classifiers are fitted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(id_col: str, folds: int) -> Column:
    """``crc32`` of the id as text, modulo ``folds``; a null id is in fold 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds, F.lit(0).cast("long"))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, most: int,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(label, text) of at most ``most`` ids outside the held-out fold, chosen by a hash of the id.

    Rows with a null id, label or no document are not used; of several labels
    or texts of an id the smallest counts, so the sample has ``most`` rows at
    most.  The chosen ids are broadcast, so only their texts leave the scan.
    """
    chosen = (labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull() & (fold(id_col, folds) != held_out))
              .groupBy(F.col(id_col).alias("_id")).agg(F.min(F.col(label).cast("string")).alias("label"))
              .orderBy(F.xxhash64("_id"), "_id").limit(most))
    return (docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
            .join(F.broadcast(chosen), "_id").groupBy("_id", "label").agg(F.min("text").alias("text"))
            .select("label", "text"))
