"""Dimensions from values, sole-value rule, counts and run reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from relnorm.functions.text import strip
from relnorm.operators.keys import dense_key


def sorted_distinct_dim(df: DataFrame, col: str, pk: str = "pk", label: str | None = None) -> DataFrame:
    """Distinct non-NULL values of ``col`` keyed 1..n in ascending value order."""
    label = label or col
    d = df.select(F.col(col).alias(label)).filter(F.col(label).isNotNull()).distinct()
    return dense_key(d, [label], pk=pk).select(pk, label)


def distinct_elements(df: DataFrame, array_col: str, out: str = "label", trim: bool = True) -> DataFrame:
    """Distinct (trimmed) elements over all arrays of a column."""
    values = df.select(F.explode(array_col).alias(out)).distinct()
    # trimmed after the first distinct: once per distinct value, not per token
    return values.select(strip(F.col(out)).alias(out)).distinct() if trim else values


def sole_value(df: DataFrame, group, value: str, out: str | None = None) -> DataFrame:
    """Per group: the value if the group has exactly one distinct non-NULL
    value, else NULL; with the distinct count."""
    group = [group] if isinstance(group, str) else list(group)
    out = out or f"sole_{value}"
    g = df.groupBy(*group).agg(F.count_distinct(value).cast("bigint").alias("n_distinct"),
                               F.min(value).alias("_sv"))
    return g.select(*group, "n_distinct",
                    F.when(F.col("n_distinct") == 1, F.col("_sv")).alias(out))


def record_counts(tables: dict) -> DataFrame:
    """``(model, n_records)`` for a dict of name → DataFrame."""
    parts = [df.select(F.lit(name).alias("model")) for name, df in tables.items()]
    u = reduce(lambda a, b: a.unionByName(b), parts)
    return u.groupBy("model").agg(F.count(F.lit(1)).cast("bigint").alias("n_records"))


def global_max(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """One-row table with the maximum of ``col`` (for cross-joining)."""
    return df.agg(F.max(col).alias(out or f"max_{col}"))


def source_report(df: DataFrame, source: str, code: str, keys=(), size: str | None = None,
                  run_id: str | None = None) -> DataFrame:
    """Per source (archive): entry count, distinct codes (sorted list — one
    per newspaper, bounded), distinct counts of each key, optional bytes."""
    aggs = [F.count(F.lit(1)).cast("bigint").alias("n_entries"),
            F.sort_array(F.collect_set(code)).alias("codes")]
    aggs += [F.count_distinct(k).cast("bigint").alias(f"n_{k}") for k in keys]
    if size:
        aggs.append(F.max(size).cast("bigint").alias("bytes"))
    out = df.groupBy(source).agg(*aggs)
    if run_id is not None:
        out = out.withColumn("run_id", F.lit(run_id))
    return out


def collection_totals(spark: SparkSession, requested, manifest: DataFrame,
                      collection: str = "collection", size: str = "length") -> DataFrame:
    """Archives and bytes per requested collection, zero for an empty one
    (reported, never fatal).  ``requested`` is a configured list of names."""
    req = spark.createDataFrame([(c,) for c in requested],
                                StructType([StructField(collection, StringType())]))
    agg = manifest.groupBy(collection).agg(F.count(F.lit(1)).cast("bigint").alias("n_archives"),
                                           F.sum(size).cast("bigint").alias("bytes"))
    out = F.broadcast(req).join(agg, collection, "left")
    return out.select(collection, F.coalesce("n_archives", F.lit(0)).cast("bigint").alias("n_archives"),
                      F.coalesce("bytes", F.lit(0)).cast("bigint").alias("bytes"),
                      (F.coalesce("n_archives", F.lit(0)) == 0).alias("is_empty"))
