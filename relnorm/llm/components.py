"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relnorm.llm.shared import staged


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, v): every vertex of ``edges`` (u, v) but the roots, with its component's smallest vertex."""
    def state(e: DataFrame):
        return tuple(e.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first())

    edges = staged(edges.where("u <> v").distinct(), "edges")
    before = state(edges)
    while before[0]:
        edges = staged(_small_star(_large_star(edges)), "edges")
        after = state(edges)
        if after == before:
            break
        before = after
    return edges
