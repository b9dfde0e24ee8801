"""Set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def difference(a: DataFrame, b: DataFrame, a_col: str, b_col: str | None = None) -> DataFrame:
    """Distinct values of ``a_col`` absent from ``b`` (anti join)."""
    b_col = b_col or a_col
    left = a.select(a_col).distinct()
    right = b.select(F.col(b_col).alias("_df_r")).distinct()
    return left.join(right, left[a_col] == right["_df_r"], "left_anti")


def union_all(*dfs: DataFrame) -> DataFrame:
    """Union by column name; missing columns become NULL."""
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), dfs)


def union_with_ordinal(dfs, ordinal: str = "source_ordinal") -> DataFrame:
    """Union of parts tagged with their position, so a later key can number
    part 1 entirely before part 2 (one continuous key across parts)."""
    tagged = [df.withColumn(ordinal, F.lit(i)) for i, df in enumerate(dfs)]
    return union_all(*tagged)
