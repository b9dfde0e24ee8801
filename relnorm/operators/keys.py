"""Dense ordered surrogate keys without a single-task bottleneck.

``row_number()`` over an unpartitioned window moves every row into one task.
``dense_key`` range-partitions the rows by the *full* order key instead, so a
hot leading value is split over many tasks, sorts within partitions and lets
``monotonically_increasing_id`` number them.  The numbered rows are staged
once; everything after reads them as written, so neither retries nor
coalescing can move a key.  A table of one row per partition (broadcast: its
size is the number of partitions) turns the ids into 1, 2, 3, ...

Keys are stable only if the order is total.  Rows of equal order keys lie in
one range and next to each other, so they are counted in the pass that numbers
them (a window over the partitioning and sorting already there, measured with
``observe``), and an order that leaves different rows tied is an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from relnorm.functions._util import as_col
from relnorm.session import built_on, measured, stage

_ROW_BITS = 33  # monotonically_increasing_id keeps the row within its partition in the low bits


class NotTotalOrder(ValueError):
    """The order of a dense key leaves rows tied."""


def dense_key(df: DataFrame, order_by, pk: str = "pk", start: int = 1, tiebreak=()) -> DataFrame:
    """Add ``pk`` = start, start+1, … following ``order_by`` (ascending,
    NULLs first), then ``tiebreak``.  Items are column names or Columns.

    Raises ``NotTotalOrder`` with a sample when rows tie, unless the items name
    every column, so that tied rows are equal.
    """
    items = list(order_by) + list(tiebreak)
    exprs = [as_col(c) for c in items]
    names = [f"_ok{i}" for i in range(len(exprs))]
    asc = [F.col(n).asc_nulls_first() for n in names]
    ranged = df.withColumns(dict(zip(names, exprs))).repartitionByRange(*asc).sortWithinPartitions(*asc)
    ties = None
    if not set(df.columns) <= {c for c in items if isinstance(c, str)}:
        ties = Observation()
        tied = F.row_number().over(Window.partitionBy(*names).orderBy(*asc)) > 1
        ranged = ranged.withColumn("_oktie", tied).observe(
            ties, F.count_if("_oktie").alias("n"),
            F.min(F.when(F.col("_oktie"), F.to_json(F.struct(*names)))).alias("sample")).drop("_oktie")
    numbered = stage(ranged.drop(*names).withColumn("_okid", F.monotonically_increasing_id()))
    seen = measured(ties) if ties is not None else {}
    if seen.get("n"):
        raise NotTotalOrder(f"the order of {pk} leaves {seen['n']} row(s) tied, e.g. at {seen['sample']}; "
                            "add tiebreak columns")
    part = F.shiftright("_okid", _ROW_BITS)
    before = Window.orderBy("_okpart").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (numbered.groupBy(part.alias("_okpart")).agg(F.count(F.lit(1)).alias("_okn"))
               .select("_okpart", F.coalesce(F.sum("_okn").over(before), F.lit(0)).alias("_okoff")))
    out = numbered.withColumn("_okpart", part).join(F.broadcast(offsets), "_okpart")
    row = F.col("_okid").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return built_on(out.withColumn(pk, (F.col("_okoff") + row + F.lit(start)).cast("bigint")).drop(
        "_okpart", "_okid", "_okoff"), numbered)


def with_offset(df: DataFrame, pk: str, initial_pk: int) -> DataFrame:
    """Shift a 1-based key so it starts at ``initial_pk``."""
    return df.withColumn(pk, (F.col(pk) + F.lit(initial_pk - 1)).cast("bigint"))


def chunk_number(pk, size: int, initial: int = 1) -> Column:
    """⌊(pk − initial) / size⌋ + 1: the output file a record belongs to."""
    return (F.floor((as_col(pk) - F.lit(initial)) / F.lit(size)) + 1).cast("bigint")
