"""Keep-first / keep-last / distinct.

Keep-first is an aggregate (``min_by`` over a struct), not a window: Spark
aggregates partially on the map side, so a key that holds a third of all
rows is reduced to one row per map task before the shuffle.  Ties of the order
are decided by a 128-bit digest of the remaining columns, so the payload is
carried once.

With ``late`` only keys, order and a row number are aggregated.  The numbers
that win become bitmaps of the staged rows (one bit a row), and the payload
is read where a bit is set: columns of rows that lose cross no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relnorm.functions._util import as_col
from relnorm.session import stage

#: Bitmaps (4 kB for 32,768 staged rows) are broadcast up to this counted size; beyond it rows are joined.
BITMAP_BYTES = 64 << 20


def _digest(df: DataFrame, cols):
    """One value for the contents of ``cols``, the same in every run."""
    return F.md5(F.to_json(F.struct(*cols))) if cols else F.lit("")


def _pick(df: DataFrame, keys, order_by, fn, blank_keys_equal: bool, late: bool) -> DataFrame:
    keys = list(keys)
    payload = [c for c in df.columns if c not in keys]
    if blank_keys_equal:
        df = df.withColumns({k: F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys})
    if not payload:
        return df.select(*keys).distinct()
    order = F.struct(*[as_col(o) for o in order_by], _digest(df, payload))
    if late:
        return _late(df, keys, order, fn)
    picked = df.groupBy(*keys).agg(fn(F.struct(*payload), order).alias("_kp"))
    return picked.select(*keys, "_kp.*")


def _late(df: DataFrame, keys, order, fn) -> DataFrame:
    rows = stage(df.withColumns({"_kp_order": order, "_kp_row": F.monotonically_increasing_id()}))
    # the row number decides between rows that are equal in everything
    won = stage(rows.groupBy(*keys).agg(fn("_kp_row", F.struct("_kp_order", "_kp_row")).alias("_kp_row"))
                .select("_kp_row"))
    bits = stage(won.groupBy(F.bitmap_bucket_number("_kp_row").alias("_kp_bucket"))
                 .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_kp_row")).alias("_kp_bits")))
    if bits.count() * 4096 > BITMAP_BYTES:
        out = rows.join(won, "_kp_row", "left_semi")
    else:
        byte = "cast(conv(hex(substring(_kp_bits, cast(bitmap_bit_position(_kp_row) div 8 + 1 as int), 1)), 16, 10) as int)"
        out = (rows.withColumn("_kp_bucket", F.bitmap_bucket_number("_kp_row")).join(F.broadcast(bits), "_kp_bucket")
               .filter(F.expr(f"getbit({byte}, cast(bitmap_bit_position(_kp_row) % 8 as int)) = 1")))
    return out.select(*df.columns)


def keep_first(df: DataFrame, keys, order_by, blank_keys_equal: bool = False, late: bool = False) -> DataFrame:
    """One row per key: the first in ``order_by`` order (NULLs first)."""
    return _pick(df, keys, order_by, F.min_by, blank_keys_equal, late)


def keep_last(df: DataFrame, keys, order_by, blank_keys_equal: bool = False, late: bool = False) -> DataFrame:
    """One row per key: the last in ``order_by`` order."""
    return _pick(df, keys, order_by, F.max_by, blank_keys_equal, late)


def dimension_index(dim: DataFrame, keys, pk: str = "pk", keep: str = "last") -> DataFrame:
    """``(keys…, pk)`` unique on keys: highest (last-wins) or lowest pk."""
    agg = F.max if keep == "last" else F.min
    return dim.groupBy(*keys).agg(agg(pk).alias(pk))


def distinct_rows(df: DataFrame, cols=None) -> DataFrame:
    return (df.select(*cols) if cols else df).distinct()


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()
