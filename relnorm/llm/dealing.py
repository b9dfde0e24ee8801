"""Meeting rows by key in bounded groups, and joining rows back to classes, whatever a key's share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relnorm.llm.shared import staged


def spread(df: DataFrame, rows: int, per_task: int) -> int:
    """Into how many groups to deal ``rows`` rows: follows the input, at least the shuffle setting, no cap."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // per_task))


def broadcast_below(df: DataFrame, most_bytes: int = 16 << 20) -> DataFrame:
    """Hint a broadcast when the rows of ``df`` (a written table) take at most ``most_bytes``; else leave a shuffle join."""
    size = df.agg(F.sum(F.length(F.to_json(F.struct(*df.columns))) + 16)).first()[0] or 0
    return F.broadcast(df) if size <= most_bytes else df


def cells(entries: DataFrame, total: int, item: str, limit: int, per_bin: int,
          broadcast_rows: int = 100_000) -> DataFrame:
    """Deal ``total`` entries (key, ...) so that any two of one key meet in a cell of at most about ``2 * limit`` rows.

    A key of more than ``limit`` entries is cut into blocks by a hash of
    ``item``, and every two of its blocks form a cell of their own.  Returns
    ``bin`` (what to group by; about ``per_bin`` entries), ``cell`` and the
    other columns.  Entries of different keys meet in a cell only by a
    collision of 64-bit hashes, so candidates must be verified.
    """
    hot = entries.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit)
    hot = staged(hot.select("key", F.ceil(F.col("n") / limit).alias("blocks")), "hot")
    # At most total / limit rows of two longs; beyond the counted bound a shuffle join takes over.
    hot = F.broadcast(hot) if hot.count() <= broadcast_rows else hot
    rest = [c for c in entries.columns if c != "key"]
    joined = entries.join(hot, "key", "left")
    block = F.pmod(F.xxhash64(F.lit(7), F.col(item)), F.col("blocks"))
    others = F.filter(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda j: j != F.col("block"))
    dealt = (joined.withColumn("block", block)
             .withColumn("other", F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(None).cast("long")))
                                            .otherwise(others)))
             .withColumn("cell", F.when(F.col("blocks").isNull(), F.col("key")).otherwise(
                 F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other")))))
    bins = spread(entries, total, per_bin)
    return dealt.select(F.pmod(F.xxhash64("cell"), F.lit(bins)).alias("bin"), "cell", *rest)


def join_class(rows: DataFrame, classes: DataFrame, key: str, most_hot: int = 1000) -> DataFrame:
    """Left join of ``rows`` to ``classes`` (one row per key, with its number of rows ``n_rows``).

    Keys of more than ``1 / most_hot`` of all rows are at most ``most_hot``
    many, so they are broadcast; the rest shuffles without a heavy key.
    Both tables must be written ones: each is read twice.
    """
    floor = (classes.agg(F.sum("n_rows")).first()[0] or 0) // most_hot
    hot = F.broadcast(classes.where(F.col("n_rows") > floor))
    heavy = rows.join(hot, key)
    light = (rows.join(hot.select(key), key, "left_anti")
             .join(classes.where(F.col("n_rows") <= floor), key, "left"))
    return heavy.unionByName(light).drop("n_rows")
