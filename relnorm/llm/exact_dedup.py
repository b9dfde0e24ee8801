"""Exact deduplication with a heavy-hitter split.

Misra-Gries counters per task, merged by sums, name the digests that may be
frequent.  Their exact group sizes and keepers are then counted with partial
aggregation and broadcast (at most ``counters`` rows, a proven bound), so rows
of a frequent digest are decided without a shuffle.  All other digests are
grouped by an ordinary shuffle, in which no group exceeds twice
``rows / counters``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from relnorm.llm.shared import staged

_COUNTS = pa.schema([("digest", pa.binary()), ("n", pa.int64())])


def misra_gries(counters: int):
    """A task's Misra-Gries summary of the ``digest`` column.

    A batch is counted whole, added, and the summary is cut back by subtracting
    its (counters + 1)-th largest count, which keeps every error within
    ``rows / (counters + 1)``.
    """
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[bytes, int] = {}
        for part in parts:
            for pair in part.column(0).value_counts().to_pylist():
                kept[pair["values"]] = kept.get(pair["values"], 0) + pair["counts"]
            if len(kept) > counters:
                counts = np.fromiter(kept.values(), np.int64, len(kept))
                cut = int(np.partition(counts, -(counters + 1))[-(counters + 1)])
                kept = {k: v - cut for k, v in kept.items() if v > cut}
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(kept), pa.binary()), pa.array(list(kept.values()), pa.int64())], schema=_COUNTS)
    return run


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                counters: int = 1000) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical; a null text equals the empty one.
    The row with the largest id of a group stays.  Repeated rows (same id and
    text) all count in group_size; one of them is kept.  A null id ranks below every other; if a whole group has null ids,
    keep_id is null and one row stays.  An empty table gives no rows.  Further
    columns of the input are not carried.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = staged(docs.select(F.col(id_col).cast("long").alias("id"), F.unhex(F.sha2(text, 256)).alias("digest"),
                              F.monotonically_increasing_id().alias("row")), "digests")
    total = rows.count()
    floor = total // (counters + 1)
    frequent = (rows.select("digest").mapInArrow(misra_gries(counters), "digest binary, n long")
                .groupBy("digest").agg(F.sum("n").alias("n")).where(F.col("n") > floor).select("digest"))
    # The estimates sum to at most `total`, so fewer than counters + 1 exceed `floor`.
    # Of repeated rows the first one written is kept; a null id is the smallest.
    top = F.max(F.struct("id", (-F.col("row")).alias("place")))
    winners = (rows.join(F.broadcast(frequent), "digest").groupBy("digest")
               .agg(top.alias("top"), F.count(F.lit(1)).alias("group_size"))
               .select("digest", F.col("top.id").alias("keep_id"), (-F.col("top.place")).alias("keep_row"), "group_size"))
    winners = staged(winners, "winners")
    if winners.count() > counters:
        raise AssertionError("more frequent digests than counters")
    split = rows.join(F.broadcast(winners), "digest", "left")
    heavy = split.where(F.col("group_size").isNotNull()).withColumn("kept", F.col("row") == F.col("keep_row"))
    own = Window.partitionBy("digest")
    light = (split.where(F.col("group_size").isNull()).select("digest", "id", "row")
             .withColumn("kept", F.row_number().over(own.orderBy(F.desc_nulls_last("id"), "row")) == 1)
             .withColumn("keep_id", F.max("id").over(own))
             .withColumn("group_size", F.count(F.lit(1)).over(own)))
    columns = ["digest", "id", "keep_id", "group_size", "kept"]
    return heavy.select(*columns).unionByName(light.select(*columns)).select(
        F.col("id").alias(id_col), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))
