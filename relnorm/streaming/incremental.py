"""Cross-run ingestion: each new input file is applied to a keyed parquet
store with insert-if-absent, so existing records (and their keys) never
change and re-runs are idempotent.

Structured Streaming tracks which files were already processed in its
checkpoint; ``availableNow`` processes everything new and stops, which is
the batch-job form of the same pipeline.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from relnorm.sinks.incremental import insert_if_absent


def ingest_new_files(spark: SparkSession, source: str, schema: StructType | str, store: str,
                     keys, checkpoint: str, fmt: str = "parquet", order_by=None,
                     pk: str | None = None, transform=None):
    """Start (and wait for) an ``availableNow`` stream that inserts the new
    rows of newly arrived files into ``store``.  ``checkpoint`` must be on
    shared storage.  ``transform`` maps each micro-batch before insertion."""
    stream = spark.readStream.format(fmt).schema(schema).load(source)

    def apply(batch: DataFrame, epoch_id: int) -> None:
        df = transform(batch) if transform else batch
        insert_if_absent(batch.sparkSession, df, store, keys, order_by=order_by, pk=pk)

    q = (stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q
