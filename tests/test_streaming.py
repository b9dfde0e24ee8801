from pyspark.sql import functions as F

from relnorm.sinks.incremental import read_store
from relnorm.streaming import ingest_new_files


def test_ingest_new_files_idempotent(spark, scratch):
    src, store, ck = f"{scratch}/in", f"{scratch}/store", f"{scratch}/ck"
    spark.range(0, 6).select(F.col("id").alias("k"), F.lit("a").alias("v")).write.parquet(f"{src}/b1")
    ingest_new_files(spark, src + "/*", "k long, v string", store, ["k"], ck, pk="pk")
    # a second file repeats keys 3..5 with other values and adds 6..8
    spark.range(3, 9).select(F.col("id").alias("k"), F.lit("b").alias("v")).write.parquet(f"{src}/b2")
    ingest_new_files(spark, src + "/*", "k long, v string", store, ["k"], ck, pk="pk")
    ingest_new_files(spark, src + "/*", "k long, v string", store, ["k"], ck, pk="pk")
    got = {r.k: (r.v, r.pk) for r in read_store(spark, store).collect()}
    assert got == {**{k: ("a", k + 1) for k in range(6)}, **{k: ("b", k + 1) for k in range(6, 9)}}
