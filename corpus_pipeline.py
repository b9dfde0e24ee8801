"""A training-data pipeline over `documents`: each stage filters what the one before kept, the last one packs.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relnorm.llm.decontamination import contamination
from relnorm.llm.exact_dedup import exact_dedup
from relnorm.llm.ngram_jaccard import near_duplicates
from relnorm.llm.queries import read, tokenizer_path
from relnorm.llm.packing import pack
from relnorm.llm.shared import staged
from relnorm.llm.toxicity import drop_toxic


def row_key(docs: DataFrame) -> Column:
    """A struct, never null, that tells rows of different doc_id or text apart; rows without a doc_id come last."""
    id_ = docs["doc_id"].cast("long")
    return F.struct(id_.isNull().alias("absent"), id_.alias("id"),
                    F.unhex(F.sha2(F.coalesce(docs["text"], F.lit("")), 256)).alias("digest"))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject, every row on its own.

    A null or empty text is judged by the model's bias; an empty table stays empty.
    """
    return drop_toxic(docs, read(spark, sf_dir, "labels"))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id; of its repeated rows the one with the smallest other columns.

    A null text equals an empty one, a null doc_id is the smallest; an empty table stays empty.
    """
    key = lambda id_, digest: F.struct(id_.cast("long").alias("id"), F.unhex(digest).alias("digest"))
    kept = exact_dedup(docs).where("kept").select(key(F.col("doc_id"), F.col("text_sha256")).alias("key"))
    rows = docs.select(key(docs["doc_id"], F.sha2(F.coalesce("text", F.lit("")), 256)).alias("key"),
                       F.struct("*").alias("row"))
    # Repeated rows meet before the only shuffle of the texts; the join reuses its partitioning.
    return rows.groupBy("key").agg(F.min("row").alias("row")).join(kept, "key", "left_semi").select("row.*")


def near_duplicate_groups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of similar documents the row with the smallest doc_id, one without a doc_id last.

    Rows are judged one by one by doc_id and text; the smaller digest of the text decides between equal ids.
    Null texts and texts without words are near nothing; an empty table stays empty.
    """
    groups = near_duplicates(docs.select(row_key(docs).alias("key"), "text"), id_col="key")
    gone = groups.where("component_id <> key").select(F.col("key").alias("_key"))
    return docs.join(gone, row_key(docs) == gone["_key"], "left_anti").select(docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item; rows are judged one by one by doc_id and text.

    Null and empty texts stay; an empty benchmark or table changes nothing.
    """
    keyed = docs.select(row_key(docs).alias("key"), "text")
    hit = contamination(keyed, read(spark, sf_dir, "benchmark"), id_col="key").where("contaminated")
    hit = staged(hit.select(F.col("key").alias("_key")).distinct(), "contaminated")
    return docs.join(hit, row_key(docs) == hit["_key"], "left_anti")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences of at most 2048 tokens.

    A null or empty text is its end token alone; repeated rows are packed each; an empty table gives no pieces.
    """
    pieces = pack(docs, tokenizer_path())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset")


STAGES = [
    ("toxicity", toxicity),
    ("exact_duplicates", exact_duplicates),
    ("near_duplicate_groups", near_duplicate_groups),
    ("benchmark_decontamination", benchmark_decontamination),
    ("packing", packing),
]

#: A fitted classifier and a tokenizer are part of the stages: SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole `documents` table, each written and read again; see each for nulls and ties."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
