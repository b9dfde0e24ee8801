"""JSON / JSON Lines / CSV / JSON-dictionary readers with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from relnorm.functions.text import orient_pair
from relnorm.sources.blocks import BLOCK_BYTES, listed, split_records


def read_json_records(spark: SparkSession, path: str, schema: StructType | str | None = None,
                      multiline: bool = True, recursive: bool = False, strict: bool = False,
                      glob: str = "*.json", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """All JSON files of a folder; arrays of records or single objects.

    ``strict`` raises on a malformed file (FAILFAST).  Otherwise a bad record
    costs no other record (``json_rejects`` lists it) and empty files
    contribute nothing.  An array file larger than ``block_bytes`` is split
    over tasks (see ``blocks``).
    """
    if strict or schema is None:
        r = (spark.read.option("multiLine", str(multiline).lower())
             .option("recursiveFileLookup", str(recursive).lower()).option("pathGlobFilter", glob)
             .option("mode", "FAILFAST" if strict else "PERMISSIVE"))
        return (r.schema(schema) if schema is not None else r).json(path)
    texts = _json_texts(spark, path, multiline, recursive, glob, block_bytes)
    return _parsed(texts, schema).filter(~_bad_record()).select("record.*").drop("_corrupt_record")


def json_rejects(spark: SparkSession, path: str, schema: StructType | str, multiline: bool = True,
                 recursive: bool = False, glob: str = "*.json", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(path, text)`` of records that don't fit the schema, and of files that are no JSON."""
    texts = _json_texts(spark, path, multiline, recursive, glob, block_bytes)
    return _parsed(texts, schema).filter(_bad_record()).select("path", "text")


def _json_texts(spark: SparkSession, path: str, multiline: bool, recursive: bool, glob: str,
                block_bytes: int) -> DataFrame:
    """``(path, text)`` per record: elements of an array, a single object, or what is neither."""
    large = _large_files(spark, path, glob, recursive, block_bytes) if multiline else None
    keep = [] if large is None else [r[0] for r in large.collect()]
    raw = (spark.read.option("recursiveFileLookup", str(recursive).lower()).option("pathGlobFilter", glob)
           .text(path, wholetext=multiline))
    at = F.col("_metadata.file_path")
    small = raw.filter(~at.isin(keep)) if keep else raw
    small = small.filter(F.col("value").rlike(r"\S"))
    is_array = F.col("value").rlike(r"\A\s*\[")
    elements = F.when(is_array, F.from_json("value", "array<string>"))
    small = small.select(at.alias("path"), F.explode(F.coalesce(elements, F.array("value"))).alias("text"))
    return small.unionByName(split_records(large, "json", block_bytes)[0].select("path", "text")) if keep else small


def _large_files(spark: SparkSession, path: str, glob: str | None, recursive: bool, block_bytes: int) -> DataFrame:
    """Files to split; compressed ones can't be, the plain readers take them."""
    packed = F.col("path").rlike(r"\.(gz|bz2|zst|lz4|snappy|deflate|xz)$")
    return listed(spark, path, glob, recursive).filter((F.col("length") > block_bytes) & ~packed)


def _parsed(texts: DataFrame, schema: StructType | str) -> DataFrame:
    kind = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    kind = StructType([*kind.fields, StructField("_corrupt_record", StringType())])
    return texts.withColumn("record", F.from_json("text", kind, {"mode": "PERMISSIVE"}))


def _bad_record():
    return F.col("record").isNull() | F.col("record._corrupt_record").isNotNull()


def read_json_lines(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


_CSV = {"quote": '"', "escape": '"'}


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             columns=None, header: bool = True, multiline: bool = True, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """CSV with header; codes stay strings (pass a schema — never infer — so
    leading zeros survive).

    ``multiline`` allows line breaks in quoted fields.  Files up to
    ``block_bytes`` are then one task each; larger ones are split by their
    quotes (see ``blocks``), except files with a quote inside an unquoted
    field, which only the plain reader takes.  Without it Spark splits files
    at line breaks.
    """
    def plain(paths):
        r = spark.read.options(**_CSV).option("header", str(header).lower()).option("multiLine", str(multiline).lower())
        return (r.schema(schema) if schema is not None else r.option("inferSchema", "false")).csv(paths)

    large = [(r.path, r.length) for r in _large_files(spark, path, None, False, block_bytes).collect()] \
        if multiline else []
    if not large:
        df = plain(path)
        return df.select(*columns) if columns else df
    files = spark.createDataFrame(large, "path string, length long")
    records, refused = split_records(files, "csv", block_bytes)
    kind = plain(path).schema  # a schema that is not given is that of the first line
    if header:
        records = records.filter(F.col("at") > 0)
    rows = records.filter(F.col("text").rlike(r"\S")).select(
        F.from_csv("text", F.lit(kind.toDDL()), {**_CSV, "mode": "PERMISSIVE"}).alias("row")).select("row.*")
    whole = {p for p, _ in large} - set(refused)
    small = [r.path for r in listed(spark, path, None, False).select("path").collect() if r.path not in whole]
    df = rows.unionByName(plain(small)) if small else rows
    return df.select(*columns) if columns else df


def read_json_dictionary(spark: SparkSession, path: str, key: str = "place_wikidata_id") -> DataFrame:
    """A JSON object ``{id: [a, b]}`` per file → rows ``(key, label, wikidata_id)``;
    the pair is oriented so the ``Q…`` element is the id."""
    raw = spark.read.text(path, wholetext=True)  # the argument: it overrides an option
    m = F.from_json("value", "map<string,array<string>>")
    ex = raw.select(F.explode(m).alias(key, "_pair"))
    o = orient_pair(F.col("_pair"))
    return ex.select(key, o["label"].alias("label"), o["wikidata_id"].alias("wikidata_id"))


def json_map_entries(df: DataFrame, json_col: str, id_cols, key: str = "key", value: str = "value") -> DataFrame:
    """A JSON-object string column → one row per entry ``(ids…, key, value)``."""
    m = F.from_json(F.col(json_col), "map<string,string>")
    return df.select(*id_cols, F.explode(m).alias(key, value))
