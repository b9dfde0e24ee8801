"""Catalog: sources and sinks.  Each query writes whole given tables through a
sink into a fresh scratch folder under the shared checkpoint folder, reads
them back through a source, and returns what was read — so the SQL text is
simply the source table."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DoubleType, LongType, StringType, StructField,
                               StructType)

from relnorm import operators as O
from relnorm.plans.registry import query, table
from relnorm.session import scratch_path
from relnorm.sinks import fixtures as SK
from relnorm.sinks.incremental import append_distinct, insert_if_absent, read_store
from relnorm.sources import tables as ST


def _scratch(spark, tag):
    return scratch_path(spark, f"{tag}-{uuid.uuid4().hex[:12]}")


_ORDERS_FIELDS = StructType([StructField("o_orderkey", LongType()), StructField("o_custkey", LongType()),
                             StructField("o_orderstatus", StringType()), StructField("o_totalprice", DoubleType())])


@query("fixture_json_roundtrip", covers=("SNK-1", "SRC-7", "PRJ-19", "PRJ-20", "KEY-4"), sql="""
SELECT row_number() OVER (ORDER BY o_orderkey) AS pk, 'orders' AS model, o_orderkey, o_custkey, o_orderstatus,
       o_totalprice, lpad(CAST(CAST(floor((row_number() OVER (ORDER BY o_orderkey) - 1) / 1000) + 1 AS BIGINT) AS VARCHAR), 6, '0') AS chunk
FROM orders""")
def fixture_json_roundtrip(spark, sf):
    o = table(spark, sf, "orders").select(*_ORDERS_FIELDS.fieldNames())
    k = O.dense_key(o, ["o_orderkey"])
    out = _scratch(spark, "json")
    SK.write_fixture_json(k, out, "orders", chunk_size=1000)
    schema = StructType([StructField("pk", LongType()), StructField("model", StringType()),
                         StructField("fields", _ORDERS_FIELDS)])
    back = ST.read_json_lines(spark, out, schema)
    return back.select("pk", "model", "fields.*", F.regexp_extract(F.col("_metadata.file_name"), r"-(\d+)\.", 1).alias("chunk"))


@query("fixture_json_array_roundtrip", covers=("SNK-1", "SRC-6"), sql="""
SELECT row_number() OVER (ORDER BY c_custkey) AS pk, c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey
FROM customer""")
def fixture_json_array_roundtrip(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_name", F.col("c_nationkey").cast("bigint").alias("c_nationkey"))
    k = O.dense_key(c, ["c_custkey"])
    out = _scratch(spark, "jsonarr")
    SK.write_fixture_json(k, out, "customer", chunk_size=1000, array=True)
    schema = StructType([StructField("pk", LongType()), StructField("model", StringType()),
                         StructField("fields", StructType([StructField("c_custkey", LongType()),
                                                           StructField("c_name", StringType()),
                                                           StructField("c_nationkey", LongType())]))])
    # files larger than a block are split over tasks
    back = ST.read_json_records(spark, out, schema, block_bytes=8 << 10)
    return O.flatten_records(back)


@query("fixture_csv_roundtrip", covers=("SNK-2", "SRC-8"), sql="""
SELECT row_number() OVER (ORDER BY s_suppkey) AS pk, lpad(CAST(s_suppkey AS VARCHAR), 10, '0') AS code,
       replace(s_name, '#', ',"' || chr(10)) AS s_name, s_acctbal
FROM supplier""")
def fixture_csv_roundtrip(spark, sf):
    s = table(spark, sf, "supplier").select(F.lpad(F.col("s_suppkey").cast("string"), 10, "0").alias("code"),
                                            F.replace("s_name", F.lit("#"), F.lit(',"\n')).alias("s_name"), "s_acctbal")
    k = O.dense_key(s, ["code"])
    out = _scratch(spark, "csv")
    SK.write_fixture_csv(k, out, chunk_size=500)
    schema = StructType([StructField("pk", LongType()), StructField("code", StringType()),
                         StructField("s_name", StringType()), StructField("s_acctbal", DoubleType())])
    # quoted line breaks; files larger than a block are split over tasks
    back = ST.read_csv(spark, out, schema, block_bytes=8 << 10)
    return back.select("pk", "code", "s_name", "s_acctbal")


@query("multi_format_export", covers=("SNK-3",), sql="""
SELECT t, f, pk, k, name, balance
FROM (SELECT 'supplier' AS t, row_number() OVER (ORDER BY s_suppkey) AS pk, s_suppkey AS k, s_name AS name, s_acctbal AS balance FROM supplier
      UNION ALL SELECT 'customer', row_number() OVER (ORDER BY c_custkey), c_custkey, c_name, c_acctbal FROM customer)
CROSS JOIN (VALUES ('json'), ('csv'), ('parquet')) AS v(f)""")
def multi_format_export(spark, sf):
    tabs = {t: O.dense_key(table(spark, sf, t).select(F.col("s_suppkey" if c == "s" else "c_custkey").alias("k"), F.col(f"{c}_name").alias("name"),
                                                      F.col(f"{c}_acctbal").alias("balance")), ["k"])
            for t, c in (("supplier", "s"), ("customer", "c"))}
    base = _scratch(spark, "export")
    paths = SK.export_tables(tabs, base, formats=("json", "csv", "parquet"))
    parts, fields = [], "k bigint, name string, balance double"
    for (name, fmt), p in paths.items():
        if fmt == "json":
            df = O.flatten_records(spark.read.schema(f"pk bigint, fields struct<{fields.replace(' ', ':').replace(',:', ',')}>").json(p))
        elif fmt == "csv":
            df = spark.read.option("header", "true").schema(f"pk bigint, {fields}").csv(p)
        else:
            df = spark.read.parquet(p)
        parts.append(df.select(F.lit(name).alias("t"), F.lit(fmt).alias("f"), "pk", "k", "name", "balance"))
    return O.union_all(*parts)


@query("insert_if_absent", covers=("SNK-4",), sql="""
WITH e AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS pk FROM orders WHERE o_orderkey % 2 = 0),
o AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) + (SELECT count(*) FROM e) AS pk FROM orders WHERE o_orderkey % 2 <> 0)
SELECT pk, o_orderkey FROM e UNION ALL SELECT pk, o_orderkey FROM o""")
def insert_if_absent_orders(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    store = _scratch(spark, "store")
    # first run: half the orders; second run: all orders — nothing stored moves
    insert_if_absent(spark, o.filter(F.col("o_orderkey") % 2 == 0), store, ["o_orderkey"], pk="pk")
    insert_if_absent(spark, o, store, ["o_orderkey"], pk="pk")
    return read_store(spark, store).select("pk", "o_orderkey")


@query("append_distinct", covers=("SNK-5", "DED-5"), sql="""
SELECT DISTINCT doc_id, lang, source FROM documents""")
def append_distinct_documents(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang", "source")
    store = _scratch(spark, "items")
    append_distinct(spark, d, store)
    append_distinct(spark, d, store)
    return read_store(spark, store)


@query("table_to_records", covers=("SNK-6",), sql="""
SELECT c_custkey AS pk, 'customerlinks' AS model, c_name,
       CAST(c_nationkey AS VARCHAR) || ',' || CAST(c_custkey AS VARCHAR) AS ids
FROM customer""")
def table_to_records(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("pk"), "c_name",
                                            F.array(F.col("c_nationkey").cast("bigint"), F.col("c_custkey")).alias("ids"))
    out = _scratch(spark, "tocsv")
    SK.write_fixture_csv(c, out, chunk_size=10_000)
    flat = ST.read_csv(spark, out, "pk bigint, c_name string, ids string")
    rec = SK.table_to_records(flat, "CustomerLinks", {"ids": "array<bigint>"})
    return rec.select("pk", "model", "fields.c_name",
                      F.array_join(F.transform("fields.ids", lambda x: x.cast("string")), ",").alias("ids"))


@query("compressed_output", covers=("SNK-7",), sql="""
SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
                                   l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS pk,
       l_orderkey, l_returnflag, l_extendedprice, '1F8B' AS magic FROM lineitem""")
def compressed_output(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                                             "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
                                             "l_linestatus", "l_shipdate")
    k = O.dense_key(li, li.columns).select("pk", "l_orderkey", "l_returnflag", "l_extendedprice")
    out = _scratch(spark, "gz")
    SK.write_fixture_json(k, out, "lineitem", chunk_size=20_000, compression="gzip")
    schema = "pk bigint, model string, fields struct<l_orderkey:bigint, l_returnflag:string, l_extendedprice:double>"
    back = ST.read_json_lines(spark, out, schema)
    heads = spark.read.format("binaryFile").load(out).select(F.hex(F.substring("content", 1, 2)).alias("magic"))
    head = heads.agg(F.array_join(F.sort_array(F.collect_set("magic")), ",").alias("magic"))  # one row
    return back.select("pk", "fields.*").crossJoin(F.broadcast(head))


@query("json_object_entries", covers=("SRC-9", "EXT-5"), sql="""
SELECT event_id, k AS prop_key, json_extract_string(props, '$."' || k || '"') AS prop_value
FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events)""")
def json_object_entries(spark, sf):
    e = table(spark, sf, "events")
    return ST.json_map_entries(e, "props", ["event_id"], key="prop_key", value="prop_value")


@query("json_dictionary_files", covers=("SRC-9", "PRJ-18"), sql="""
SELECT 'P' || CAST(s_suppkey AS VARCHAR) AS place_wikidata_id, s_name AS label, 'Q' || CAST(s_nationkey AS VARCHAR) AS wikidata_id
FROM supplier""")
def json_dictionary_files(spark, sf):
    s = table(spark, sf, "supplier")
    q = F.concat(F.lit("Q"), F.col("s_nationkey").cast("string"))
    pair = F.when(F.col("s_suppkey") % 2 == 0, F.array(q, "s_name")).otherwise(F.array("s_name", q))
    entries = s.select(F.floor(F.col("s_suppkey") / 100).alias("part"),
                       F.concat(F.lit("P"), F.col("s_suppkey").cast("string")).alias("k"), pair.alias("v"))
    # one JSON object per file of at most 100 entries
    files = entries.groupBy("part").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("k", "v")))).alias("value"))
    out = _scratch(spark, "dict")
    files.repartition("part").write.partitionBy("part").text(out)
    return ST.read_json_dictionary(spark, out)
