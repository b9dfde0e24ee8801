"""Catalog: the three jobs over files made from the given tables.

Archives, CSVs and JSON files are written from the tables first; the jobs read
them, write their outputs, and every query returns one of those outputs as it
was written.  A session runs each job once per folder of tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from relnorm import operators as O
from relnorm.plans.archive_files import write_archives
from relnorm.plans.registry import query, table
from relnorm.session import brief_shuffles, scratch_path
from relnorm.sources.archives import archive_entries, archive_manifest
from relnorm.sources.files import qualified, remove_folder

RUN_TS = "2024-01-01 00:00:00.000000+00:00"
_runs: dict = {}


def _scratch(spark, tag):
    return qualified(spark, scratch_path(spark, f"{tag}-{uuid.uuid4().hex[:12]}"))


def _once(spark, sf, job):
    """What ``job(spark, sf)`` returned in this session."""
    key = (spark.sparkContext.applicationId, sf, job.__name__)
    if key not in _runs:
        _runs[key] = job(spark, sf)
    return _runs[key]


def _outputs(spark, out, name, fields):
    """A table written as numbered fixture JSON."""
    back = spark.read.schema(f"pk bigint, fields struct<{fields}>").json(f"{out}/{name}")
    return O.flatten_records(back)


# --------------------------------------------------------------------------
# Archives of texts
# --------------------------------------------------------------------------

_TEXT_ENTRIES = """
WITH a AS (SELECT doc_id, source || '-' || lpad(CAST(CAST(floor(doc_id / 100) AS BIGINT) AS VARCHAR), 6, '0') || '_plaintext.zip' AS archive,
                  source || '/' || lpad(CAST(doc_id AS VARCHAR), 9, '0') || '.txt' AS path, coalesce(text, '') AS text FROM documents)"""


def _document_entries(spark, sf, folder, method="deflated"):
    """``documents`` as ``<source>/<doc_id>.txt`` entries of archives of at most 100 documents."""
    d = table(spark, sf, "documents")
    arch = F.concat(F.col("source"), F.lit("-"), F.lpad(F.floor(F.col("doc_id") / 100).cast("string"), 6, "0"),
                    F.lit("_plaintext.zip"))
    entry = F.concat(F.col("source"), F.lit("/"), F.lpad(F.col("doc_id").cast("string"), 9, "0"), F.lit(".txt"))
    return d.select("doc_id", F.lit(folder).alias("folder"), arch.alias("archive"), F.lit(method).alias("method"),
                    entry.alias("entry"), F.coalesce("text", F.lit("")).cast("binary").alias("body"))


def _stored_archives(spark, sf):
    folder = _scratch(spark, "stored")
    write_archives(_document_entries(spark, sf, folder, "stored").drop("doc_id"))
    return folder


@query("archive_manifest", covers=("SRC-1", "ORD-1"), sql=_TEXT_ENTRIES + """
SELECT archive AS archive_name, CAST(22 + sum(76 + 2 * strlen(path) + strlen(text)) AS BIGINT) AS length FROM a GROUP BY archive""")
def archive_manifest_of_documents(spark, sf):
    return archive_manifest(spark, _once(spark, sf, _stored_archives)).select("archive_name", "length")


@query("archive_entry_manifest", covers=("SRC-3", "SRC-1"), sql=_TEXT_ENTRIES + """
SELECT archive, row_number() OVER w - 1 AS entry_index, path AS entry_name, CAST(strlen(text) AS BIGINT) AS file_size,
       CAST(strlen(text) AS BIGINT) AS compress_size,
       CAST(coalesce(sum(30 + strlen(path) + strlen(text)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS header_offset,
       true AS crc_matches
FROM a WINDOW w AS (PARTITION BY archive ORDER BY path)""")
def archive_entry_manifest(spark, sf):
    # names, sizes and CRCs from the directories alone; nothing is inflated
    e = archive_entries(spark, _once(spark, sf, _stored_archives), split_bytes=1 << 20)
    d = table(spark, sf, "documents").select("doc_id", F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc"))
    e = e.withColumn("doc_id", F.regexp_extract("entry_name", r"(\d+)\.txt$", 1).cast("bigint")).join(d, "doc_id")
    return e.select(F.regexp_extract("archive", r"([^/]+)$", 1).alias("archive"), "entry_index", "entry_name", "file_size",
                    "compress_size", "header_offset", (F.col("crc") == F.col("text_crc")).alias("crc_matches"))


@query("fulltext_from_archives", covers=("JOB-3", "SRC-2", "SRC-3", "SRC-4", "PRJ-24", "KEY-3"), sql=_TEXT_ENTRIES + """
SELECT row_number() OVER (ORDER BY archive, path) + 4 AS pk, path, archive,
       md5(regexp_replace(text, '\\r\\n?', chr(10), 'g')) AS text_md5, CAST(NULL AS VARCHAR) AS errors
FROM a""")
def fulltext_from_archives(spark, sf):
    from relnorm.plans.fulltext import fulltext_table
    folder = _scratch(spark, "zips")
    write_archives(_document_entries(spark, sf, folder).drop("doc_id"))
    t = fulltext_table(spark, folder, initial_pk=5)
    return t.select("pk", "path", F.regexp_extract("compressed_path", r"([^/]+)$", 1).alias("archive"),
                    F.md5("text").alias("text_md5"), "errors")


def _mixed_fulltext(spark, sf):
    """Documents as archive entries, some of them loose files (1 of 4), not valid UTF-8 (1 of 4) or repeated with
    another text in a later archive (1 of 5), and an archive a source that is none; the job's output folder."""
    from relnorm.plans import fulltext
    folder, out = _scratch(spark, "mixed"), _scratch(spark, "fulltext")
    e = _document_entries(spark, sf, folder)
    kind = F.col("doc_id") % 4
    loose = e.filter(kind == 2).select(
        F.lit(f"{folder}/loose").alias("folder"), F.regexp_extract("entry", r"([^/]+)$", 1).alias("archive"),
        F.lit("raw").alias("method"), "entry", "body")
    packed = e.filter(kind != 2).withColumn("body", F.when(kind == 3, F.concat(F.unhex(F.lit("FF")), "body")).otherwise(F.col("body")))
    again = packed.filter(F.col("doc_id") % 5 == 0).withColumns(
        {"archive": F.concat(F.lit("zz-"), "archive"), "body": F.lit("another text").cast("binary")})
    broken = e.select(F.regexp_extract("entry", r"^([^/]+)/", 1).alias("source")).distinct().select(
        F.lit(folder).alias("folder"), F.concat(F.lit("broken-"), "source", F.lit(".zip")).alias("archive"),
        F.lit("raw").alias("method"), F.lit("").alias("entry"), F.lit("no archive at all").cast("binary").alias("body"))
    write_archives(packed.drop("doc_id").union(again.drop("doc_id")).union(loose).union(broken))
    counts = fulltext.run(spark, folder, out, initial_pk=5)
    return out, counts


@query("fulltext_job_records", covers=("JOB-3", "SRC-4", "SRC-5", "SET-3", "KEY-3", "PRJ-24", "SNK-1", "AUD-1"), sql=_TEXT_ENTRIES + """,
e AS (SELECT row_number() OVER (ORDER BY (doc_id % 4 = 2)::INT, CASE WHEN doc_id % 4 <> 2 THEN archive END,
                                         CASE WHEN doc_id % 4 <> 2 THEN path ELSE regexp_extract(path, '[^/]+$') END) + 4 AS pk, * FROM a)
SELECT pk, CASE WHEN doc_id % 4 = 2 THEN 'loose/' || regexp_extract(path, '[^/]+$') ELSE path END AS path,
       CASE WHEN doc_id % 4 <> 2 THEN archive END AS archive,
       md5(CASE WHEN doc_id % 4 = 3 THEN '' ELSE regexp_replace(text, '\\r\\n?', chr(10), 'g') END) AS text_md5,
       CASE WHEN doc_id % 4 = 3 THEN 'invalid UTF-8 byte sequence' END AS errors,
       'fulltext-' || lpad(CAST((pk - 5) // 100 + 1 AS VARCHAR), 6, '0') || '.jsonl' AS file FROM e""")
def fulltext_job_records(spark, sf):
    out, _ = _once(spark, sf, _mixed_fulltext)
    back = spark.read.schema("pk bigint, fields struct<text:string,path:string,compressed_path:string,errors:string>").json(
        f"{out}/fulltext").withColumn("file", F.col("_metadata.file_name"))
    path = F.col("fields.path")
    return back.select("pk", F.when(F.col("fields.compressed_path").isNull(), F.regexp_extract(path, r"(loose/[^/]+)$", 1))
                       .otherwise(path).alias("path"),
                       F.nullif(F.regexp_extract(F.coalesce("fields.compressed_path", F.lit("")), r"([^/]+)$", 1), F.lit("")).alias("archive"),
                       F.md5("fields.text").alias("text_md5"), F.col("fields.errors").alias("errors"), "file")


@query("fulltext_job_unreadable", covers=("JOB-3", "AUD-1"), sql="""
SELECT DISTINCT 'broken-' || source || '.zip' AS archive, 'unreadable archive' AS error FROM documents""")
def fulltext_job_unreadable(spark, sf):
    out, _ = _once(spark, sf, _mixed_fulltext)
    back = spark.read.schema("archive string, error string").json(f"{out}/unreadable_archives")
    return back.select(F.regexp_extract("archive", r"([^/]+)$", 1).alias("archive"), "error")


@query("fulltext_job_counts", covers=("JOB-3", "AGG-5"), sql="""
SELECT 'fulltext' AS model, count(*) AS n_records FROM documents
UNION ALL SELECT 'unreadable_archives', count(DISTINCT source) FROM documents""")
def fulltext_job_counts(spark, sf):
    _, counts = _once(spark, sf, _mixed_fulltext)
    return spark.createDataFrame(list(counts.items()), "model string, n_records bigint")


# --------------------------------------------------------------------------
# News job
# --------------------------------------------------------------------------

@query("news_job_items", covers=("JOB-1", "SRC-1", "SRC-2", "SRC-3", "EXT-8", "KEY-2", "JON-1", "JON-2",
                                 "DED-2", "DED-5", "PRJ-27"), sql="""
WITH s AS (SELECT *, 'col' || CAST(o_custkey % 3 AS VARCHAR) AS coll, lpad(CAST(o_custkey AS VARCHAR), 7, '0') AS code,
                  substr(regexp_replace(lpad(CAST(o_custkey AS VARCHAR), 7, '0'), '^0+', ''), 1, 2) AS h FROM orders),
s2 AS (SELECT *, CASE WHEN length(h) = 1 THEN '0' || h ELSE h END AS shard,
              code || '-' || strftime(o_orderdate, '%Y%m%d') AS issue_code FROM s),
prov AS (SELECT coll, row_number() OVER (ORDER BY coll) AS pk FROM (SELECT DISTINCT coll FROM s2)),
dig AS (SELECT sw, row_number() OVER (ORDER BY sw) AS pk
        FROM (SELECT DISTINCT 'abbyy/' || o_orderpriority AS sw FROM orders WHERE o_orderstatus <> 'F')),
ing AS (SELECT v, row_number() OVER (ORDER BY v) AS pk FROM (SELECT DISTINCT o_orderstatus AS v FROM orders)),
iss AS (SELECT issue_code, max(pk) AS pk FROM (
          SELECT issue_code, row_number() OVER (ORDER BY coll, shard, code, issue_code) AS pk
          FROM (SELECT DISTINCT coll, shard, code, issue_code FROM s2)) GROUP BY issue_code)
SELECT row_number() OVER (ORDER BY s2.coll, shard, code, s2.issue_code || '-art' || CAST(o_orderkey AS VARCHAR)) AS pk,
       s2.issue_code || '-art' || CAST(o_orderkey AS VARCHAR) AS item_code,
       CAST(floor(o_totalprice) AS BIGINT) AS word_count,
       'Article ' || CAST(o_orderkey AS VARCHAR) || ':' AS title,
       CASE WHEN o_orderstatus <> 'P' THEN 'ARTICLE' END AS item_type,
       'art' || CAST(o_orderkey AS VARCHAR) || '.txt' AS input_filename,
       CASE WHEN o_orderstatus = 'O' THEN 0.0 ELSE CAST('0.' || CAST(o_orderkey % 100 AS VARCHAR) AS DOUBLE) END AS ocr_quality_mean,
       CASE WHEN o_orderstatus = 'F' THEN 0.0 ELSE CAST('0.0' || CAST(o_orderkey % 10 AS VARCHAR) AS DOUBLE) END AS ocr_quality_sd,
       dig.pk AS digitisation_id, ing.pk AS ingest_id, iss.pk AS issue_id, prov.pk AS data_provider_id
FROM s2 LEFT JOIN dig ON dig.sw = CASE WHEN o_orderstatus <> 'F' THEN 'abbyy/' || o_orderpriority END
LEFT JOIN ing ON ing.v = o_orderstatus LEFT JOIN iss ON iss.issue_code = s2.issue_code
LEFT JOIN prov ON prov.coll = s2.coll""")
def news_job_items(spark, sf):
    from relnorm.plans.catalog_columns import order_xml
    from relnorm.plans import news
    base = _scratch(spark, "news")
    x = order_xml(spark, sf)
    write_archives(x.select(
        F.concat(F.lit(base + "/"), "collection", F.lit("-alto2txt/metadata")).alias("folder"),
        F.concat(F.lit("A"), F.lpad(F.floor(F.col("doc_key") / 1000).cast("string"), 5, "0"),
                 F.lit("_metadata.zip")).alias("archive"),
        F.lit("deflated").alias("method"), F.concat(F.col("doc_key").cast("string"), F.lit(".xml")).alias("entry"),
        F.col("xml").cast("binary").alias("body")))
    tables = news.build_tables(spark, news.read_documents(spark, base))
    return tables["item"].drop("created_at", "updated_at")


# Every order is an article, every customer a paper.  Papers of odd customers
# have no title of their own; one article in 29 is no XML, one in 31 has no
# usable code, some have unreadable numbers or dates, and every collection
# holds a file that is no archive.

_PAPERS = """
WITH s AS (SELECT *, o_orderkey AS k, o_custkey AS c, lpad(CAST(o_custkey AS VARCHAR), 7, '0') AS code,
                  CASE o_custkey % 4 WHEN 0 THEN 'hmd' WHEN 1 THEN 'lwm' WHEN 2 THEN 'colA' ELSE 'colB' END AS coll,
                  CASE WHEN o_custkey % 70 = 69 THEN 'LSIR' ELSE 'AB' || CAST(o_custkey % 70 AS VARCHAR) END AS abbr,
                  substr(regexp_replace(lpad(CAST(o_custkey AS VARCHAR), 7, '0'), '^0+', ''), 1, 2) AS h,
                  CASE WHEN o_orderkey % 97 = 0 AND o_custkey % 2 = 0 THEN 'undated' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day,
                  CASE WHEN o_orderkey % 29 = 0 THEN 'malformed document'
                       WHEN o_orderkey % 31 = 0 AND o_custkey % 3 <> 0 THEN 'publication code look-up failed' END AS error FROM orders),
t AS (SELECT *, CASE WHEN length(h) = 1 THEN '0' || h ELSE h END AS shard, code || '-' || replace(day, '-', '') AS issue_code,
             coll || '/metadata/' || abbr || '_' || lpad(CAST(k // 5000 AS VARCHAR), 5, '0') || '_metadata.zip' AS archive FROM s),
e AS (SELECT *, row_number() OVER (PARTITION BY archive ORDER BY CAST(k AS VARCHAR) || '.xml') - 1 AS entry_index FROM t),
g AS (SELECT * FROM e WHERE error IS NULL),
au AS (SELECT 'The Gazette ' || s_name AS title, lpad(CAST(s_suppkey AS VARCHAR), 7, '0') AS code,
              'AB' || CAST(s_suppkey % 60 AS VARCHAR) AS abbr, s_suppkey < 20 AS valid FROM supplier),
p0 AS (SELECT DISTINCT coll, shard, code, c, abbr FROM g),
p1 AS (SELECT p0.*, CASE WHEN c % 2 = 0 THEN 'The Times of C' || CAST(c AS VARCHAR) || '.' ELSE '' END AS given,
              CASE WHEN c % 3 = 0 THEN (SELECT min(title) FROM au WHERE au.code = p0.code HAVING count(*) = 1) END AS t1,
              (SELECT min(title) FROM au WHERE au.abbr = p0.abbr AND valid HAVING count(*) = 1) AS t2,
              (SELECT min(title) FROM au WHERE au.abbr = p0.abbr HAVING count(DISTINCT title) = 1) AS t3,
              (SELECT min(title) FROM au WHERE au.abbr = p0.abbr AND au.code = p0.code HAVING count(DISTINCT title) = 1) AS t4 FROM p0),
p AS (SELECT row_number() OVER (ORDER BY coll, shard, code) AS pk, coll, code AS publication_code,
             CASE WHEN given <> '' THEN given WHEN c % 3 = 0 THEN coalesce(t1, '') WHEN t2 IS NOT NULL THEN t2 WHEN t3 IS NOT NULL THEN t3
                  WHEN t4 IS NOT NULL THEN t4 WHEN abbr = 'LSIR' THEN 'Leeds Intelligencer' ELSE abbr END AS title,
             CASE WHEN given <> '' THEN 'document' WHEN c % 3 = 0 THEN 'path_code' WHEN t2 IS NOT NULL THEN 'interval'
                  WHEN t3 IS NOT NULL THEN 'sole_title' WHEN t4 IS NOT NULL THEN 'abbreviation_code'
                  WHEN abbr = 'LSIR' THEN 'exception' ELSE 'abbreviation' END AS match_tier,
             CASE WHEN c % 5 = 0 THEN 'City' || CAST(c % 50 AS VARCHAR) END AS location FROM p1),
i AS (SELECT row_number() OVER (ORDER BY coll, shard, code, issue_code) AS pk, * FROM (SELECT DISTINCT coll, shard, code, c, issue_code, day FROM g)),
ing AS (SELECT v, row_number() OVER (ORDER BY v) AS pk FROM (SELECT DISTINCT o_orderstatus AS v FROM g)),
dig AS (SELECT sw, row_number() OVER (ORDER BY sw) AS pk FROM (SELECT DISTINCT 'abbyy/' || o_orderpriority AS sw FROM g WHERE o_orderstatus <> 'F')),
prov AS (SELECT coll, row_number() OVER (ORDER BY coll) AS pk FROM (SELECT DISTINCT coll FROM g))"""


def _write_papers(spark, sf, base):
    """The articles' archives, made of orders after these are dealt, and a file a collection that is none."""
    o = table(spark, sf, "orders")
    k, c, status = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus")
    code = F.lpad(c.cast("string"), 7, "0")
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    coll = F.when(c % 4 == 0, "hmd").when(c % 4 == 1, "lwm").when(c % 4 == 2, "colA").otherwise("colB")
    abbr = F.when(c % 70 == 69, "LSIR").otherwise(text("AB", c % 70))
    day = F.when((k % 97 == 0) & (c % 2 == 0), "undated").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    pid = F.when(c % 3 == 0, "").when(k % 31 == 0, "ABCD").otherwise(code)
    maybe = lambda cond, *parts: F.when(cond, text(*parts)).otherwise("")
    xml = text(
        "<lwm><process><input_sub_path>", F.when(c % 3 == 0, text("news/", code, "/x")).otherwise("news/x/x"),
        "</input_sub_path><xml_flavour>alto</xml_flavour>",
        maybe(status != "F", "<software>abbyy/", F.col("o_orderpriority"), "</software>"),
        "<mets_namespace>m</mets_namespace><alto_namespace>a</alto_namespace><lwm_tool><name>extract</name><version>",
        status, "</version></lwm_tool></process><publication id=\"", pid, "\"><title>",
        maybe(c % 2 == 0, "The Times of C", c, ". "), "</title>",
        maybe(c % 5 == 0, "<location>City", c % 50, "</location>"),
        "<issue><date>", day, "</date><item id=\"art", k, "\"><title>Article ", k, ":</title><word_count>",
        F.when(k % 13 == 0, "n/a").otherwise(F.floor("o_totalprice").cast("string")),
        "</word_count><ocr_quality_mean>", maybe(status != "O", "0.", k % 100), "</ocr_quality_mean>",
        "<plain_text_file>art", k, ".txt</plain_text_file>",
        maybe(status != "P", "<item_type>article</item_type>"), "</item></issue></publication></lwm>")
    folder = text(base + "/", coll, "/metadata")
    write_archives(
        o, folder=folder, archive=text(abbr, "_", F.lpad(F.floor(k / 5000).cast("string"), 5, "0"), "_metadata.zip"),
        method=F.lit("deflated"), entry=text(k, ".xml"), body=F.when(k % 29 == 0, "<lwm><process>").otherwise(xml).cast("binary"))
    write_archives(o.select(folder.alias("folder")).distinct().select(
        "folder", F.lit("ZZ_metadata.zip").alias("archive"), F.lit("raw").alias("method"), F.lit("").alias("entry"),
        F.lit("no archive at all").cast("binary").alias("body")))


def _news_run(spark, sf):
    from relnorm.plans import news
    base, out = _scratch(spark, "news"), _scratch(spark, "newsout")
    with brief_shuffles(spark):
        _write_papers(spark, sf, f"{base}/mount")
    s, key = table(spark, sf, "supplier"), F.col("s_suppkey")
    valid = key < 20
    parts = [F.concat(F.lit("Gazette "), F.col("s_name"), F.lit(", The")), key.cast("string"),
             F.concat(F.lit("AB"), (key % 60).cast("string")), F.lit("1"), F.lit("Jan."), F.when(valid, "1990").otherwise("1800"),
             F.lit("31"), F.lit("Dec."), F.when(valid, "2010").otherwise("1810")]
    (s.select(*[p.alias(n) for p, n in zip(parts, news.AUTHORITY_COLUMNS)])
     .write.option("header", "true").csv(f"{base}/authority"))
    counts = news.run(spark, f"{base}/mount", out, f"{base}/authority", max_elements_per_file=1000, run_ts=RUN_TS,
                      requested=["hmd", "lwm", "colA", "colB", "colC"],
                      after_reading=lambda: remove_folder(f"{base}/mount"))
    return out, counts


def _news(spark, sf, name, fields):
    return _outputs(spark, _once(spark, sf, _news_run)[0], name, fields)


def _news_rows(spark, sf, name, schema):
    return spark.read.schema(schema).json(f"{_once(spark, sf, _news_run)[0]}/{name}")


_SHORT = r"([^/]+/metadata/[^/]+)$"


@query("news_table_dataprovider", covers=("JOB-1", "EXT-7", "SRC-11"), sql=_PAPERS + f"""
SELECT prov.pk, CASE coll WHEN 'hmd' THEN 'Heritage Made Digital' WHEN 'lwm' THEN 'Living with Machines' ELSE coll END AS name,
       CASE coll WHEN 'hmd' THEN 'bl_hmd' WHEN 'lwm' THEN 'bl_lwm' ELSE lower(coll) END AS code,
       CASE WHEN coll IN ('hmd', 'lwm') THEN coll END AS legacy_code, 'newspapers' AS collection, '{RUN_TS}' AS created_at
FROM prov""")
def news_table_dataprovider(spark, sf):
    return _news(spark, sf, "dataprovider", "name:string,code:string,legacy_code:string,collection:string,created_at:string")


@query("news_table_ingest", covers=("JOB-1", "EXT-5"), sql=_PAPERS + """
SELECT pk, 'extract' AS lwm_tool_name, v AS lwm_tool_version FROM ing""")
def news_table_ingest(spark, sf):
    return _news(spark, sf, "ingest", "lwm_tool_name:string,lwm_tool_version:string")


@query("news_table_digitisation", covers=("JOB-1", "EXT-6"), sql=_PAPERS + """
SELECT pk, 'alto' AS xml_flavour, sw AS software, 'm' AS mets_namespace, 'a' AS alto_namespace FROM dig""")
def news_table_digitisation(spark, sf):
    return _news(spark, sf, "digitisation", "xml_flavour:string,software:string,mets_namespace:string,alto_namespace:string")


@query("news_table_newspaper", covers=("JOB-1", "EXT-2", "JON-8", "PRJ-3", "PRJ-14", "PRJ-15"), sql=_PAPERS + """
SELECT pk, publication_code, title, location FROM p""")
def news_table_newspaper(spark, sf):
    return _news(spark, sf, "newspaper", "publication_code:string,title:string,location:string")


@query("news_title_matches", covers=("JOB-1", "JON-8"), sql=_PAPERS + """
SELECT pk, coll AS collection, publication_code, match_tier FROM p""")
def news_title_matches(spark, sf):
    return _news_rows(spark, sf, "title_matches", "pk bigint, collection string, publication_code string, match_tier string")


@query("news_table_issue", covers=("JOB-1", "EXT-3", "JON-1"), sql=_PAPERS + """
SELECT i.pk, issue_code, day AS issue_date, p.pk AS newspaper_id,
       CASE WHEN c % 3 = 0 THEN 'news/' || code || '/x' ELSE 'news/x/x' END AS input_sub_path
FROM i JOIN p ON p.publication_code = i.code""")
def news_table_issue(spark, sf):
    return _news(spark, sf, "issue", "issue_code:string,issue_date:string,newspaper_id:bigint,input_sub_path:string")


@query("news_table_item", covers=("JOB-1", "EXT-4", "EXT-8", "JON-1", "JON-2", "KEY-2"), sql=_PAPERS + """
SELECT row_number() OVER (ORDER BY g.coll, g.shard, g.code, g.issue_code || '-art' || CAST(k AS VARCHAR)) AS pk,
       g.issue_code || '-art' || CAST(k AS VARCHAR) AS item_code,
       CASE WHEN k % 13 = 0 THEN 0 ELSE CAST(floor(o_totalprice) AS BIGINT) END AS word_count,
       'Article ' || CAST(k AS VARCHAR) || ':' AS title, CASE WHEN o_orderstatus <> 'P' THEN 'ARTICLE' END AS item_type,
       'art' || CAST(k AS VARCHAR) || '.txt' AS input_filename,
       CASE WHEN o_orderstatus = 'O' THEN 0.0 ELSE CAST('0.' || CAST(k % 100 AS VARCHAR) AS DOUBLE) END AS ocr_quality_mean,
       CAST(0 AS DOUBLE) AS ocr_quality_sd, dig.pk AS digitisation_id, ing.pk AS ingest_id, i.pk AS issue_id, prov.pk AS data_provider_id
FROM g LEFT JOIN dig ON dig.sw = CASE WHEN o_orderstatus <> 'F' THEN 'abbyy/' || o_orderpriority END
JOIN ing ON ing.v = o_orderstatus JOIN i ON i.issue_code = g.issue_code JOIN prov ON prov.coll = g.coll""")
def news_table_item(spark, sf):
    return _news(spark, sf, "item", "item_code:string,word_count:bigint,title:string,item_type:string,input_filename:string,"
                 "ocr_quality_mean:double,ocr_quality_sd:double,digitisation_id:bigint,ingest_id:bigint,issue_id:bigint,"
                 "data_provider_id:bigint")


@query("news_quarantine", covers=("JOB-1", "AUD-1", "EXT-1"), sql=_PAPERS + """
SELECT archive, entry_index, error FROM e WHERE error IS NOT NULL
UNION ALL SELECT DISTINCT coll || '/metadata/ZZ_metadata.zip', -1, 'unreadable archive' FROM e""")
def news_quarantine(spark, sf):
    back = _news_rows(spark, sf, "quarantine", "archive string, entry_index bigint, error string")
    return back.withColumn("archive", F.regexp_extract("archive", _SHORT, 1))


@query("news_rejected_values", covers=("JOB-1", "AUD-1", "PRJ-11"), sql=_PAPERS + """
SELECT archive, entry_index, 'word_count' AS field, 'n/a' AS value FROM g WHERE k % 13 = 0
UNION ALL SELECT archive, entry_index, 'issue_date', 'undated' FROM g WHERE day = 'undated'""")
def news_rejected_values(spark, sf):
    back = _news_rows(spark, sf, "rejected_values", "archive string, entry_index bigint, field string, value string")
    return back.withColumn("archive", F.regexp_extract("archive", _SHORT, 1))


@query("news_report", covers=("JOB-1", "AGG-4"), sql=_PAPERS + f"""
SELECT archive, coll AS collection, count(*) FILTER (error IS NULL) AS n_documents, count(*) FILTER (error IS NOT NULL) AS n_rejected,
       count(*) FILTER (error IS NULL) AS n_items, count(DISTINCT issue_code) FILTER (error IS NULL) AS n_issues,
       count(DISTINCT code) FILTER (error IS NULL) AS n_papers,
       coalesce(string_agg(DISTINCT code, ',' ORDER BY code) FILTER (error IS NULL), '') AS codes, '{RUN_TS}' AS run_id
FROM e GROUP BY archive, coll
UNION ALL SELECT DISTINCT coll || '/metadata/ZZ_metadata.zip', coll, 0, 1, 0, 0, 0, '', '{RUN_TS}' FROM e""")
def news_report(spark, sf):
    back = _news_rows(spark, sf, "report", "archive string, collection string, n_documents bigint, n_rejected bigint, n_items bigint, "
                      "n_issues bigint, n_papers bigint, publication_codes array<string>, run_id string")
    return back.select(F.regexp_extract("archive", _SHORT, 1).alias("archive"), "collection", "n_documents", "n_rejected", "n_items",
                       "n_issues", "n_papers", F.array_join("publication_codes", ",").alias("codes"), "run_id")


@query("news_collections", covers=("JOB-1", "AGG-7", "SET-1"), sql=_PAPERS + """
SELECT q.coll AS collection, count(DISTINCT archive) + CASE WHEN count(archive) > 0 THEN 1 ELSE 0 END AS n_archives,
       count(archive) = 0 AS is_empty
FROM (VALUES ('hmd'), ('lwm'), ('colA'), ('colB'), ('colC')) AS q(coll) LEFT JOIN e USING (coll) GROUP BY q.coll""")
def news_collections(spark, sf):
    return _news_rows(spark, sf, "collections", "collection string, n_archives bigint, is_empty boolean")


@query("news_checks", covers=("JOB-1", "JON-3", "AUD-1", "AUD-2"), sql=_PAPERS + """
SELECT 'newspaper without title' AS "check", count(*) AS n_rows FROM p WHERE title = ''
UNION ALL SELECT 'unresolved ' || x, 0 FROM (VALUES ('newspaper_id'), ('digitisation_id'), ('ingest_id'), ('issue_id'), ('data_provider_id')) AS v(x)""")
def news_checks(spark, sf):
    return _news_rows(spark, sf, "checks", "check string, n_rows bigint")


@query("news_counts", covers=("JOB-1", "AGG-5"), sql=_PAPERS + """
SELECT 'dataprovider' AS model, count(*) AS n_records FROM prov UNION ALL SELECT 'ingest', count(*) FROM ing
UNION ALL SELECT 'digitisation', count(*) FROM dig UNION ALL SELECT 'newspaper', count(*) FROM p
UNION ALL SELECT 'title_matches', count(*) FROM p UNION ALL SELECT 'issue', count(*) FROM i UNION ALL SELECT 'item', count(*) FROM g
UNION ALL SELECT 'quarantine', count(*) + (SELECT count(DISTINCT coll) FROM e) FROM e WHERE error IS NOT NULL
UNION ALL SELECT 'rejected_values', (SELECT count(*) FROM g WHERE k % 13 = 0) + (SELECT count(*) FROM g WHERE day = 'undated')
UNION ALL SELECT 'report', count(DISTINCT archive) + count(DISTINCT coll) FROM e UNION ALL SELECT 'collections', 5""")
def news_counts(spark, sf):
    return spark.createDataFrame(list(_once(spark, sf, _news_run)[1].items()), "model string, n_records bigint")


@query("news_title_cascade", covers=("JON-8", "JON-7", "PRJ-2"), sql="""
WITH a AS (SELECT s_name AS title, lpad(CAST(s_suppkey AS VARCHAR), 7, '0') AS code, 'AB' || CAST(s_suppkey % 60 AS VARCHAR) AS abbr,
                  DATE '1800-01-01' + CAST(s_suppkey % 300 AS INTEGER) AS s, DATE '1800-01-01' + CAST(s_suppkey % 300 + 100 AS INTEGER) AS e FROM supplier),
p AS (SELECT o_orderkey AS paper, CASE WHEN o_orderkey % 5 = 0 THEN 'Given' ELSE '' END AS title,
             DATE '1800-01-01' + CAST(o_orderkey % 400 AS INTEGER) AS d, CASE WHEN o_custkey % 70 = 69 THEN 'LSIR' ELSE 'AB' || CAST(o_custkey % 70 AS VARCHAR) END AS abbr,
             lpad(CAST(o_custkey AS VARCHAR), 7, '0') AS code, CASE WHEN o_orderkey % 3 = 0 THEN lpad(CAST(o_custkey % 400 AS VARCHAR), 7, '0') END AS path_code FROM orders),
iv AS (SELECT abbr, d, min(title) AS t FROM (SELECT DISTINCT abbr, d FROM p) JOIN a USING (abbr) WHERE d BETWEEN s AND e GROUP BY 1, 2 HAVING count(*) = 1),
so AS (SELECT abbr, min(title) AS t FROM a GROUP BY 1 HAVING count(DISTINCT title) = 1),
ac AS (SELECT abbr, code, min(title) AS t FROM a GROUP BY 1, 2 HAVING count(DISTINCT title) = 1)
SELECT paper,
       CASE WHEN p.title <> '' THEN p.title WHEN path_code IS NOT NULL THEN coalesce(a.title, '') ELSE coalesce(iv.t, so.t, ac.t, CASE WHEN p.abbr = 'LSIR' THEN 'Leeds Intelligencer' ELSE p.abbr END) END AS title,
       CASE WHEN p.title <> '' THEN 'document' WHEN path_code IS NOT NULL THEN 'path_code' WHEN iv.t IS NOT NULL THEN 'interval'
            WHEN so.t IS NOT NULL THEN 'sole_title' WHEN ac.t IS NOT NULL THEN 'abbreviation_code' WHEN p.abbr = 'LSIR' THEN 'exception'
            ELSE 'abbreviation' END AS match_tier
FROM p LEFT JOIN ac ON ac.abbr = p.abbr AND ac.code = p.code LEFT JOIN a ON a.code = path_code LEFT JOIN iv ON iv.abbr = p.abbr AND iv.d = p.d LEFT JOIN so ON so.abbr = p.abbr""")
def news_title_cascade(spark, sf):
    from relnorm.plans import news
    o, s = table(spark, sf, "orders"), table(spark, sf, "supplier")
    first = F.to_date(F.lit("1800-01-01"))
    day = lambda n: F.date_add(first, n.cast("int"))
    authority = s.select(F.col("s_name").alias("title"), F.lpad(F.col("s_suppkey").cast("string"), 7, "0").alias("publication_code"),
                         F.concat(F.lit("AB"), (F.col("s_suppkey") % 60).cast("string")).alias("abbr"),
                         day(F.col("s_suppkey") % 300).alias("start_date"), day(F.col("s_suppkey") % 300 + 100).alias("end_date"))
    papers = o.select(
        F.col("o_orderkey").alias("paper"), F.when(F.col("o_orderkey") % 5 == 0, "Given").otherwise("").alias("title"),
        F.date_format(day(F.col("o_orderkey") % 400), "yyyy-MM-dd").alias("issue_date"),
        F.when(F.col("o_custkey") % 70 == 69, "LSIR").otherwise(
            F.concat(F.lit("AB"), (F.col("o_custkey") % 70).cast("string"))).alias("abbr"),
        F.lpad(F.col("o_custkey").cast("string"), 7, "0").alias("publication_code"),
        F.when(F.col("o_orderkey") % 3 == 0, F.concat(
            F.lit("x/"), F.lpad((F.col("o_custkey") % 400).cast("string"), 7, "0"), F.lit("/y"))).otherwise("x/y").alias("input_sub_path"))
    return news.match_titles(papers, authority).select("paper", "title", "match_tier")


# --------------------------------------------------------------------------
# Adjacent job
# --------------------------------------------------------------------------

def adjacent_inputs(spark, sf):
    """Directory rows from orders, gazetteer and newspapers from customers,
    dictionaries from customers × nations, links from orders."""
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer")
    n = table(spark, sf, "nation")
    mitchells = o.select(
        F.col("o_orderkey").alias("row_order"), F.col("o_orderkey").cast("string").alias("ID"),
        F.concat(F.lit("Paper "), F.col("o_orderkey").cast("string")).alias("TITLE"),
        F.concat(F.col("o_orderpriority"), F.lit("<SEP> "), F.col("o_orderstatus")).alias("POLITICS"),
        F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("A. "), F.col("o_custkey").cast("string"), F.lit("<SEP>B. Smith"))).alias("PERSONS"),
        F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("Org "), F.col("o_orderpriority"))).alias("ORGANIZATIONS"),
        F.concat((F.col("o_custkey") % 7).cast("string"), F.lit("d")).alias("PRICE"),
        F.year("o_orderdate").cast("string").alias("YEAR"),
        F.concat(F.lit("Q"), (F.col("o_custkey") % 200).cast("string")).alias("PLACE_PUB_WIKI"),
        F.date_format("o_orderdate", "yyyy").alias("ESTABLISHED_DATE"),
        F.when(F.col("o_orderkey") % 2 == 0, "Friday").alias("PUBLISED_DATE"))
    qid = F.concat(F.lit("Q"), F.col("c_custkey").cast("string"))
    gazetteer = c.select(qid.alias("wikidata_id"), F.col("c_name").alias("english_label"),
                         F.col("c_acctbal").alias("latitude"), F.col("c_nationkey").cast("double").alias("longitude"),
                         F.col("c_custkey").cast("string").alias("geonamesIDs"))
    cn = c.join(F.broadcast(n.select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey")), "c_nationkey")
    historic = cn.select(qid.alias("place_wikidata_id"), F.col("n_name").alias("label"),
                         F.concat(F.lit("Q9"), F.col("c_nationkey").cast("string")).alias("wikidata_id"))
    admin = cn.filter(F.col("c_mktsegment") != "MACHINERY").select(
        qid.alias("place_wikidata_id"), F.concat(F.lit("Region "), F.col("n_regionkey").cast("string")).alias("label"),
        F.concat(F.lit("Q8"), F.col("n_regionkey").cast("string")).alias("wikidata_id"))
    countries = cn.select(qid.alias("place_wikidata_id"), F.lit("England").alias("label"), F.lit("Q21").alias("wikidata_id"))
    linking = o.filter(F.col("o_orderstatus") != "P").select(
        F.lpad(F.col("o_custkey").cast("string"), 7, "0").alias("NLP"),
        F.col("o_orderkey").cast("string").alias("link_to_mpd"))
    newspapers = c.filter(F.col("c_mktsegment") != "AUTOMOBILE").select(
        (F.col("c_custkey") + 1000).alias("pk"), F.lpad(F.col("c_custkey").cast("string"), 7, "0").alias("publication_code"))
    # some papers are listed twice; the first of them counts
    newspapers = newspapers.union(newspapers.filter(F.col("pk") % 17 == 0).withColumn("pk", F.col("pk") + 10_000_000))
    return dict(mitchells=mitchells, gazetteer=gazetteer, historic=historic, admin=admin,
                countries=countries, linking=linking, newspapers=newspapers)


@query("adjacent_job_entries", covers=("JOB-2", "JON-4", "JON-5", "JON-6", "JON-9", "JON-11", "JON-13",
                                       "AGG-1", "AGG-2", "PRJ-16", "PRJ-17"), sql="""
WITH m AS (SELECT o_orderkey, o_custkey, o_orderstatus, 'Paper ' || CAST(o_orderkey AS VARCHAR) AS title,
                  [o_orderpriority, o_orderstatus] AS lean, [CAST(o_custkey % 7 AS VARCHAR) || 'd'] AS price,
                  year(o_orderdate) AS y, 'Q' || CAST(o_custkey % 200 AS VARCHAR) AS place_id FROM orders),
lean AS (SELECT l, row_number() OVER (ORDER BY l) AS pk FROM (SELECT DISTINCT unnest(lean) AS l FROM m)),
pr AS (SELECT p, row_number() OVER (ORDER BY p) AS pk FROM (SELECT DISTINCT unnest(price) AS p FROM m)),
yr AS (SELECT y, row_number() OVER (ORDER BY y) AS pk FROM (SELECT DISTINCT y FROM m WHERE y IS NOT NULL)),
gz AS (SELECT 'Q' || CAST(c_custkey AS VARCHAR) AS wid, row_number() OVER (ORDER BY 'Q' || CAST(c_custkey AS VARCHAR), c_name) AS pk
       FROM customer WHERE 'Q' || CAST(c_custkey AS VARCHAR) IN (SELECT place_id FROM m)),
np AS (SELECT lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS code, min(c_custkey + 1000) AS pk FROM customer
       WHERE c_mktsegment <> 'AUTOMOBILE' GROUP BY 1),
e AS (SELECT m.*, lpad(CAST(o_custkey AS VARCHAR), 7, '0') AS nlp,
             row_number() OVER (ORDER BY o_orderkey, lpad(CAST(o_custkey AS VARCHAR), 7, '0')) AS pk
      FROM m WHERE o_orderstatus <> 'P')
SELECT e.pk, e.title, CAST(e.y AS BIGINT) AS year, yr.pk AS issue, gz.pk AS place_of_publication, np.pk AS newspaper,
       CAST((SELECT pk FROM lean WHERE l = e.lean[1]) AS VARCHAR) || ',' || CAST((SELECT pk FROM lean WHERE l = e.lean[2]) AS VARCHAR) AS political_leanings,
       CAST((SELECT pk FROM pr WHERE p = e.price[1]) AS VARCHAR) AS prices
FROM e LEFT JOIN yr ON yr.y = e.y LEFT JOIN gz ON gz.wid = e.place_id LEFT JOIN np ON np.code = e.nlp""")
def adjacent_job_entries(spark, sf):
    from relnorm.plans import adjacent
    t = adjacent.build_tables(spark, run_ts="2024-01-01 00:00:00.000000+00:00", **adjacent_inputs(spark, sf))
    e = t["mitchells.Entry"]
    as_text = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",")
    return e.select("pk", "title", "year", "issue", "place_of_publication", "newspaper",
                    as_text("political_leanings").alias("political_leanings"), as_text("prices").alias("prices"))


_DIRECTORY = """
WITH m AS (SELECT o_orderkey AS k, o_custkey AS c, 'Paper ' || CAST(o_orderkey AS VARCHAR) AS title, [o_orderpriority, ' ' || o_orderstatus] AS lean_raw,
                  [o_orderpriority, o_orderstatus] AS lean, [CAST(o_custkey % 7 AS VARCHAR) || 'd'] AS price, year(o_orderdate) AS y,
                  'Q' || CAST(o_custkey % 200 AS VARCHAR) AS place_id, o_orderstatus <> 'P' AS linked, o_orderpriority FROM orders),
lean AS (SELECT l AS label, row_number() OVER (ORDER BY l) AS pk FROM (SELECT DISTINCT unnest(lean) AS l FROM m)),
pr AS (SELECT p AS label, row_number() OVER (ORDER BY p) AS pk FROM (SELECT DISTINCT unnest(price) AS p FROM m)),
yr AS (SELECT y AS year, row_number() OVER (ORDER BY y) AS pk FROM (SELECT DISTINCT y FROM m WHERE y IS NOT NULL)),
gz AS (SELECT c.*, 'Q' || CAST(c_custkey AS VARCHAR) AS wid, row_number() OVER (ORDER BY 'Q' || CAST(c_custkey AS VARCHAR), c_name) AS pk,
              n_name AS hl, 'Q9' || CAST(c_nationkey AS VARCHAR) AS hw,
              CASE WHEN c_mktsegment <> 'MACHINERY' THEN 'Region ' || CAST(n_regionkey AS VARCHAR) END AS al,
              CASE WHEN c_mktsegment <> 'MACHINERY' THEN 'Q8' || CAST(n_regionkey AS VARCHAR) END AS aw, 'England' AS cl, 'Q21' AS cw
       FROM customer AS c JOIN nation ON n_nationkey = c_nationkey WHERE 'Q' || CAST(c_custkey AS VARCHAR) IN (SELECT place_id FROM m)),
hc AS (SELECT hl AS label, hw AS wikidata_id, row_number() OVER (ORDER BY min(pk), hl, hw) AS pk FROM gz GROUP BY hl, hw),
ac AS (SELECT al AS label, aw AS wikidata_id, row_number() OVER (ORDER BY min(pk), al, aw) AS pk FROM gz WHERE al IS NOT NULL GROUP BY al, aw),
co AS (SELECT cl AS label, cw AS wikidata_id, row_number() OVER (ORDER BY min(pk), cl, cw) AS pk FROM gz GROUP BY cl, cw),
np AS (SELECT lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS code, c_custkey + 1000 AS pk FROM customer WHERE c_mktsegment <> 'AUTOMOBILE'),
e AS (SELECT m.*, lpad(CAST(c AS VARCHAR), 7, '0') AS nlp, row_number() OVER (ORDER BY k) AS pk FROM m WHERE linked)"""


def _adjacent_run(spark, sf):
    from relnorm.plans import adjacent
    out = _scratch(spark, "adjacent")
    return out, adjacent.run(spark, adjacent_inputs(spark, sf), out, RUN_TS, formats=("json", "csv"))


def _adjacent(spark, sf, name, fields, fmt="json"):
    out = f"{_once(spark, sf, _adjacent_run)[0]}/{name}.{fmt}"
    if fmt == "csv":
        return spark.read.option("header", "true").schema(f"pk bigint, {fields.replace(':', ' ')}").csv(out)
    return O.flatten_records(spark.read.schema(f"pk bigint, fields struct<{fields}>").json(out))


@query("adjacent_place", covers=("JOB-2", "JON-4", "JON-5"), sql=_DIRECTORY + """
SELECT gz.pk, wid AS wikidata_id, c_name AS label, c_acctbal AS latitude, CAST(c_nationkey AS DOUBLE) AS longitude,
       CAST(c_custkey AS VARCHAR) AS geonames_ids, hc.pk AS historic_county, ac.pk AS admin_county, co.pk AS country
FROM gz LEFT JOIN hc ON hc.label = hl AND hc.wikidata_id = hw LEFT JOIN ac ON ac.label = al AND ac.wikidata_id = aw
LEFT JOIN co ON co.label = cl AND co.wikidata_id = cw""")
def adjacent_place(spark, sf):
    return _adjacent(spark, sf, "gazetteer.Place", "wikidata_id:string,label:string,latitude:double,longitude:double,geonames_ids:string,"
                     "historic_county:bigint,admin_county:bigint,country:bigint")


def _dimension_query(name, table_name, source, column="label"):
    kinds = "label:string,wikidata_id:string" if source in ("hc", "ac", "co") else f"{column}:{'bigint' if column == 'year' else 'string'}"
    fields = ", ".join(f.split(":")[0] for f in kinds.split(","))

    @query(name, covers=("JOB-2", "JON-5" if source in ("hc", "ac", "co") else "AGG-1"), sql=f"{_DIRECTORY}\nSELECT pk, {fields} FROM {source}")
    def read(spark, sf):
        # each dimension from one format, so that both are read
        return _adjacent(spark, sf, table_name, kinds, "csv" if source in ("ac", "pr") else "json")
    return read


adjacent_historic_county = _dimension_query("adjacent_historic_county", "gazetteer.HistoricCounty", "hc")
adjacent_admin_county = _dimension_query("adjacent_admin_county", "gazetteer.AdminCounty", "ac")
adjacent_country = _dimension_query("adjacent_country", "gazetteer.Country", "co")
adjacent_political_leaning = _dimension_query("adjacent_political_leaning", "mitchells.PoliticalLeaning", "lean")
adjacent_price = _dimension_query("adjacent_price", "mitchells.Price", "pr")
adjacent_issue = _dimension_query("adjacent_issue", "mitchells.Issue", "yr", "year")


@query("adjacent_entry", covers=("JOB-2", "JON-6", "JON-9", "JON-10", "JON-11", "JON-13", "PRJ-16", "PRJ-17", "PRJ-25"), sql=_DIRECTORY + f"""
SELECT e.pk, title, array_to_string(lean_raw, '|') AS political_leaning_raw, array_to_string(price, '|') AS price_raw, CAST(y AS BIGINT) AS year,
       CAST(y AS VARCHAR) AS date_established_raw, CASE WHEN k % 2 = 0 THEN 'Friday' END AS day_of_publication_raw,
       '' AS place_of_circulation_raw, '' AS publication_district_raw, '' AS publication_county_raw,
       CASE WHEN k % 2 = 0 THEN 'Org ' || o_orderpriority ELSE '' END AS organisations,
       CASE WHEN k % 3 = 0 THEN 'A. ' || CAST(c AS VARCHAR) || '|B. Smith' ELSE '' END AS persons, np.pk AS newspaper,
       CAST((SELECT pk FROM lean WHERE label = e.lean[1]) AS VARCHAR) || '|' || CAST((SELECT pk FROM lean WHERE label = e.lean[2]) AS VARCHAR) AS political_leanings,
       CAST((SELECT pk FROM pr WHERE label = e.price[1]) AS VARCHAR) AS prices, yr.pk AS issue, gz.pk AS place_of_publication, '{RUN_TS}' AS created_at
FROM e LEFT JOIN np ON np.code = nlp LEFT JOIN yr ON yr.year = y LEFT JOIN gz ON gz.wid = place_id""")
def adjacent_entry(spark, sf):
    lists = {"political_leaning_raw": "string", "price_raw": "string", "organisations": "string", "persons": "string",
             "political_leanings": "bigint", "prices": "bigint"}
    fields = ",".join(["title:string", *[f"{n}:array<{t}>" for n, t in lists.items()], "year:bigint", "date_established_raw:string",
                       "day_of_publication_raw:string", "place_of_circulation_raw:string", "publication_district_raw:string",
                       "publication_county_raw:string", "newspaper:bigint", "issue:bigint", "place_of_publication:bigint", "created_at:string"])
    e = _adjacent(spark, sf, "mitchells.Entry", fields)
    return e.withColumns({n: F.array_join(F.col(n).cast("array<string>"), "|") for n in lists})


@query("adjacent_places_not_found", covers=("JOB-2", "AUD-2"), sql=_DIRECTORY + """
SELECT DISTINCT place_id AS place_of_publication_id FROM e WHERE place_id NOT IN (SELECT wid FROM gz)""")
def adjacent_places_not_found(spark, sf):
    return spark.read.schema("place_of_publication_id string").json(f"{_once(spark, sf, _adjacent_run)[0]}/places_not_found")


@query("adjacent_papers_not_found", covers=("JOB-2", "AUD-2"), sql=_DIRECTORY + """
SELECT DISTINCT nlp AS code FROM e WHERE nlp NOT IN (SELECT code FROM np)""")
def adjacent_papers_not_found(spark, sf):
    return spark.read.schema("code string").json(f"{_once(spark, sf, _adjacent_run)[0]}/papers_not_found")


@query("adjacent_papers_many", covers=("JOB-2", "AUD-3"), sql=_DIRECTORY + """
SELECT code AS publication_code, CAST(2 AS BIGINT) AS n_matches FROM np WHERE pk % 17 = 0""")
def adjacent_papers_many(spark, sf):
    return spark.read.schema("publication_code string, n_matches bigint").json(f"{_once(spark, sf, _adjacent_run)[0]}/papers_many")


@query("adjacent_checks", covers=("JOB-2", "JON-3", "AUD-1"), sql=_DIRECTORY + """
SELECT 'unresolved issue' AS "check", count(*) AS n_rows FROM e WHERE y NOT IN (SELECT year FROM yr)
UNION ALL SELECT 'unresolved place_of_publication', count(*) FROM e WHERE place_id NOT IN (SELECT wid FROM gz)""")
def adjacent_checks(spark, sf):
    return spark.read.schema("check string, n_rows bigint").json(f"{_once(spark, sf, _adjacent_run)[0]}/checks")


@query("adjacent_counts", covers=("JOB-2", "AGG-5"), sql=_DIRECTORY + """
SELECT 'gazetteer.Place' AS model, count(*) AS n_records FROM gz UNION ALL SELECT 'gazetteer.AdminCounty', count(*) FROM ac
UNION ALL SELECT 'gazetteer.HistoricCounty', count(*) FROM hc UNION ALL SELECT 'gazetteer.Country', count(*) FROM co
UNION ALL SELECT 'mitchells.PoliticalLeaning', count(*) FROM lean UNION ALL SELECT 'mitchells.Price', count(*) FROM pr
UNION ALL SELECT 'mitchells.Issue', count(*) FROM yr UNION ALL SELECT 'mitchells.Entry', count(*) FROM e
UNION ALL SELECT 'places_not_found', count(DISTINCT place_id) FROM e WHERE place_id NOT IN (SELECT wid FROM gz)
UNION ALL SELECT 'papers_not_found', count(DISTINCT nlp) FROM e WHERE nlp NOT IN (SELECT code FROM np)
UNION ALL SELECT 'papers_many', count(*) FROM np WHERE pk % 17 = 0""")
def adjacent_counts(spark, sf):
    return spark.createDataFrame(list(_once(spark, sf, _adjacent_run)[1].items()), "model string, n_records bigint")
