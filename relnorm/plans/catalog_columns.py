"""Catalog: column functions, predicates and XML record extraction, each run
over whole given tables, with an equivalent SQL text."""

from __future__ import annotations

from pyspark.sql import functions as F

from relnorm import functions as RF
from relnorm.operators import extract as X
from relnorm.operators.aggregates import global_max
from relnorm.plans.registry import query, table
from relnorm.sources.providers import provider_records

# SQL fragments shared by several oracle texts (DuckDB dialect)
_STRIP = "regexp_replace(regexp_replace({x}, '^\\s+', ''), '\\s+$', '')"


def _strip_sql(x: str) -> str:
    return _STRIP.format(x=x)


def _clean_title_sql(x: str) -> str:
    a = f"regexp_replace({x}, '\\.+$', '')"
    b = _strip_sql(a)
    c = f"regexp_replace({b}, ':+$', '')"
    return f"coalesce({_strip_sql(c)}, '')"


def _zfill_sql(x: str) -> str:
    return f"(CASE WHEN length({x}) >= 7 THEN {x} ELSE lpad({x}, 7, '0') END)"


# --------------------------------------------------------------------------
# XML documents built from orders: every order is one article document
# --------------------------------------------------------------------------

def order_xml(spark, sf):
    """``(doc_key, xml, collection)``: every order as one article document."""
    o = table(spark, sf, "orders")
    key = F.col("o_orderkey")
    cust = F.col("o_custkey").cast("string")
    status = F.col("o_orderstatus")
    pid = (F.when(key % 4 == 0, F.lpad(cust, 7, "0")).when(key % 4 == 1, cust)
           .when(key % 4 == 2, F.lit("NCBL1001")).otherwise(F.lit("")))
    sub = F.concat(F.lit("news/"), F.lpad(cust, 7, "0"), F.lit("/"),
                   F.date_format("o_orderdate", "yyyy"))

    def tag(name, value):
        return F.concat(F.lit(f"<{name}>"), value, F.lit(f"</{name}>"))

    def opt(cond, name, value):
        return F.when(cond, tag(name, value)).otherwise(F.lit(""))

    process = F.concat(
        F.lit("<process>"), tag("input_sub_path", sub), tag("xml_flavour", F.lit("alto")),
        opt(status != "F", "software", F.concat(F.lit("abbyy/"), F.col("o_orderpriority"))),
        tag("mets_namespace", F.lit("http://www.loc.gov/METS/")),
        tag("alto_namespace", F.lit("http://www.loc.gov/standards/alto/")),
        F.lit("<lwm_tool>"), tag("name", F.lit("extract")), tag("version", status),
        tag("source", F.concat(F.lit("x"), F.col("o_orderpriority"))), F.lit("</lwm_tool>"),
        F.lit("</process>"))
    item = F.concat(
        F.lit('<item id="art'), key.cast("string"), F.lit('">'),
        tag("title", F.concat(F.lit("Article "), key.cast("string"), F.lit(":"))),
        tag("word_count", F.floor("o_totalprice").cast("bigint").cast("string")),
        tag("ocr_quality_mean", F.when(status == "O", F.lit("")).otherwise(
            F.concat(F.lit("0."), (key % 100).cast("string")))),
        opt(status != "F", "ocr_quality_sd", F.concat(F.lit("0.0"), (key % 10).cast("string"))),
        tag("plain_text_file", F.concat(F.lit("art"), key.cast("string"), F.lit(".txt"))),
        opt(status != "P", "item_type", F.lit("article")),
        F.lit("</item>"))
    pub = F.concat(
        F.lit('<publication id="'), pid, F.lit('">'),
        tag("title", F.concat(F.lit("The "), F.col("o_orderpriority"), F.lit(" Times. "))),
        opt(status != "P", "location", F.concat(F.lit("City"), (F.col("o_custkey") % 50).cast("string"))),
        F.lit("<issue>"), tag("date", F.date_format("o_orderdate", "yyyy-MM-dd")), item,
        F.lit("</issue></publication>"))
    xml = F.concat(F.lit("<lwm>"), process, pub, F.lit("</lwm>"))
    return o.select(key.alias("doc_key"), xml.alias("xml"),
                    F.concat(F.lit("col"), (F.col("o_custkey") % 3).cast("string")).alias("collection"))


def _order_documents(spark, sf):
    return X.with_codes(X.parse_documents(order_xml(spark, sf)))


_ORDER_CODE = "lpad(CAST(o_custkey AS VARCHAR), 7, '0')"
_ORDER_DATE = "strftime(o_orderdate, '%Y-%m-%d')"


@query("xml_newspaper_records", covers=("EXT-1", "EXT-2", "EXT-8", "PRJ-3"), sql=f"""
SELECT o_orderkey AS doc_key, {_ORDER_CODE} AS publication_code,
       {_clean_title_sql("'The ' || o_orderpriority || ' Times. '")} AS title,
       CASE WHEN o_orderstatus <> 'P' THEN 'City' || CAST(o_custkey % 50 AS VARCHAR) END AS location
FROM orders""")
def xml_newspaper_records(spark, sf):
    d = _order_documents(spark, sf)
    return X.newspaper_records(d, keep=["doc_key"])


@query("xml_issue_records", covers=("EXT-3", "PRJ-5"), sql=f"""
SELECT o_orderkey AS doc_key,
       {_ORDER_CODE} || '-' || strftime(o_orderdate, '%Y%m%d') AS issue_code,
       {_ORDER_DATE} AS issue_date, {_ORDER_CODE} AS publication_code,
       'news/' || {_ORDER_CODE} || '/' || strftime(o_orderdate, '%Y') AS input_sub_path
FROM orders""")
def xml_issue_records(spark, sf):
    d = _order_documents(spark, sf)
    return X.issue_records(d, keep=["doc_key"])


@query("xml_item_records", covers=("EXT-4", "PRJ-6", "PRJ-9", "PRJ-10", "PRJ-11"), sql=f"""
SELECT {_ORDER_CODE} || '-' || strftime(o_orderdate, '%Y%m%d') || '-art' || CAST(o_orderkey AS VARCHAR) AS item_code,
       CAST(floor(o_totalprice) AS BIGINT) AS word_count,
       'Article ' || CAST(o_orderkey AS VARCHAR) || ':' AS title,
       CASE WHEN o_orderstatus <> 'P' THEN 'ARTICLE' END AS item_type,
       'art' || CAST(o_orderkey AS VARCHAR) || '.txt' AS input_filename,
       CASE WHEN o_orderstatus = 'O' THEN 0.0 ELSE CAST('0.' || CAST(o_orderkey % 100 AS VARCHAR) AS DOUBLE) END AS ocr_quality_mean,
       CASE WHEN o_orderstatus = 'F' THEN 0.0 ELSE CAST('0.0' || CAST(o_orderkey % 10 AS VARCHAR) AS DOUBLE) END AS ocr_quality_sd,
       CASE WHEN o_orderstatus <> 'F' THEN 'abbyy/' || o_orderpriority END AS digitisation_software,
       'extract' AS ingest_name, o_orderstatus AS ingest_version,
       'col' || CAST(o_custkey % 3 AS VARCHAR) AS collection
FROM orders""")
def xml_item_records(spark, sf):
    d = _order_documents(spark, sf)
    return X.item_records(d).drop("issue_code")


@query("xml_ingest_records", covers=("EXT-5",), sql="""
SELECT 'extract' AS lwm_tool_name, o_orderstatus AS lwm_tool_version,
       'x' || o_orderpriority AS lwm_tool_source, count(*) AS n_documents
FROM orders GROUP BY ALL""")
def xml_ingest_records(spark, sf):
    d = X.ingest_records(_order_documents(spark, sf))
    return (d.select("lwm_tool_name", "lwm_tool_version",
                     F.try_element_at("lwm_tool", F.lit("lwm_tool_source")).alias("lwm_tool_source"))
            .groupBy("lwm_tool_name", "lwm_tool_version", "lwm_tool_source")
            .agg(F.count(F.lit(1)).cast("bigint").alias("n_documents")))


@query("xml_digitisation_records", covers=("EXT-6",), sql="""
SELECT DISTINCT 'alto' AS xml_flavour, 'abbyy/' || o_orderpriority AS software,
       'http://www.loc.gov/METS/' AS mets_namespace,
       'http://www.loc.gov/standards/alto/' AS alto_namespace
FROM orders WHERE o_orderstatus <> 'F'""")
def xml_digitisation_records(spark, sf):
    return X.digitisation_records(_order_documents(spark, sf)).distinct()


@query("xml_fanout_counts", covers=("EXT-8",), sql="""
SELECT 'newspaper' AS kind, count(DISTINCT o_custkey) AS n FROM orders
UNION ALL SELECT 'issue', count(DISTINCT (o_custkey, o_orderdate)) FROM orders
UNION ALL SELECT 'item', count(*) FROM orders
UNION ALL SELECT 'digitisation', count(DISTINCT o_orderpriority) FROM orders WHERE o_orderstatus <> 'F'
UNION ALL SELECT 'ingest', count(DISTINCT o_orderstatus) FROM orders
UNION ALL SELECT 'dataprovider', count(DISTINCT o_custkey % 3) FROM orders""")
def xml_fanout_counts(spark, sf):
    from relnorm.session import stage
    # every document is parsed once and gives all six kinds of records in that pass
    d = X.fan_out(_order_documents(spark, sf), F.coalesce("parse_error", "code_error"), keep=["collection"])
    r = stage(d, partition_by="kind")
    key = F.coalesce("newspaper.publication_code", "issue.issue_code", "item.item_code", "ingest.lwm_tool_version",
                     "digitisation.software", "dataprovider.collection")
    return r.groupBy("kind").agg(F.count_distinct(key).alias("n"))


# --------------------------------------------------------------------------
# Codes
# --------------------------------------------------------------------------

def _synthetic_ids(spark, sf):
    c = table(spark, sf, "customer")
    k = F.col("c_custkey")
    ks = k.cast("string")
    pid = (F.when(k % 9 == 0, F.lit("NCBL1001")).when(k % 9 == 1, F.lit("NCBL1023"))
           .when(k % 9 == 2, F.lit("")).when(k % 9 == 3, F.lpad(ks, 7, "0"))
           .when(k % 9 == 4, F.lit("NCBL9999")).when(k % 9 == 5, F.lit("ABCD"))
           .when(k % 9 == 6, ks).when(k % 9 == 7, F.concat(ks, F.lit("12345678")))
           .otherwise(F.lit(None).cast("string")))
    path = (F.when(k % 5 == 0, F.concat(F.lit("a/"), F.col("c_mktsegment"), F.lit("/b")))
            .when(k % 5 == 1, F.concat(F.lit("x/"), F.substring("c_name", 10, 9)))
            .when(k % 5 == 2, F.concat(F.lit("p/"), F.lpad(ks, 7, "0"), F.lit("/"), F.lpad(ks, 7, "1")))
            .otherwise(F.concat(F.lit("q/"), F.lpad(ks, 7, "0"), F.lit("/1850"))))
    return c.select(k.alias("c_custkey"), pid.alias("pub_id"), path.alias("sub_path"))


_SYN_SQL = """
WITH s AS (
  SELECT c_custkey,
    CASE c_custkey % 9 WHEN 0 THEN 'NCBL1001' WHEN 1 THEN 'NCBL1023' WHEN 2 THEN ''
      WHEN 3 THEN lpad(CAST(c_custkey AS VARCHAR), 7, '0') WHEN 4 THEN 'NCBL9999' WHEN 5 THEN 'ABCD'
      WHEN 6 THEN CAST(c_custkey AS VARCHAR) WHEN 7 THEN CAST(c_custkey AS VARCHAR) || '12345678'
      ELSE NULL END AS pub_id,
    CASE c_custkey % 5 WHEN 0 THEN 'a/' || c_mktsegment || '/b'
      WHEN 1 THEN 'x/' || substr(c_name, 10, 9)
      WHEN 2 THEN 'p/' || lpad(CAST(c_custkey AS VARCHAR), 7, '0') || '/' || lpad(CAST(c_custkey AS VARCHAR), 7, '1')
      ELSE 'q/' || lpad(CAST(c_custkey AS VARCHAR), 7, '0') || '/1850' END AS sub_path
  FROM customer),
r AS (SELECT *, CASE WHEN len(regexp_extract_all(sub_path, '\\d{7}')) = 1
                     THEN regexp_extract_all(sub_path, '\\d{7}')[1] END AS run FROM s),
v AS (SELECT *,
    CASE WHEN pub_id IS NULL OR pub_id = '' THEN run
         WHEN length(pub_id) = 7 THEN pub_id
         WHEN pub_id IN ('NCBL1001','NCBL1002') THEN coalesce(run, '0000499')
         WHEN pub_id = 'NCBL1023' THEN coalesce(run, '0000152')
         WHEN pub_id = 'NCBL1024' THEN coalesce(run, '0000171')
         WHEN pub_id = 'NCBL1029' THEN coalesce(run, '0000165')
         WHEN pub_id = 'NCBL1034' THEN coalesce(run, '0000160')
         WHEN pub_id = 'NCBL1035' THEN coalesce(run, '0000185')
         WHEN length(pub_id) = 4 OR contains(pub_id, 'NCBL') THEN run
         ELSE (CASE WHEN length(pub_id) >= 7 THEN pub_id ELSE lpad(pub_id, 7, '0') END) END AS raw
  FROM r),
e AS (SELECT *,
    CASE WHEN (pub_id IS NULL OR pub_id = '') AND run IS NULL THEN 'no publication code in id or path'
         WHEN raw IS NULL THEN 'publication code look-up failed'
         WHEN length(raw) <> 7 THEN 'publication code of wrong length: ' || raw END AS error
  FROM v)
"""


@query("publication_code_cascade", covers=("PRJ-1", "PRJ-2", "PRJ-4"), sql=_SYN_SQL + """
SELECT c_custkey, CASE WHEN error IS NULL THEN raw END AS code, error FROM e""")
def publication_code_cascade(spark, sf):
    s = _synthetic_ids(spark, sf)
    pc = RF.publication_code(F.col("pub_id"), F.col("sub_path"))
    return s.select("c_custkey", pc["code"].alias("code"), pc["error"].alias("error"))


@query("rejected_codes", covers=("AUD-1",), sql=_SYN_SQL + """
SELECT error, count(*) AS n_rejected FROM e WHERE error IS NOT NULL GROUP BY error""")
def rejected_codes(spark, sf):
    from relnorm.operators.audit import split_by_error
    s = _synthetic_ids(spark, sf)
    pc = RF.publication_code(F.col("pub_id"), F.col("sub_path"))
    _, bad = split_by_error(s.withColumn("error", pc["error"]), "error")
    return bad.groupBy("error").agg(F.count(F.lit(1)).cast("bigint").alias("n_rejected"))


@query("sole_digit_run", covers=("PRJ-2",), sql="""
SELECT doc_id, CASE WHEN len(regexp_extract_all(text, '\\d+')) = 1
                    THEN regexp_extract_all(text, '\\d+')[1] END AS sole_number
FROM documents""")
def sole_digit_run(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", RF.sole_match("text", r"\d+").alias("sole_number"))


@query("zero_fill_codes", covers=("PRJ-4",), sql=f"""
SELECT c_custkey, {_zfill_sql("CAST(c_custkey * 9973 AS VARCHAR)")} AS code FROM customer""")
def zero_fill_codes(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey", RF.zero_fill((F.col("c_custkey") * 9973).cast("string")).alias("code"))


@query("issue_codes", covers=("PRJ-5",), sql=f"""
SELECT o_orderkey, {_zfill_sql("CAST(o_custkey AS VARCHAR)")} || '-' || strftime(o_orderdate, '%Y%m%d') AS issue_code
FROM orders""")
def issue_codes(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", RF.issue_code(RF.zero_fill(F.col("o_custkey").cast("string")),
                                                F.date_format("o_orderdate", "yyyy-MM-dd")).alias("issue_code"))


@query("item_codes", covers=("PRJ-6",), sql=f"""
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
       {_zfill_sql("CAST(l_orderkey AS VARCHAR)")} || '-' || strftime(l_shipdate, '%Y%m%d')
         || '-art' || lpad(CAST(l_linenumber AS VARCHAR), 4, '0') AS item_code
FROM lineitem""")
def item_codes(spark, sf):
    li = table(spark, sf, "lineitem")
    issue = RF.issue_code(RF.zero_fill(F.col("l_orderkey").cast("string")),
                          F.date_format("l_shipdate", "yyyy-MM-dd"))
    art = F.concat(F.lit("art"), F.lpad(F.col("l_linenumber").cast("string"), 4, "0"))
    return li.select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"),
                     RF.item_code(issue, art).alias("item_code"))


@query("shard_keys", covers=("PRJ-7",), sql=f"""
WITH c AS (SELECT c_custkey, substr(regexp_replace({_zfill_sql("CAST(c_custkey AS VARCHAR)")}, '^0+', ''), 1, 2) AS h FROM customer)
SELECT c_custkey, CASE WHEN length(h) = 1 THEN '0' || h ELSE h END AS shard FROM c""")
def shard_keys(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey", RF.shard_key(RF.zero_fill(F.col("c_custkey").cast("string"))).alias("shard"))


@query("key_escaping", covers=("PRJ-8",), sql="""
SELECT page_id, replace(url, '/', '---') AS escaped,
       replace(replace(url, '/', '---'), '---', '/') = url AS round_trips
FROM pages""")
def key_escaping(spark, sf):
    p = table(spark, sf, "pages")
    e = RF.escape_key("url")
    return p.select("page_id", e.alias("escaped"), (RF.unescape_key(e) == F.col("url")).alias("round_trips"))


@query("title_cap", covers=("PRJ-9",), sql="""
SELECT doc_id, substr(text, 1, 200) AS capped, length(text) > 200 AS is_cut, substr(text, 1, 2097151) = text AS fits_default
FROM documents""")
def title_cap(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", RF.cap_title("text", 200).alias("capped"), (F.length("text") > 200).alias("is_cut"),
                    (RF.cap_title("text") == F.col("text")).alias("fits_default"))


@query("missing_field_defaults", covers=("PRJ-10", "JON-12"), sql="""
SELECT d.doc_id, coalesce(CAST(l.quality AS BIGINT), 0) AS quality,
       coalesce(CAST(l.toxic AS BIGINT), -1) AS toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def missing_field_defaults(spark, sf):
    d = table(spark, sf, "documents").select("doc_id")
    lab = table(spark, sf, "labels")
    from relnorm.operators.resolve import lookup_first
    j = lookup_first(d, lab, "doc_id", ["quality", "toxic"], ["quality", "toxic"], prefix="l_")
    return j.select("doc_id", F.coalesce(F.col("l_quality").cast("bigint"), F.lit(0)).alias("quality"),
                    F.coalesce(F.col("l_toxic").cast("bigint"), F.lit(-1)).alias("toxic"))


@query("blank_numeric_and_upper", covers=("PRJ-11",), sql="""
SELECT doc_id, upper(lang) AS item_type,
       CASE WHEN n_chars % 3 = 0 THEN 0.0 ELSE CAST(n_chars AS DOUBLE) END AS ocr_quality_mean
FROM documents""")
def blank_numeric_and_upper(spark, sf):
    d = table(spark, sf, "documents")
    raw = F.when(F.col("n_chars") % 3 == 0, F.lit(" ")).otherwise(F.col("n_chars").cast("string"))
    return d.select("doc_id", RF.upper_or_null("lang").alias("item_type"),
                    RF.blank_to_zero(raw).alias("ocr_quality_mean"))


@query("relational_rename", covers=("PRJ-12",), sql="""
SELECT o_orderkey AS pk, o_custkey AS customer, o_orderstatus AS status FROM orders""")
def relational_rename(spark, sf):
    from relnorm.operators.records import rename_relational
    o = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("pk"), F.col("o_custkey").alias("customer__custkey"),
        F.col("o_orderstatus").alias("order__status"))
    return rename_relational(o, {"customer__custkey": "customer"}, suffix=True)


@query("slugs", covers=("PRJ-13",), sql="""
WITH t AS (SELECT p_partkey, p_brand || ' ' || translate(p_name, 'aceiou', 'áçèÏøÜ') || ' Straße, Œuvre Łódź 1,000!' AS x FROM part)
SELECT p_partkey, regexp_replace(regexp_replace(replace(lower(
         replace(replace(replace(replace(replace(strip_accents(x), 'ø', 'o'), 'ß', 'ss'), 'Œ', 'OE'), 'Ł', 'L'), 'ł', 'l')),
         '1,000', '1000'), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug
FROM t""")
def slugs(spark, sf):
    p = table(spark, sf, "part")
    name = F.concat_ws(" ", "p_brand", F.translate("p_name", "aceiou", "áçèÏøÜ"), F.lit("Straße, Œuvre Łódź 1,000!"))
    return p.select("p_partkey", RF.slug(name).alias("slug"))


@query("article_inversion", covers=("PRJ-14",), sql=f"""
WITH t AS (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_name || ', The ' WHEN p_partkey % 3 = 1 THEN ' ' || p_name || ', THE' ELSE p_name END AS title FROM part)
SELECT p_partkey, regexp_replace({_strip_sql("title")}, '(?is)^(.*), the$', 'The \\1') AS title FROM t""")
def article_inversion(spark, sf):
    p = table(spark, sf, "part")
    k = F.col("p_partkey")
    t = (F.when(k % 3 == 0, F.concat("p_name", F.lit(", The ")))
         .when(k % 3 == 1, F.concat(F.lit(" "), "p_name", F.lit(", THE"))).otherwise(F.col("p_name")))
    return p.select("p_partkey", RF.invert_article(t).alias("title"))


@query("date_assembly", covers=("PRJ-15",), sql="""
WITH p AS (
  SELECT o_orderkey, day(o_orderdate) + CASE WHEN o_orderkey % 11 = 0 THEN 3 ELSE 0 END AS d,
         month(o_orderdate) AS m, year(o_orderdate) AS y FROM orders)
SELECT o_orderkey,
       strftime(TRY_CAST(lpad(CAST(y AS VARCHAR), 4, '0') || '-' || lpad(CAST(m AS VARCHAR), 2, '0') || '-' || lpad(CAST(d AS VARCHAR), 2, '0') AS DATE), '%Y-%m-%d') AS issue_date
FROM p""")
def date_assembly(spark, sf):
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey")
    m = F.month("o_orderdate")
    # month names as written in authority files, with aliases and stray dots
    name = (F.when((m == 6) & (k % 2 == 0), F.lit("June"))
            .when((m == 7) & (k % 2 == 0), F.lit(" July"))
            .when((m == 9) & (k % 2 == 0), F.lit("Sept."))
            .when((m == 12) & (k % 2 == 0), F.lit("Dec."))
            .otherwise(F.date_format("o_orderdate", "MMM")))
    day = (F.dayofmonth("o_orderdate") + F.when(k % 11 == 0, 3).otherwise(0)).cast("string")
    dt = RF.assemble_date(day, name, F.year("o_orderdate").cast("string"))
    return o.select("o_orderkey", F.date_format(dt, "yyyy-MM-dd").alias("issue_date"))


@query("split_and_trim_lists", covers=("PRJ-16", "PRJ-17"), sql="""
WITH t AS (SELECT conv_id, turn,
             CASE WHEN text = '' THEN NULL ELSE replace(text, chr(10), '<SEP>') END AS raw FROM conversations),
l AS (SELECT conv_id, turn, CASE WHEN raw IS NULL THEN []::VARCHAR[] ELSE string_split(raw, '<SEP>') END AS xs FROM t)
SELECT conv_id, turn, CAST(len(xs) AS BIGINT) AS n_items,
       md5(array_to_string(list_transform(xs, lambda x: regexp_replace(regexp_replace(x, '^\\s+', ''), '\\s+$', '')), '|')) AS items_md5
FROM l""")
def split_and_trim_lists(spark, sf):
    c = table(spark, sf, "conversations")
    raw = F.when(F.col("text") == "", F.lit(None)).otherwise(F.regexp_replace("text", "\n", "<SEP>"))
    xs = RF.trim_elements(RF.split_list(raw))
    return c.select("conv_id", "turn", F.size(xs).cast("bigint").alias("n_items"),
                    F.md5(F.array_join(xs, "|")).alias("items_md5"))


@query("pair_orientation", covers=("PRJ-18",), sql="""
SELECT c_custkey, c_name AS label, 'Q' || CAST(c_custkey AS VARCHAR) AS wikidata_id FROM customer""")
def pair_orientation(spark, sf):
    c = table(spark, sf, "customer")
    q = F.concat(F.lit("Q"), F.col("c_custkey").cast("string"))
    pair = F.when(F.col("c_custkey") % 2 == 0, F.array("c_name", q)).otherwise(F.array(q, "c_name"))
    o = RF.orient_pair(pair)
    return c.select("c_custkey", o["label"].alias("label"), o["wikidata_id"].alias("wikidata_id"))


@query("human_sizes", covers=("PRJ-22",), sql="""
WITH b AS (SELECT o_orderkey, CAST(floor(o_totalprice * 10000) AS BIGINT) AS n FROM orders),
t AS (SELECT o_orderkey, n, (n + 50000) // 100000 AS mb10, (n + 50000000) // 100000000 AS gb10 FROM b)
SELECT o_orderkey, CASE WHEN gb10 < 5 THEN CAST(mb10 // 10 AS VARCHAR) || '.' || CAST(mb10 % 10 AS VARCHAR) || 'MB'
                        ELSE CAST(gb10 // 10 AS VARCHAR) || '.' || CAST(gb10 % 10 AS VARCHAR) || 'GB' END AS size
FROM t""")
def human_sizes(spark, sf):
    o = table(spark, sf, "orders")
    n = F.floor(F.col("o_totalprice") * 10000).cast("bigint")
    return o.select("o_orderkey", RF.human_size(n).alias("size"))


@query("label_renumbering", covers=("PRJ-23", "AGG-6"), sql="""
WITH m AS (SELECT s_suppkey, s_name, regexp_extract_all(s_name, '\\b\\d+\\b')[-1] AS num FROM supplier),
w AS (SELECT length(CAST(max(CAST(num AS BIGINT)) AS VARCHAR)) + 1 AS width FROM m)
SELECT s_suppkey,
       substr(s_name, 1, instr(s_name, num) - 1) || lpad(CAST(CAST(num AS BIGINT) AS VARCHAR), CAST(width AS INTEGER), '0')
         || substr(s_name, instr(s_name, num) + length(num)) AS label
FROM m, w""")
def label_renumbering(spark, sf):
    s = table(spark, sf, "supplier")
    num = F.try_element_at(F.regexp_extract_all("s_name", F.lit(r"\b\d+\b"), 0), F.lit(-1))
    mx = global_max(s.select(num.cast("bigint").alias("n")), "n", "max_n")
    # one-row aggregate: a proven bound, broadcast
    j = s.crossJoin(F.broadcast(mx))
    return j.select("s_suppkey", RF.renumber_label("s_name", F.col("max_n")).alias("label"))


@query("text_decode", covers=("PRJ-24",), sql="""
SELECT doc_id,
       CASE WHEN doc_id % 7 = 0 THEN md5('') ELSE md5(regexp_replace(text || chr(13) || chr(10) || 'end' || chr(13), '\\r\\n?', chr(10), 'g')) END AS text_md5,
       CASE WHEN doc_id % 7 = 0 THEN 'invalid UTF-8 byte sequence' END AS errors
FROM documents""")
def text_decode(spark, sf):
    d = table(spark, sf, "documents")
    raw = F.concat(F.encode(F.concat("text", F.lit("\r\nend\r")), "UTF-8"),
                   F.when(F.col("doc_id") % 7 == 0, F.unhex(F.lit("FF"))).otherwise(F.unhex(F.lit(""))))
    t = RF.decode_text(raw)
    return d.select("doc_id", F.md5(t["text"]).alias("text_md5"), t["error"].alias("errors"))


@query("blank_fk_normalise", covers=("PRJ-26",), sql="""
SELECT doc_id, CASE WHEN quality = 0 THEN NULL ELSE CAST(quality AS BIGINT) END AS quality_fk,
       CASE WHEN toxic = 0 THEN NULL ELSE CAST(toxic AS BIGINT) END AS toxic_fk
FROM labels""")
def blank_fk_normalise(spark, sf):
    lab = table(spark, sf, "labels")
    q = F.when(F.col("quality") == 0, F.lit("  ")).otherwise(F.col("quality").cast("string"))
    return lab.select("doc_id", RF.blank_fk(q).alias("quality_fk"), RF.blank_fk("toxic").alias("toxic_fk"))


@query("name_parts", covers=("PRJ-27",), sql="""
SELECT s_suppkey, split_part(s_name, '#', 1) AS abbr,
       replace(s_name || '_metadata', '_metadata', '') AS report_name
FROM supplier""")
def name_parts(spark, sf):
    s = table(spark, sf, "supplier")
    return s.select("s_suppkey", RF.name_prefix("s_name", "#").alias("abbr"),
                    RF.strip_suffix(F.concat("s_name", F.lit("_metadata")), "_metadata").alias("report_name"))


@query("audit_stamp_and_constants", covers=("PRJ-21", "PRJ-25"), sql="""
SELECT s_suppkey, '2024-01-01 00:00:00.000000+00:00' AS created_at,
       '2024-01-01 00:00:00.000000+00:00' AS updated_at, '' AS place_of_circulation_raw
FROM supplier""")
def audit_stamp_and_constants(spark, sf):
    from relnorm.operators.records import stamp
    s = table(spark, sf, "supplier").select("s_suppkey")
    return stamp(s, "2024-01-01 00:00:00.000000+00:00").withColumn("place_of_circulation_raw", F.lit(""))


@query("data_provider_records", covers=("EXT-7", "SRC-11"), sql="""
WITH p(legacy_code, name, code, source_note, configured_pk) AS (VALUES
  ('bna', 'FindMyPast', 'fmp', 'FindMyPast-funded digitised newspapers provided by the British Newspaper Archive', 1),
  ('hmd', 'Heritage Made Digital', 'bl_hmd', 'British Library-funded digitised newspapers provided by the British Newspaper Archive', 2),
  ('jisc', 'Joint Information Systems Committee', 'jisc', 'JISC-funded digitised newspapers provided by the British Newspaper Archive', 3),
  ('lwm', 'Living with Machines', 'bl_lwm', 'Living with Machines-funded digitised newspapers provided by the British Newspaper Archive', 4)),
c AS (SELECT DISTINCT CASE WHEN source IN ('src1', 'src2') THEN 'hmd' WHEN source = 'src3' THEN 'lwm' ELSE 'Col ' || upper(source) END AS coll FROM documents)
SELECT coll AS collection_name, coalesce(p.name, coll) AS name,
       coalesce(p.code, regexp_replace(regexp_replace(lower(coll), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')) AS code,
       CASE WHEN p.name IS NOT NULL THEN coll END AS legacy_code,
       coalesce(p.source_note, '') AS source_note, 'newspapers' AS collection,
       CAST(p.configured_pk AS BIGINT) AS configured_pk
FROM c LEFT JOIN p ON c.coll = p.legacy_code""")
def data_provider_records(spark, sf):
    d = table(spark, sf, "documents")
    coll = (F.when(F.col("source").isin("src1", "src2"), F.lit("hmd"))
            .when(F.col("source") == "src3", F.lit("lwm"))
            .otherwise(F.concat(F.lit("Col "), F.upper("source"))))
    return provider_records(spark, d.select(coll.alias("collection")))


# --------------------------------------------------------------------------
# Predicates
# --------------------------------------------------------------------------

@query("any_field_equals", covers=("FLT-1",), sql="""
SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT' OR o_orderstatus = '1-URGENT'
UNION ALL SELECT -o_orderkey FROM orders WHERE o_orderstatus IS NULL OR o_orderpriority IS NULL""")
def any_field_equals(spark, sf):
    o = table(spark, sf, "orders")
    a = o.filter(RF.any_field_equals(["o_orderpriority", "o_orderstatus"], "1-URGENT")).select("o_orderkey")
    b = o.filter(RF.any_field_equals(["o_orderstatus", "o_orderpriority"], None)).select((-F.col("o_orderkey")).alias("o_orderkey"))
    return a.unionByName(b)


@query("drop_blank_rows", covers=("FLT-3", "AUD-4"), sql="""
SELECT d.doc_id, coalesce(trim(CAST(l.quality AS VARCHAR)) <> '', false) AS has_label
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE d.lang IS NOT NULL AND trim(d.lang) <> '' AND d.source IS NOT NULL AND trim(d.source) <> ''""")
def drop_blank_rows(spark, sf):
    d = table(spark, sf, "documents")
    lab = table(spark, sf, "labels").select("doc_id", "quality")
    j = d.filter(RF.not_blank("lang", "source")).join(lab, "doc_id", "left")
    return j.select("doc_id", RF.not_blank("quality").alias("has_label"))


@query("record_kind_by_path", covers=("FLT-4",), sql="""
WITH p AS (SELECT page_id, string_split(regexp_replace(url, '/[^/]*$', ''), '/') AS parts FROM pages)
SELECT page_id, CASE WHEN list_contains(parts, 'fr') THEN 'fr' WHEN list_contains(parts, 'de') THEN 'de'
                     WHEN list_contains(parts, 'es') THEN 'es' ELSE 'other' END AS kind
FROM p""")
def record_kind_by_path(spark, sf):
    p = table(spark, sf, "pages")
    return p.select("page_id", RF.path_kind("url", ("fr", "de", "es"), "other").alias("kind"))


@query("size_threshold", covers=("FLT-5",), sql="SELECT doc_id FROM documents WHERE n_chars <= 5000")
def size_threshold(spark, sf):
    d = table(spark, sf, "documents")
    return d.filter(RF.within_size("n_chars", 5000)).select("doc_id")


@query("drop_empty_documents", covers=("FLT-6",), sql="""
SELECT doc_id FROM documents WHERE length(text) > 0""")
def drop_empty_documents(spark, sf):
    d = table(spark, sf, "documents")
    return d.filter(F.length("text") > 0).select("doc_id")


@query("path_selection", covers=("SRC-10",), sql="""
WITH u AS (SELECT page_id, url, regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS host FROM pages)
SELECT page_id FROM u
WHERE (ends_with(url, '#top') OR ends_with(url, '&ref=x'))
  AND NOT regexp_matches(url, '(^|/)\\.[^/]')
  AND split_part(host, '.', 1) NOT IN ('www', 'm')""")
def path_selection(spark, sf):
    p = table(spark, sf, "pages")
    host = F.regexp_extract("url", r"^[a-z]+://([^/]+)", 1)
    sub = F.split_part(host, F.lit("."), F.lit(1))
    cond = RF.has_extension("url", ["#top", "&ref=x"]) & ~RF.is_hidden("url") & RF.name_in(sub, exclude=["www", "m"])
    return p.filter(cond).select("page_id")
