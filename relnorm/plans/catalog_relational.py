"""Catalog: keys, joins, de-duplication, aggregates, sets and audits, each run
over whole given tables, with an equivalent SQL text."""

from __future__ import annotations

from pyspark.sql import functions as F

from relnorm import operators as O
from relnorm.plans.registry import query, table

_LI_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
            "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


# --------------------------------------------------------------------------
# Keys and ordering
# --------------------------------------------------------------------------

@query("dense_key_lineitem", covers=("KEY-1", "KEY-2"), sql="""
SELECT row_number() OVER (ORDER BY l_orderkey NULLS FIRST, l_linenumber NULLS FIRST, l_partkey NULLS FIRST,
         l_suppkey NULLS FIRST, l_quantity NULLS FIRST, l_extendedprice NULLS FIRST, l_discount NULLS FIRST,
         l_tax NULLS FIRST, l_returnflag NULLS FIRST, l_linestatus NULLS FIRST, l_shipdate NULLS FIRST) AS pk,
       l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, l_quantity,
       strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate
FROM lineitem""")
def dense_key_lineitem(spark, sf):
    li = table(spark, sf, "lineitem")
    order = ["l_orderkey", "l_linenumber"]
    tie = [c for c in _LI_COLS if c not in order]
    k = O.dense_key(li, order, tiebreak=tie)
    return k.select("pk", "l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"),
                    "l_partkey", "l_suppkey", "l_quantity",
                    F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("l_shipdate"))


@query("key_offset_union", covers=("KEY-3", "SET-3"), sql="""
WITH u AS (SELECT 0 AS source_ordinal, doc_id AS item_id FROM documents
           UNION ALL SELECT 1, item_id FROM benchmark)
SELECT row_number() OVER (ORDER BY source_ordinal, item_id) + 4 AS pk, CAST(source_ordinal AS BIGINT) AS source_ordinal, item_id
FROM u""")
def key_offset_union(spark, sf):
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("item_id"))
    b = table(spark, sf, "benchmark").select("item_id")
    u = O.union_with_ordinal([d, b])
    k = O.dense_key(u, ["source_ordinal", "item_id"], start=5)
    return k.select("pk", F.col("source_ordinal").cast("bigint").alias("source_ordinal"), "item_id")


@query("chunk_numbers", covers=("KEY-4",), sql="""
WITH k AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS pk FROM customer)
SELECT c_custkey, pk, CAST(floor((pk - 1) / 100) + 1 AS BIGINT) AS chunk FROM k""")
def chunk_numbers(spark, sf):
    k = O.dense_key(table(spark, sf, "customer").select("c_custkey"), ["c_custkey"])
    return k.select("c_custkey", "pk", O.chunk_number("pk", 100).alias("chunk"))


@query("order_by_size", covers=("ORD-1",), sql="""
SELECT doc_id, row_number() OVER (ORDER BY n_chars, doc_id) AS pos_asc,
       row_number() OVER (ORDER BY n_chars DESC, doc_id) AS pos_desc FROM documents""")
def order_by_size(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "n_chars")
    a = O.dense_key(d, ["n_chars", "doc_id"], pk="pos_asc")
    b = O.dense_key(a, [-F.col("n_chars"), F.col("doc_id")], pk="pos_desc")
    return b.select("doc_id", "pos_asc", "pos_desc")


@query("order_by_path_components", covers=("ORD-2",), sql="""
SELECT page_id, row_number() OVER (ORDER BY string_split(url, '/'), page_id) AS pos FROM pages""")
def order_by_path_components(spark, sf):
    p = table(spark, sf, "pages").select("page_id", "url")
    return O.dense_key(p, [F.split("url", "/"), F.col("page_id")], pk="pos").select("page_id", "pos")


@query("numeric_sort_prefixed_ids", covers=("ORD-3",), sql="""
SELECT 'Q' || CAST(s_suppkey AS VARCHAR) AS wikidata_id,
       row_number() OVER (ORDER BY s_suppkey) AS pos FROM supplier""")
def numeric_sort_prefixed_ids(spark, sf):
    s = table(spark, sf, "supplier").select(F.concat(F.lit("Q"), F.col("s_suppkey").cast("string")).alias("wikidata_id"))
    num = F.substring("wikidata_id", 2, 1 << 20).try_cast("bigint")
    return O.dense_key(s, [num, F.col("wikidata_id")], pk="pos").select("wikidata_id", "pos")


@query("order_key_then_number", covers=("ORD-4",), sql="""
SELECT s_suppkey, row_number() OVER (ORDER BY s_nationkey, s_suppkey) AS pos FROM supplier""")
def order_key_then_number(spark, sf):
    s = table(spark, sf, "supplier")
    return O.dense_key(s, ["s_nationkey", "s_suppkey"], pk="pos").select("s_suppkey", "pos")


# --------------------------------------------------------------------------
# Joins
# --------------------------------------------------------------------------

_CUST_DIM = """c AS (SELECT c_custkey, max(pk) AS pk FROM
  (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey, c_name) AS pk FROM customer) GROUP BY c_custkey)"""


def _customer_dim(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_name")
    return O.dense_key(c, ["c_custkey", "c_name"])


@query("fk_orders_customer", covers=("JON-1", "JON-3"), sql=f"""
WITH {_CUST_DIM}
SELECT o_orderkey, c.pk AS customer_id FROM orders LEFT JOIN c ON o_custkey = c.c_custkey""")
def fk_orders_customer(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    r = O.resolve_fk(o, _customer_dim(spark, sf), {"o_custkey": "c_custkey"}, pk="pk",
                     as_name="customer_id", policy="null")
    return r.select("o_orderkey", "customer_id")


@query("fk_policy_counts", covers=("JON-3",), sql="""
WITH c AS (SELECT DISTINCT c_custkey FROM customer WHERE c_mktsegment <> 'AUTOMOBILE')
SELECT (c.c_custkey IS NOT NULL) AS resolved, count(*) AS n
FROM orders LEFT JOIN c ON o_custkey = c.c_custkey GROUP BY 1""")
def fk_policy_counts(spark, sf):
    c = table(spark, sf, "customer").filter(F.col("c_mktsegment") != "AUTOMOBILE")
    c = c.select("c_custkey", F.col("c_custkey").alias("pk"))
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    r = O.resolve_fk(o, c, {"o_custkey": "c_custkey"}, pk="pk", as_name="customer_id")
    return r.groupBy(F.col("customer_id").isNotNull().alias("resolved")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"))


@query("fk_composite_lineitem", covers=("JON-2",), sql="""
WITH d AS (SELECT l_partkey, l_suppkey, row_number() OVER (ORDER BY l_partkey, l_suppkey) AS pk
           FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem))
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, d.pk AS partsupp_id
FROM lineitem l LEFT JOIN d ON l.l_partkey = d.l_partkey AND l.l_suppkey = d.l_suppkey""")
def fk_composite_lineitem(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    dim = O.dense_key(li.select("l_partkey", "l_suppkey").distinct(), ["l_partkey", "l_suppkey"])
    r = O.resolve_fk(li, dim, ["l_partkey", "l_suppkey"], as_name="partsupp_id")
    return r.select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "partsupp_id")


@query("enrich_supplier_geo", covers=("JON-4",), sql="""
SELECT s_suppkey, n.n_name, r.r_name
FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""")
def enrich_supplier_geo(spark, sf):
    s = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    n = table(spark, sf, "nation").withColumnRenamed("n_nationkey", "s_nationkey")
    r = table(spark, sf, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    e = O.enrich(s, [(n, ["n_name", "n_regionkey"])], "s_nationkey")
    e = O.enrich(e, [(r, ["r_name"])], "n_regionkey")
    return e.select("s_suppkey", "n_name", "r_name")


@query("snowflake_customer_segment", covers=("JON-5", "DED-1"), sql="""
WITH d AS (SELECT c_mktsegment, row_number() OVER (ORDER BY c_mktsegment) AS segment_id
           FROM (SELECT DISTINCT c_mktsegment FROM customer WHERE c_mktsegment IS NOT NULL AND trim(c_mktsegment) <> ''))
SELECT c_custkey, d.segment_id FROM customer c LEFT JOIN d USING (c_mktsegment)""")
def snowflake_customer_segment(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    fact, _dim = O.snowflake_split(c, ["c_mktsegment"], pk="segment_pk", fk_name="segment_id")
    return fact.select("c_custkey", "segment_id")


@query("distinct_combinations", covers=("DED-1",), sql="""
SELECT DISTINCT c_mktsegment, CAST(c_nationkey AS BIGINT) AS c_nationkey FROM customer""")
def distinct_combinations(spark, sf):
    c = table(spark, sf, "customer")
    return O.distinct_rows(c.select("c_mktsegment", F.col("c_nationkey").cast("bigint").alias("c_nationkey")))


@query("inner_link_orders_customer", covers=("JON-6",), sql="""
SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey""")
def inner_link_orders_customer(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return o.join(c, "o_custkey", "inner").select("o_orderkey", "c_name")


def _windows(spark, sf):
    o = table(spark, sf, "orders").select("o_orderpriority", F.to_date("o_orderdate").alias("d"))
    yearly = o.groupBy("o_orderpriority", F.year("d").alias("y")).agg(
        F.min("d").alias("start_date"), F.max("d").alias("end_date"))
    yearly = yearly.select("o_orderpriority", "start_date", "end_date",
                           F.concat(F.lit("Y"), F.col("y").cast("string")).alias("window_code"))
    half = o.select("o_orderpriority").distinct().select(
        "o_orderpriority", F.lit("1995-01-01").cast("date").alias("start_date"),
        F.lit("1995-06-30").cast("date").alias("end_date"), F.lit("H1995").alias("window_code"))
    return yearly.unionByName(half)


_WINDOWS_SQL = """
w AS (SELECT o_orderpriority, min(CAST(o_orderdate AS DATE)) AS start_date, max(CAST(o_orderdate AS DATE)) AS end_date,
             'Y' || CAST(year(o_orderdate) AS VARCHAR) AS window_code FROM orders GROUP BY o_orderpriority, year(o_orderdate)
      UNION ALL SELECT DISTINCT o_orderpriority, DATE '1995-01-01', DATE '1995-06-30', 'H1995' FROM orders),
m AS (SELECT o.o_orderkey, min(w.window_code) AS window_code, count(*) AS n
      FROM orders o JOIN w ON o.o_orderpriority = w.o_orderpriority
       AND CAST(o.o_orderdate AS DATE) BETWEEN w.start_date AND w.end_date GROUP BY o.o_orderkey)"""


@query("interval_lookup_orders", covers=("JON-7",), sql=f"""
WITH {_WINDOWS_SQL}
SELECT o.o_orderkey, CASE WHEN m.n = 1 THEN m.window_code END AS window_code
FROM orders o LEFT JOIN m ON o.o_orderkey = m.o_orderkey""")
def interval_lookup_orders(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", F.to_date("o_orderdate").alias("d"))
    r = O.interval_lookup(o, _windows(spark, sf), "o_orderpriority", "d", "start_date", "end_date", "window_code")
    return r.select("o_orderkey", "window_code")


@query("cascade_match", covers=("JON-8", "AGG-3"), sql=f"""
WITH {_WINDOWS_SQL},
t1 AS (SELECT c_custkey, min(c_name) AS v FROM customer WHERE c_mktsegment = 'BUILDING'
       GROUP BY c_custkey HAVING count(DISTINCT c_name) = 1),
t3 AS (SELECT o_orderpriority, min(o_orderstatus) AS v FROM orders WHERE o_totalprice > 400000
       GROUP BY o_orderpriority HAVING count(DISTINCT o_orderstatus) = 1)
SELECT o.o_orderkey,
       coalesce(t1.v, CASE WHEN m.n = 1 THEN m.window_code END, t3.v, o.o_orderpriority) AS title,
       CASE WHEN t1.v IS NOT NULL THEN 'code' WHEN m.n = 1 AND m.window_code IS NOT NULL THEN 'interval'
            WHEN t3.v IS NOT NULL THEN 'sole_title' ELSE 'abbreviation' END AS match_tier
FROM orders o LEFT JOIN t1 ON o.o_custkey = t1.c_custkey
LEFT JOIN m ON o.o_orderkey = m.o_orderkey
LEFT JOIN t3 ON o.o_orderpriority = t3.o_orderpriority""")
def cascade_match(spark, sf):
    o = table(spark, sf, "orders")
    probe = o.select("o_orderkey", "o_custkey", "o_orderpriority", F.to_date("o_orderdate").alias("d"))
    c = table(spark, sf, "customer")
    t1 = O.unique_by(c.filter(F.col("c_mktsegment") == "BUILDING"), ["c_custkey"], "c_name")
    probe = O.interval_lookup(probe, _windows(spark, sf), "o_orderpriority", "d", "start_date",
                              "end_date", "window_code", prefix="iv_")
    t3 = O.unique_by(o.filter(F.col("o_totalprice") > 400000), ["o_orderpriority"], "o_orderstatus")
    abbr = probe.select(F.col("o_orderpriority").alias("k"), F.col("o_orderpriority").alias("v")).distinct()
    ivd = probe.select(F.col("o_orderkey").alias("k"), F.col("iv_window_code").alias("v")).filter(F.col("v").isNotNull())
    r = O.cascade(probe, [
        ("code", t1, {"o_custkey": "c_custkey"}, "c_name"),
        ("interval", ivd, {"o_orderkey": "k"}, "v"),
        ("sole_title", t3, ["o_orderpriority"], "o_orderstatus"),
        ("abbreviation", abbr, {"o_orderpriority": "k"}, "v"),
    ], out="title")
    return r.select("o_orderkey", "title", "match_tier")


@query("first_order_per_customer", covers=("JON-9", "DED-2"), sql="""
WITH f AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
SELECT c_custkey, f.o_orderkey AS first_order FROM customer LEFT JOIN f ON c_custkey = f.o_custkey AND f.rn = 1""")
def first_order_per_customer(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey")
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    r = O.lookup_first(c, o, {"c_custkey": "o_custkey"}, ["o_orderdate", "o_orderkey"], "o_orderkey")
    return r.select("c_custkey", F.col("o_orderkey").alias("first_order"))


@query("lookup_blank_when_missing", covers=("JON-10",), sql="""
SELECT d.doc_id, CAST(l.quality AS BIGINT) AS quality
FROM documents d LEFT JOIN (SELECT doc_id, min(quality) AS quality FROM labels GROUP BY doc_id) l ON d.doc_id = l.doc_id""")
def lookup_blank_when_missing(spark, sf):
    d = table(spark, sf, "documents").select("doc_id")
    lab = table(spark, sf, "labels").select("doc_id", "quality")
    r = O.lookup_first(d, lab, "doc_id", ["quality"], "quality")
    return r.select("doc_id", F.col("quality").cast("bigint").alias("quality"))


@query("array_fk_conversation_words", covers=("JON-11", "AGG-1"), sql="""
WITH t AS (SELECT conv_id, turn, string_split(coalesce(text, ''), ' ') AS ws FROM conversations),
v AS (SELECT w, row_number() OVER (ORDER BY w) AS pk FROM (SELECT DISTINCT unnest(ws) AS w FROM t)),
e AS (SELECT conv_id, turn, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos FROM t)
SELECT conv_id, turn, count(*) AS n_words,
       md5(string_agg(CAST(v.pk AS VARCHAR), ',' ORDER BY pos)) AS ids_md5
FROM e LEFT JOIN v USING (w) GROUP BY conv_id, turn""")
def array_fk_conversation_words(spark, sf):
    c = table(spark, sf, "conversations")
    c = c.select(F.struct("conv_id", "turn").alias("rid"),
                 F.split(F.coalesce("text", F.lit("")), " ").alias("words"))
    vocab = O.sorted_distinct_dim(c.select(F.explode("words").alias("w")), "w", pk="pk", label="w")
    r = O.resolve_array_fk(c, "words", vocab, label="w", pk="pk", as_name="word_ids")
    return r.select(F.col("rid.conv_id").alias("conv_id"), F.col("rid.turn").alias("turn"),
                    F.size("word_ids").cast("bigint").alias("n_words"),
                    F.md5(F.array_join(F.transform("word_ids", lambda x: x.cast("string")), ",")).alias("ids_md5"))


@query("scalar_fk_year", covers=("JON-13", "AGG-1"), sql="""
WITH y AS (SELECT y, row_number() OVER (ORDER BY y) AS pk FROM (SELECT DISTINCT year(o_orderdate) AS y FROM orders))
SELECT o_orderkey, y.pk AS year_id FROM orders JOIN y ON year(o_orderdate) = y.y""")
def scalar_fk_year(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("y"))
    years = O.sorted_distinct_dim(o, "y", pk="pk", label="year")
    r = O.resolve_fk(o, years, {"y": "year"}, as_name="year_id", policy="strict")
    return r.select("o_orderkey", "year_id")


@query("sorted_distinct_years", covers=("AGG-1",), sql="""
SELECT row_number() OVER (ORDER BY y) AS pk, CAST(y AS BIGINT) AS year
FROM (SELECT DISTINCT year(o_orderdate) AS y FROM orders)""")
def sorted_distinct_years(spark, sf):
    o = table(spark, sf, "orders").select(F.year("o_orderdate").cast("bigint").alias("year"))
    return O.sorted_distinct_dim(o, "year", pk="pk")


# --------------------------------------------------------------------------
# De-duplication
# --------------------------------------------------------------------------

@query("keep_first_event_per_user", covers=("DED-2",), sql="""
SELECT user_id, event_id, event_type, value FROM
  (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1""")
def keep_first_event_per_user(spark, sf):
    e = table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type", "value")
    return O.keep_first(e, ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type", "value")


@query("unique_by_composite_key", covers=("DED-3",), sql="""
SELECT coalesce(source, '') AS source, coalesce(lang, '') AS lang, min(doc_id) AS doc_id
FROM documents GROUP BY 1, 2""")
def unique_by_composite_key(spark, sf):
    d = table(spark, sf, "documents").select("source", "lang", "doc_id")
    return O.keep_first(d, ["source", "lang"], ["doc_id"], blank_keys_equal=True)


@query("keep_last_order_per_customer", covers=("DED-4",), sql="""
SELECT o_custkey, o_orderkey FROM
  (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
WHERE rn = 1""")
def keep_last_order_per_customer(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return O.keep_last(o, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey")


@query("exact_duplicate_removal", covers=("DED-5",), sql="""
SELECT md5(text) AS text_md5, lang FROM (SELECT DISTINCT text, lang FROM documents)""")
def exact_duplicate_removal(spark, sf):
    d = table(spark, sf, "documents").select("text", "lang")
    return O.drop_exact_duplicates(d).select(F.md5("text").alias("text_md5"), "lang")


# --------------------------------------------------------------------------
# Aggregates
# --------------------------------------------------------------------------

@query("distinct_words", covers=("AGG-2", "PRJ-17"), sql="""
SELECT DISTINCT regexp_replace(regexp_replace(w, '^\\s+', ''), '\\s+$', '') AS label
FROM (SELECT unnest(string_split(text, ' ')) AS w FROM documents)""")
def distinct_words(spark, sf):
    d = table(spark, sf, "documents").select(F.split("text", " ").alias("ws"))
    return O.distinct_elements(d, "ws", out="label")


@query("sole_lang_per_source", covers=("AGG-3",), sql="""
SELECT source, count(DISTINCT lang) AS n_distinct,
       CASE WHEN count(DISTINCT lang) = 1 THEN min(lang) END AS sole_lang
FROM documents GROUP BY source""")
def sole_lang_per_source(spark, sf):
    d = table(spark, sf, "documents")
    return O.sole_value(d, "source", "lang", out="sole_lang")


@query("source_report", covers=("AGG-4",), sql="""
SELECT source, count(*) AS n_entries, array_to_string(list_sort(list_distinct(list(lang))), ',') AS codes,
       count(DISTINCT doc_id) AS n_doc_id, max(n_chars) AS bytes, 'run-1' AS run_id
FROM documents GROUP BY source""")
def source_report(spark, sf):
    d = table(spark, sf, "documents")
    r = O.source_report(d, "source", "lang", keys=["doc_id"], size="n_chars", run_id="run-1")
    return r.withColumn("codes", F.array_join("codes", ","))


@query("record_counts", covers=("AGG-5",), sql="""
SELECT 'region' AS model, count(*) AS n_records FROM region
UNION ALL SELECT 'nation', count(*) FROM nation
UNION ALL SELECT 'supplier', count(*) FROM supplier
UNION ALL SELECT 'customer', count(*) FROM customer
UNION ALL SELECT 'orders', count(*) FROM orders""")
def record_counts(spark, sf):
    return O.record_counts({t: table(spark, sf, t) for t in ("region", "nation", "supplier", "customer", "orders")})


@query("collection_totals", covers=("AGG-7", "SET-1"), sql="""
WITH r(collection) AS (VALUES ('src0'), ('src1'), ('src5'), ('cat'), ('dog')),
a AS (SELECT source AS collection, count(*) AS n, sum(n_chars) AS b FROM documents GROUP BY source)
SELECT r.collection, coalesce(a.n, 0) AS n_archives, CAST(coalesce(a.b, 0) AS BIGINT) AS bytes,
       coalesce(a.n, 0) = 0 AS is_empty
FROM r LEFT JOIN a USING (collection)""")
def collection_totals(spark, sf):
    d = table(spark, sf, "documents").select(F.col("source").alias("collection"), F.col("n_chars").alias("length"))
    return O.collection_totals(spark, ["src0", "src1", "src5", "cat", "dog"], d)


# --------------------------------------------------------------------------
# Sets, membership and audits
# --------------------------------------------------------------------------

@query("membership_semi", covers=("FLT-2",), sql="""
SELECT p_partkey FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem)""")
def membership_semi(spark, sf):
    p = table(spark, sf, "part").select("p_partkey")
    li = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("p_partkey"))
    return p.join(li, "p_partkey", "left_semi")


@query("difference_nations", covers=("SET-1",), sql="""
SELECT DISTINCT CAST(c_nationkey AS BIGINT) AS c_nationkey FROM customer
WHERE c_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_nationkey IS NOT NULL)""")
def difference_nations(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_nationkey").cast("bigint").alias("c_nationkey"))
    s = table(spark, sf, "supplier").select(F.col("s_nationkey").cast("bigint").alias("s_nationkey"))
    return O.difference(c, s, "c_nationkey", "s_nationkey")


@query("union_names", covers=("SET-2",), sql="""
SELECT c_name AS name, 'customer' AS kind, NULL::DOUBLE AS s_acctbal FROM customer
UNION ALL SELECT s_name, 'supplier', s_acctbal FROM supplier""")
def union_names(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_name").alias("name"), F.lit("customer").alias("kind"))
    s = table(spark, sf, "supplier").select(F.col("s_name").alias("name"), F.lit("supplier").alias("kind"), "s_acctbal")
    return O.union_all(c, s)


@query("unmatched_labels", covers=("AUD-2",), sql="""
SELECT DISTINCT doc_id FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)""")
def unmatched_labels(spark, sf):
    lab = table(spark, sf, "labels")
    d = table(spark, sf, "documents")
    return O.unmatched_keys(lab, d, "doc_id")


@query("multi_match_orders", covers=("AUD-3",), sql="""
SELECT o_custkey, count(*) AS n_matches FROM orders GROUP BY o_custkey HAVING count(*) > 1""")
def multi_match_orders(spark, sf):
    return O.multi_match_keys(table(spark, sf, "orders"), "o_custkey")


@query("blank_key_rows", covers=("AUD-4",), sql="""
SELECT d.doc_id FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE l.quality IS NULL OR trim(CAST(l.quality AS VARCHAR)) = ''""")
def blank_key_rows(spark, sf):
    d = table(spark, sf, "documents").select("doc_id")
    lab = table(spark, sf, "labels").select("doc_id", "quality")
    return O.blank_key_rows(d.join(lab, "doc_id", "left"), ["quality"]).select("doc_id")
