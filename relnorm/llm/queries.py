"""Queries opN_* over the documents tables, with their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relnorm.llm.centroids import centroid_clusters
from relnorm.llm.decontamination import contamination
from relnorm.llm.exact_dedup import exact_dedup
from relnorm.llm.kneser_ney import lm_scores
from relnorm.llm.language import identify_languages
from relnorm.llm.licenses import TEMPLATES, license_scan
from relnorm.llm.ngram_jaccard import near_duplicates
from relnorm.llm.packing import pack
from relnorm.llm.quality import quality_scores
from relnorm.llm.simhash import simhash_groups
from relnorm.llm.spelling import spelling_variants
from relnorm.llm.suffix_dedup import remove_repeats
from relnorm.llm.toxicity import toxicity_scores

TOKENIZER = "word_bpe_49k.json"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Where the public vocabulary file lies, the same on every worker."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_suffix_array_dedup(spark, sf_dir):
    rows = remove_repeats(read(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return rows.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                       F.sha2("kept", 256).alias("kept_sha256"))


def op2_toxicity(spark, sf_dir):
    return toxicity_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op3_lm_scoring(spark, sf_dir):
    return lm_scores(read(spark, sf_dir, "documents"))


def op4_quality(spark, sf_dir):
    return quality_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op5_license_scan(spark, sf_dir):
    return license_scan(read(spark, sf_dir, "documents"))


def op6_benchmark_decontamination(spark, sf_dir):
    rows = contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return rows.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op7_exact_dedup(spark, sf_dir):
    return exact_dedup(read(spark, sf_dir, "documents"))


def op8_language_id(spark, sf_dir):
    return identify_languages(read(spark, sf_dir, "documents"))


def op9_ngram_jaccard(spark, sf_dir):
    return near_duplicates(read(spark, sf_dir, "documents"))


def op10_packing(spark, sf_dir):
    pieces = pack(read(spark, sf_dir, "documents"), tokenizer_path())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset")


def op11_spelling_variants(spark, sf_dir):
    return spelling_variants(read(spark, sf_dir, "documents")).select("word", "form", "root", "n", "n_near", "form_n")


def op12_centroid_clustering(spark, sf_dir):
    rows = centroid_clusters(read(spark, sf_dir, "embeddings"))
    return rows.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                       F.sha2(F.array_join("centroid", ","), 256).alias("centroid_sha256"))


def op13_simhash_dedup(spark, sf_dir):
    return simhash_groups(read(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_suffix_array_dedup, op2_toxicity, op3_lm_scoring, op4_quality, op5_license_scan, op6_benchmark_decontamination, op7_exact_dedup, op8_language_id,
    op9_ngram_jaccard, op10_packing, op11_spelling_variants, op12_centroid_clustering, op13_simhash_dedup)}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _license_sql() -> str:
    quoted = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
    rows = []
    for t in TEMPLATES:
        text, phrase = t.text.split(), t.phrase.split()
        at = next(k for k in range(len(text)) if text[k:k + len(phrase)] == phrase)
        rows.append(f"('{t.label}', {quoted(text)}, {quoted(phrase)}, {at}, {str(t.base).lower()})")
    return f"""
WITH t(label, tw, ph, o, base) AS (VALUES {', '.join(rows)}),
d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
u AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM d),
p AS (SELECT r, i - 1 AS start, label, base,
             len(list_filter(range(1, len(tw) + 1), lambda j: i - o + j - 1 > 0 AND w[i - o + j - 1] = tw[j])) / len(tw) AS agreement
      FROM u JOIN t ON w[i] = ph[1] AND w[i:i + len(ph) - 1] = ph),
g AS (SELECT r, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word,
             max(start) FILTER (base) AS last_word,
             string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
             string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(agreement) AS best FROM p GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word,
       CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CAST(round(coalesce(best, 0.0), 6) AS DOUBLE) AS score
FROM d LEFT JOIN g USING (r)"""


def _centroid_sql(rounds: int = 10) -> str:
    near = """SELECT r, any_value(vec_id) AS vec_id, any_value(v) AS v, min(struct_pack(d := d, k := k)) AS b
FROM (SELECT r, vec_id, v, k, CAST(list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d FROM v, c{i})
GROUP BY r"""
    steps = [f"""
a{i} AS MATERIALIZED ({near.format(i=i)}),
m{i} AS (SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS c
         FROM (SELECT b.k AS k, j, sum(v[j]) AS s, count(*) AS n FROM a{i}, unnest(range(1, 65)) AS x(j) GROUP BY b.k, j) GROUP BY k),
c{i + 1} AS MATERIALIZED (SELECT k, coalesce(m{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN m{i} USING (k)),""" for i in range(rounds)]
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS k, v AS c
  FROM (SELECT sha256('3:' || vec_id) AS h, v FROM v WHERE vec_id IS NOT NULL ORDER BY h, v LIMIT 8)),{''.join(steps)}
f AS MATERIALIZED ({near.format(i=rounds)})
SELECT vec_id, CAST(b.k AS INTEGER) AS cluster, b.d AS distance, CAST(sum(b.d) OVER (PARTITION BY b.k) AS BIGINT) AS cluster_inertia,
       CAST(sum(b.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM f JOIN c{rounds} ON k = b.k"""


SQL = {
    "op12_centroid_clustering": _centroid_sql(),
    # CRC-32 byte by byte: the table follows from its polynomial, each step joins the next byte.
    "op11_spelling_variants": rf"""
WITH RECURSIVE t(i, x) AS MATERIALIZED (
  SELECT i, list_reduce([i] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
  FROM unnest(range(256)) AS u(i)),
o AS MATERIALIZED (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[a-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents)
  WHERE length(run) >= 6 GROUP BY ALL),
h(id, run, n, bytes, p, c) AS (
  SELECT id, run, n, hex(encode(id || ':' || run)), 0, 4294967295::BIGINT FROM o
  UNION ALL
  SELECT id, run, n, bytes, p + 2, xor(c >> 8, x) FROM h JOIN t ON t.i = xor(c & 255, CAST('0x' || bytes[p + 1:p + 2] AS BIGINT))
  WHERE p < length(bytes)),
w AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT n, CASE WHEN c % 199 = 0 THEN substr(run, 1, CAST(c % length(run) AS BIGINT)) || substr(run, CAST(c % length(run) AS BIGINT) + 2)
                       ELSE run END AS word
        FROM (SELECT run, n, xor(c, 4294967295::BIGINT) AS c FROM h WHERE p = length(bytes)))
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
g AS MATERIALIZED (
  SELECT word, n, i, substr(word, 1, i - 1) AS head, substr(word, i + 1) AS tail FROM w, unnest(range(1, length(word) + 1)) AS u(i)),
e AS MATERIALIZED (
  SELECT a.word, b.word AS near, b.n FROM g AS a JOIN g AS b USING (i, head, tail) WHERE a.word <> b.word
  UNION SELECT g.word, w.word, w.n FROM g JOIN w ON w.word = head || tail
  UNION SELECT w.word, g.word, g.n FROM g JOIN w ON w.word = head || tail),
f AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(k, 0) AS n_near, CASE WHEN b.n >= 5 * w.n THEN b.near END AS form, CASE WHEN b.n >= 5 * w.n THEN b.n END AS form_n
  FROM w LEFT JOIN (SELECT word, near, n, count(*) OVER (PARTITION BY word) AS k,
                           row_number() OVER (PARTITION BY word ORDER BY n DESC, near) AS place FROM e) AS b
  ON b.word = w.word AND place = 1),
s(word, root) AS (SELECT word, word FROM f UNION ALL SELECT s.word, f.form FROM s JOIN f ON f.word = s.root WHERE form IS NOT NULL)
SELECT f.word, f.form, s.root, f.n, f.n_near, f.form_n
FROM f JOIN s USING (word) JOIN f AS z ON z.word = s.root WHERE z.form IS NULL""",
    "op5_license_scan": _license_sql(),
    "op6_benchmark_decontamination": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
x AS (SELECT DISTINCT item_id, w[i:i + 9] AS g FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s(i) WHERE len(w) > 0),
h AS (SELECT r, i, l, g FROM (SELECT r, i, l, w[i:i + l - 1] AS g FROM d, (SELECT DISTINCT len(g) AS l FROM x) AS z,
                                     unnest(range(1, len(w) - l + 2)) AS s(i))
      WHERE g IN (SELECT g FROM x)),
c AS (SELECT r, count(DISTINCT p) AS n FROM h, unnest(range(i, i + l)) AS s(p) GROUP BY r),
f AS (SELECT r, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS items
      FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item_id FROM h JOIN x USING (g) WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(c.n, 0) AS n_hit, coalesce(f.n, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(c.n, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (r) LEFT JOIN f USING (r)""",
    "op1_suffix_array_dedup": """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS h FROM documents),
w AS (SELECT r, doc_id, i, h[i + 1:i + 50] AS g FROM d, unnest(range(0, octet_length(h) - 49)) AS x(i)),
f AS (SELECT g, min(doc_id) AS least FROM w GROUP BY g HAVING count(*) > 1),
e AS (SELECT r, i, i > coalesce(max(i) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 50, -1) AS fresh
      FROM w JOIN f USING (g) WHERE doc_id > least),
s AS (SELECT r, min(i) AS a, max(i) + 50 AS b FROM (SELECT r, i, sum(CASE WHEN fresh THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY i) AS k FROM e)
      GROUP BY r, k),
c AS (SELECT r, sum(b - a) AS n_removed, count(*) AS n_spans, list(a ORDER BY a) AS a, list(b ORDER BY a) AS b FROM s GROUP BY r)
SELECT doc_id, CAST(octet_length(h) AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(CASE WHEN a IS NULL THEN h ELSE unhex(array_to_string(list_transform(range(0, len(a) + 1), lambda j: hex(
           h[(CASE WHEN j = 0 THEN 0 ELSE b[j] END) + 1:CASE WHEN j = len(a) THEN octet_length(h) ELSE a[j + 1] END])), '')) END) AS kept_sha256
FROM d LEFT JOIN c USING (r)""",
    "op9_ngram_jaccard": rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, w[i:i + 4] AS g FROM d, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS x(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s AS a JOIN s AS b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM o JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b WHERE 100 * o >= 80 * (x.n + y.n - o)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a) LEFT JOIN n USING (doc_id)""",
    "op7_exact_dedup": """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))""",
}
