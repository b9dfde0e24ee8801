"""News job: zips of per-article XML documents → six keyed, linked tables
(data provider, ingest, digitisation, newspaper, issue, item), a quarantine
of rejected documents, and a per-archive run report.

Plan: one scan of the archives by bytes → parse once → all records of each
document in one pass, staged as a row with a column per kind → keep-first per natural key in document
order (archive size, archive path, entry index) → dense keys → FK joins.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relnorm.functions.codes import sole_match, zero_fill
from relnorm.functions.dates import assemble_date
from relnorm.functions.text import invert_article, name_prefix
from relnorm.operators import extract as X
from relnorm.operators.aggregates import collection_totals
from relnorm.operators.checks import Checks
from relnorm.operators.dedupe import keep_first
from relnorm.operators.keys import dense_key
from relnorm.operators.records import stamp
from relnorm.operators.resolve import resolve_fk, sole_interval
from relnorm.session import brief_shuffles, stage, staging, unstage
from relnorm.sources.archives import SPLIT_BYTES, archive_entries, archive_list, file_name, parent_name
from relnorm.sources.providers import provider_records
from relnorm.sources.tables import read_csv

# Abbreviations whose title is given explicitly when no other
# rule finds one.
TITLE_EXCEPTIONS = {
    "IPJL": "Ipswich Journal",
    "BHCH": "Bath Chronicle",
    "LSIR": "Leeds Intelligencer",
    "AGER": "Lancaster Gazetter, And General Advertiser For Lancashire West",
}

# Columns of the title authority file.
AUTHORITY_COLUMNS = ["Newspaper Title", "NLP", "Abbr", "StartD", "StartM", "StartY",
                     "EndD", "EndM", "EndY"]


def _collection(archive):
    """The folder above ``metadata`` without its suffix, else the archive's own folder."""
    # Fixed value: the suffix of the folders that the digitisation tool writes.
    named = F.regexp_extract(archive, r"/([^/]+?)(?:-alto2txt)?/metadata/[^/]+$", 1)
    return F.coalesce(F.nullif(named, F.lit("")), parent_name(archive))


def read_documents(spark: SparkSession, mount: str, glob: str = "*.zip", split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """``(collection, archive, archive_name, archive_size, entry_index, xml)``
    and ``read_error`` for every non-empty entry, whatever its name, decoded as
    it declares; a damaged entry or archive has a ``read_error`` and no ``xml``.
    One scan whose tasks follow the archives' bytes; nothing is shuffled."""
    content = archive_entries(spark, mount, glob, content=True, convert="xml", split_bytes=split_bytes)
    archive = F.col("archive")
    return content.filter(F.col("error").isNotNull() | (F.length("content") > 0)).select(
        "archive", file_name(archive).alias("archive_name"), "archive_size",
        _collection(archive).alias("collection"), "entry_index", F.col("content").cast("string").alias("xml"),
        F.col("error").alias("read_error"))


def read_title_authority(spark: SparkSession, path: str) -> DataFrame:
    """``(title, publication_code, abbr, start_date, end_date)``; dates from
    day / month-name / year parts; ``X, The`` titles inverted; codes
    zero-filled strings."""
    schema = ", ".join(f"`{c}` string" for c in AUTHORITY_COLUMNS)
    raw = read_csv(spark, path, schema)
    return raw.select(
        invert_article(F.col("Newspaper Title")).alias("title"),
        zero_fill(F.col("NLP")).alias("publication_code"),
        F.col("Abbr").alias("abbr"),
        assemble_date(F.col("StartD"), F.col("StartM"), F.col("StartY")).alias("start_date"),
        assemble_date(F.col("EndD"), F.col("EndM"), F.col("EndY")).alias("end_date"),
    )


def compile_authority(authority: DataFrame) -> DataFrame:
    """``(_abbr, _code, code_title)``: the title of a publication code that has
    exactly one row (with NULL for ``_abbr``), and the only title of an
    abbreviation and publication code."""
    coded = authority.filter(F.col("publication_code").isNotNull())
    by_code = coded.groupBy("publication_code").agg(F.count(F.lit(1)).alias("n"), F.min("title").alias("title"))
    by_code = by_code.filter(F.col("n") == 1).select(
        F.lit(None).cast("string").alias("_abbr"), F.col("publication_code").alias("_code"), F.col("title").alias("code_title"))
    by_both = _only_title(coded.filter(F.col("abbr").isNotNull()), ["abbr", "publication_code"])
    return by_code.union(by_both.select("abbr", "publication_code", "title"))


def _only_title(authority: DataFrame, keys) -> DataFrame:
    """The title of each key whose titles all agree."""
    titles = authority.groupBy(*keys).agg(F.min("title").alias("title"), F.max("title").alias("_most"))
    return titles.filter(F.col("title") == F.col("_most")).drop("_most")


def match_titles(papers: DataFrame, authority: DataFrame) -> DataFrame:
    """Resolve blank titles against the authority.  ``papers`` has
    ``publication_code, title, issue_date, input_sub_path, abbr``.  Adds
    ``match_tier``.  Cascade: (1) a single 7-digit code in the sub-path →
    the authority title when that code has exactly one row, else the given
    title, and stop; (2) abbreviation + issue date inside exactly one
    validity interval; (3) the abbreviation's only title; (4) the only title
    of abbreviation + publication code; (5) a fixed exception title; (6) the
    abbreviation itself.

    Distinct combinations of codes, abbreviation and date are resolved first,
    by joins with rows of fixed width: by code (the path's, or abbreviation and
    publication code) and by abbreviation and date, for which intervals are
    looked up once per pair, whatever their number.  Papers cross one join."""
    path_code = sole_match(F.col("input_sub_path"))
    needed = {"_path_code": path_code, "_abbr": F.col("abbr"), "_paper_code": F.col("publication_code"),
              "_date": F.try_to_date(F.col("issue_date"), "yyyy-MM-dd")}
    p = papers.withColumns(needed)
    needs = p.select(*needed).distinct()
    known = compile_authority(authority).withColumnsRenamed({"_abbr": "_known_abbr", "_code": "_known_code"})
    # a code without an abbreviation is known by itself only as a path's
    code_abbr = F.when(F.col("_path_code").isNull(), F.col("_abbr"))
    answers = needs.join(known, (F.coalesce("_path_code", "_paper_code") == F.col("_known_code"))
                         & code_abbr.eqNullSafe(F.col("_known_abbr"))
                         & (F.col("_path_code").isNotNull() | F.col("_abbr").isNotNull()), "left")
    dated = needs.select("_abbr", "_date").filter(F.col("_abbr").isNotNull()).distinct()
    intervals = authority.select(F.col("abbr").alias("_abbr"), "start_date", "end_date", F.col("title").alias("interval"))
    valid = sole_interval(dated, intervals, ["_abbr"], "_date", "start_date", "end_date", ["interval"])
    sole = _only_title(authority.filter(F.col("abbr").isNotNull()), ["abbr"]).select(
        F.col("abbr").alias("_abbr"), F.col("title").alias("sole_title"))
    answers = stage(answers.join(valid, ["_abbr", "_date"], "left").join(sole, "_abbr", "left").select(
        *[F.col(n).alias(f"_for{n}") for n in needed], "interval", "sole_title", "code_title"))
    in_path = F.col("_path_code").isNotNull()
    p = p.join(answers, reduce(lambda x, y: x & y, [F.col(n).eqNullSafe(F.col(f"_for{n}")) for n in needed]), "left")
    exceptions = F.create_map(*[x for k, v in TITLE_EXCEPTIONS.items() for x in (F.lit(k), F.lit(v))])
    blank = F.col("title").isNull() | (F.col("title") == "")
    by_abbr = [
        ("interval", F.col("interval")), ("sole_title", F.col("sole_title")), ("abbreviation_code", F.col("code_title")),
        ("exception", F.try_element_at(exceptions, F.col("abbr"))),
        ("abbreviation", F.nullif(F.col("abbr"), F.lit("")))]
    title = F.when(~blank, F.col("title")).when(in_path, F.coalesce("code_title", "title")).otherwise(
        F.coalesce(*[t for _, t in by_abbr]))
    tier = F.when(~blank, F.lit("document")).when(in_path, F.lit("path_code"))
    for name, value in by_abbr:
        tier = tier.when(value.isNotNull(), F.lit(name))
    return p.withColumns({"match_tier": tier, "title": title}).drop(
        *needed, *[f"_for{n}" for n in needed], "interval", "sole_title", "code_title")


def archive_report(records: DataFrame, manifest: DataFrame | None = None, run_id: str | None = None) -> DataFrame:
    """Per archive: documents used and rejected, items, its papers (bounded by
    the archive's titles), issues and bytes, from the rows of ``document_records``.
    ``manifest`` adds archives that gave no document, with zeros."""
    report = records.groupBy("archive", "archive_name").agg(
        F.count_if(F.col("issue").isNotNull()).alias("n_documents"),
        F.count_if(F.col("quarantine").isNotNull()).alias("n_rejected"),
        F.count_distinct("item.item_code").alias("n_items"),
        F.sort_array(F.collect_set("issue.publication_code")).alias("publication_codes"),
        F.count_distinct("issue.issue_code").alias("n_issues"),
        F.min("collection").alias("collection"), F.max("archive_size").cast("bigint").alias("bytes"))
    if manifest is not None:
        listed = manifest.select(F.col("path").alias("archive"), F.col("archive_name").alias("_name"),
                                 _collection(F.col("path")).alias("_collection"), F.col("length").alias("_bytes"))
        report = listed.join(report, "archive", "left").select(
            "archive", F.col("_name").alias("archive_name"),
            *[F.coalesce(n, F.lit(0)).alias(n) for n in ("n_documents", "n_rejected", "n_items")],
            F.coalesce("publication_codes", F.array().cast("array<string>")).alias("publication_codes"),
            F.coalesce("n_issues", F.lit(0)).alias("n_issues"),
            F.col("_collection").alias("collection"), F.col("_bytes").alias("bytes"))
    return report.withColumn("n_papers", F.size("publication_codes").cast("bigint")).withColumn(
        "run_id", F.lit(run_id).cast("string"))


TABLES = ("dataprovider", "ingest", "digitisation", "newspaper", "issue", "item")


#: The order of documents: keep-first takes the first of it.
_ORDER = ["archive_size", "archive", "entry_index"]


def stage_records(docs: DataFrame, title_cap: int | None = None) -> DataFrame:
    """The staged ``document_records`` of a documents frame (see ``read_documents``), which nothing reads after this."""
    if "read_error" not in docs.columns:
        docs = docs.withColumn("read_error", F.lit(None).cast("string"))
    parsed = X.with_codes(X.parse_documents(docs))
    return stage(X.document_records(parsed, F.coalesce("read_error", "parse_error", "code_error"),
                                    keep=[*_ORDER, "archive_name", "collection"], title_cap=title_cap))


def build_tables(spark: SparkSession, docs: DataFrame, authority: DataFrame | None = None,
                 run_ts: str = "1970-01-01 00:00:00.000000+00:00", manifest: DataFrame | None = None,
                 run_id: str | None = None, requested=None, title_cap: int | None = None,
                 strict_keys: bool = False, checks: Checks | None = None) -> dict:
    """All output tables from a documents frame (see ``read_documents`` and ``tables_of``).

    ``title_cap`` cuts titles; those that are cut are among the ``rejected_values``.
    """
    return tables_of(spark, stage_records(docs, title_cap), authority, run_ts, manifest, run_id, requested,
                     strict_keys, checks)


def tables_of(spark: SparkSession, records: DataFrame, authority: DataFrame | None = None,
              run_ts: str = "1970-01-01 00:00:00.000000+00:00", manifest: DataFrame | None = None,
              run_id: str | None = None, requested=None, strict_keys: bool = False,
              checks: Checks | None = None) -> dict:
    """All output tables from the rows of ``stage_records``.

    ``quarantine`` has the documents that cannot be used, ``rejected_values``
    the numbers and dates that cannot be read and the titles that were cut
    (their documents stay).  With ``manifest`` the report also lists
    archives without any document, and ``collections`` the archives and bytes
    of every ``requested`` collection, empty ones too.  Unresolved keys and
    papers without a title are measured by ``checks`` when the tables are
    written; with ``strict_keys`` its ``verify`` raises on an unresolved key.

    ``TABLES`` are built on staged tables of their own and read ``records`` no more.
    """
    checks = checks if checks is not None else Checks()
    policy = "strict" if strict_keys else "null"
    order = list(_ORDER)

    def kind(name, *keep):
        return X.record_rows(records, name, keep)

    quarantine = kind("quarantine", "archive", "entry_index")
    rejected = kind("rejected", "archive", "entry_index")

    providers = dense_key(provider_records(spark, kind("dataprovider")), ["collection_name"])
    ingest = dense_key(kind("ingest").distinct(), ["lwm_tool_name", "lwm_tool_version"])
    digit = keep_first(kind("digitisation", *order), ["software"], order).drop(*order)
    digit = dense_key(digit, ["software"])

    papers = keep_first(kind("newspaper", "collection", "archive_name", *order),
                        ["collection", "publication_code"], order)
    papers = papers.withColumn("abbr", name_prefix(F.col("archive_name")))
    # keys first: titles are matched once, on a staged table
    papers = dense_key(papers, ["collection", "shard", "publication_code"])
    if authority is not None:
        papers = stage(match_titles(papers, authority))
    else:
        papers = papers.withColumn("match_tier", F.when(F.col("title") != "", F.lit("document")))
    newspaper = papers.select(
        "pk", "publication_code", "title", "location", "collection", "shard", "match_tier")
    titled = checks.part("newspaper").watch(newspaper, "newspaper without title", F.coalesce("title", F.lit("")) == "",
                                            ["collection", "publication_code"])

    issues = keep_first(kind("issue", "collection", *order), ["collection", "publication_code", "issue_code"],
                        order).drop(*order)
    issue = dense_key(issues, ["collection", "shard", "publication_code", "issue_code"])
    linked_issue = resolve_fk(issue, newspaper, "publication_code", as_name="newspaper_id", policy=policy,
                              checks=checks.part("issue"))

    # exact duplicates (the same article read twice) are dropped; keys come
    # first, on the narrow natural columns, so foreign keys cross no range sort
    items = kind("item", "collection").dropDuplicates()
    # two versions of an article share a code: every other column breaks the tie
    order = ["collection", "shard", "publication_code", "item_code"]
    item = numbered = dense_key(items, order, tiebreak=[c for c in items.columns if c not in order])
    # one row per collection directory; a third of all items may sit in one
    # collection, or come from one software or tool, so never shuffle on them
    for dim, on, name, small in (
            (digit, {"digitisation_software": "software"}, "digitisation_id", True),
            (ingest, {"ingest_name": "lwm_tool_name", "ingest_version": "lwm_tool_version"}, "ingest_id", True),
            (issue, "issue_code", "issue_id", False),
            (providers, {"collection": "collection_name"}, "data_provider_id", True)):
        item = resolve_fk(item, dim, on, as_name=name, broadcast=small, policy=policy,
                          checks=checks.part("item"))
    # linked before they are written: no join's shuffle and no key that is resolved takes up room beside the output
    item = stage(item.select("pk", "item_code", "word_count", "title", "item_type", "input_filename",
                             "ocr_quality_mean", "ocr_quality_sd", "digitisation_id", "ingest_id",
                             "issue_id", "data_provider_id"))
    unstage(numbered)

    tables = {
        "dataprovider": providers.select("pk", "name", "code", "legacy_code", "source_note", "collection"),
        "ingest": ingest.select("pk", "lwm_tool_name", "lwm_tool_version"),
        "digitisation": digit.select("pk", "xml_flavour", "software", "mets_namespace", "alto_namespace"),
        "newspaper": titled.select("pk", "publication_code", "title", "location"),
        "issue": linked_issue.select("pk", "issue_code", "issue_date", "newspaper_id", "input_sub_path"),
        "item": item,
    }
    tables = {k: stamp(v, run_ts) for k, v in tables.items()}
    tables["title_matches"] = newspaper.select("pk", "collection", "publication_code", "match_tier")
    tables["quarantine"] = quarantine
    tables["rejected_values"] = rejected
    tables["report"] = archive_report(records, manifest, run_id)
    if manifest is not None:
        named = manifest.withColumn("collection", _collection(F.col("path")))
        requested = requested or [r[0] for r in named.select("collection").distinct().collect()]
        tables["collections"] = collection_totals(spark, requested, named)
    return tables


def run(spark: SparkSession, mount: str, output: str, authority_csv: str | None = None,
        max_elements_per_file: int = 2_000_000, run_ts: str | None = None, requested=None,
        title_cap: int | None = None, strict_keys: bool = False, after_reading=None) -> dict:
    """Read, build and write every table: the reports as JSON Lines, the six as
    numbered fixture JSON, and ``checks``.  Returns the records of each table,
    counted while writing.  With ``strict_keys`` an unresolved key ends the job
    before the table that holds it appears.

    ``after_reading`` is called when the archives have been read for the last
    time, before any table is written: whoever made them for this job only can
    remove them.  (The authority file is read later.)"""
    import datetime as dt
    from relnorm.sinks.fixtures import write_fixture_json
    run_ts = run_ts or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f+00:00")
    authority = read_title_authority(spark, authority_csv) if authority_csv else None
    checks = Checks()
    with staging(spark), brief_shuffles(spark):
        manifest = stage(archive_list(spark, mount))
        records = stage_records(read_documents(spark, mount), title_cap)
        if after_reading is not None:
            after_reading()
        tables = tables_of(spark, records, authority, run_ts, manifest, run_ts, requested, strict_keys, checks)
        # reports first: after them nothing reads the records, which then make room for the tables
        for name in [n for n in tables if n not in TABLES]:
            checks.count(tables[name], name).write.mode("overwrite").json(f"{output}/{name}")
        unstage(records)
        for name in TABLES:
            write_fixture_json(checks.count(tables[name], name), f"{output}/{name}", f"newspapers.{name}",
                               chunk_size=max_elements_per_file, gate=checks.part(name).verify)
        checks.table(spark).write.mode("overwrite").json(f"{output}/checks")
    return checks.counts()
