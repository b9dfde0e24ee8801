"""Nested XML documents → relational records (one parse, six projections).

A document is an XML string per archive entry.  ``parse_documents`` applies
``from_xml`` (a native expression, PERMISSIVE mode) with an explicit schema;
corrupt documents keep their text in ``_corrupt_record`` and can be
quarantined.  Each record kind is then a plain projection of the parsed
struct: ``document_records`` gives all kinds in one pass, meant to be staged
once (``relnorm.session.stage``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, MapType, StringType, StructField, StructType)

from relnorm.functions.codes import (issue_code, item_code, publication_code_error, raw_publication_code, shard_key,
                                     sole_match)
from relnorm.functions.text import blank_to_zero, cap_title, clean_title

_S = StringType()

ITEM_SCHEMA = StructType([StructField(n, _S) for n in (
    "_id", "title", "word_count", "ocr_quality_mean", "ocr_quality_sd",
    "plain_text_file", "item_type")])

DOCUMENT_SCHEMA = StructType([
    StructField("process", StructType([
        StructField("input_sub_path", _S), StructField("xml_flavour", _S),
        StructField("software", _S), StructField("mets_namespace", _S),
        StructField("alto_namespace", _S),
        StructField("lwm_tool", MapType(_S, _S)),
    ])),
    StructField("publication", StructType([
        StructField("_id", _S), StructField("title", _S), StructField("location", _S),
        StructField("issue", StructType([
            StructField("date", _S), StructField("item", ArrayType(ITEM_SCHEMA)),
        ])),
    ])),
    StructField("_corrupt_record", _S),
])

XML_OPTIONS = {"mode": "PERMISSIVE", "ignoreSurroundingSpaces": "false",
               "columnNameOfCorruptRecord": "_corrupt_record"}


def parse_documents(df: DataFrame, xml_col: str = "xml", out: str = "doc") -> DataFrame:
    """Parse the XML column; adds ``out`` (struct) and ``parse_error``."""
    parsed = df.withColumn(out, F.from_xml(F.col(xml_col), DOCUMENT_SCHEMA, XML_OPTIONS))
    bad = F.col(f"{out}._corrupt_record").isNotNull() | F.col(f"{out}.publication").isNull()
    return parsed.withColumn("parse_error", F.when(bad, F.lit("malformed document")))


def with_codes(df: DataFrame, doc: str = "doc") -> DataFrame:
    """Publication code (with error), shard, issue date and issue code."""
    pid = F.col(f"{doc}.publication._id")
    # a column per step: written as one expression, every step would be
    # repeated wherever a later one uses it, and the code get too long to compile
    out = df.withColumn("_run", sole_match(F.col(f"{doc}.process.input_sub_path")))
    out = out.withColumn("_raw", raw_publication_code(pid, F.col("_run")))
    out = out.withColumn("code_error", publication_code_error(pid, F.col("_run"), F.col("_raw")))
    out = out.withColumns({
        "publication_code": F.when(F.col("code_error").isNull(), F.col("_raw")),
        "issue_date": F.col(f"{doc}.publication.issue.date"),
    }).drop("_run", "_raw")
    return out.withColumns({
        "shard": shard_key(F.col("publication_code")),
        "issue_code": issue_code(F.col("publication_code"), F.col("issue_date")),
    })


def _newspaper(doc: str) -> dict:
    return {"publication_code": F.col("publication_code"), "title": clean_title(F.col(f"{doc}.publication.title")),
            "location": F.col(f"{doc}.publication.location")}


def _issue(doc: str) -> dict:
    return {"issue_code": F.col("issue_code"), "issue_date": F.col("issue_date"),
            "publication_code": F.col("publication_code"),
            "input_sub_path": F.col(f"{doc}.process.input_sub_path")}


def _item(doc: str, item, title_cap: int | None) -> dict:
    software = F.col(f"{doc}.process.software")
    tool = F.col(f"{doc}.process.lwm_tool")
    title = item["title"] if title_cap is None else cap_title(item["title"], title_cap)
    return {"item_code": item_code(F.col("issue_code"), item["_id"]),
            "word_count": F.coalesce(item["word_count"].try_cast("bigint"), F.lit(0)).cast("bigint"),
            "title": F.coalesce(title, F.lit("")), "item_type": F.upper(item["item_type"]),
            "input_filename": F.coalesce(item["plain_text_file"], F.lit("")),
            "ocr_quality_mean": blank_to_zero(item["ocr_quality_mean"]),
            "ocr_quality_sd": blank_to_zero(item["ocr_quality_sd"]),
            "digitisation_software": F.when(software != "", software),
            "ingest_name": F.try_element_at(tool, F.lit("name")),
            "ingest_version": F.try_element_at(tool, F.lit("version")), "issue_code": F.col("issue_code")}


def _ingest(doc: str) -> dict:
    tool = F.col(f"{doc}.process.lwm_tool")
    return {"lwm_tool_name": F.try_element_at(tool, F.lit("name")),
            "lwm_tool_version": F.try_element_at(tool, F.lit("version"))}


def _digitisation(doc: str) -> dict:
    return {c: F.col(f"{doc}.process.{c}") for c in ("xml_flavour", "software", "mets_namespace", "alto_namespace")}


def _named(fields: dict):
    return [c.alias(n) for n, c in fields.items()]


def newspaper_records(df: DataFrame, doc: str = "doc", keep=()) -> DataFrame:
    """``publication_code, title (cleaned), location (NULL when absent)``."""
    return df.select(*_named(_newspaper(doc)), *keep)


def issue_records(df: DataFrame, doc: str = "doc", keep=()) -> DataFrame:
    return df.select(*_named(_issue(doc)), *keep)


def _first_item(doc: str):
    return F.try_element_at(F.col(f"{doc}.publication.issue.item"), F.lit(1))


def item_records(df: DataFrame, doc: str = "doc", collection: str = "collection",
                 explode_items: bool = False, keep=(), title_cap: int | None = None) -> DataFrame:
    """Item fields with defaults; the first ``item`` only unless ``explode_items``.

    ``title_cap`` cuts titles to that many characters; by default none is cut
    (``unreadable_values`` reports those that are).
    """
    item = F.explode_outer(f"{doc}.publication.issue.item") if explode_items else _first_item(doc)
    df = df.withColumn("_item", item)
    return df.select(
        *_named(_item(doc, F.col("_item"), title_cap)),
        F.col(collection).alias("collection") if collection in df.columns else F.lit(None).cast("string").alias("collection"),
        *[F.col(k) for k in keep],
    )


def ingest_records(df: DataFrame, doc: str = "doc") -> DataFrame:
    """Every child of ``lwm_tool``, keys prefixed ``lwm_tool_``."""
    tool = F.col(f"{doc}.process.lwm_tool")
    return df.select(*_named(_ingest(doc)),
                     F.transform_keys(tool, lambda k, v: F.concat(F.lit("lwm_tool_"), k)).alias("lwm_tool"))


def _unreadable(doc: str, title_cap: int | None):
    """Array of ``(field, value)``: what is given (not blank) but cannot be read, and titles that are cut."""
    item = _first_item(doc)
    given = [("word_count", item["word_count"], "bigint"), ("ocr_quality_mean", item["ocr_quality_mean"], "double"),
             ("ocr_quality_sd", item["ocr_quality_sd"], "double")]
    bad = [(n, v, v.try_cast(t).isNull()) for n, v, t in given]
    date = F.col(f"{doc}.publication.issue.date")
    bad.append(("issue_date", date, F.try_to_date(date, "yyyy-MM-dd").isNull()))
    if title_cap is not None:
        bad.append(("title", item["title"], F.length(item["title"]) > title_cap))
    values = F.array(*[F.struct(F.lit(n).alias("field"), v.alias("value"),
                                (v.isNotNull() & (F.trim(v) != "") & wrong).alias("bad")) for n, v, wrong in bad])
    return F.transform(F.filter(values, lambda r: r["bad"]),
                       lambda r: F.struct(r["field"].alias("field"), r["value"].alias("value")))


def unreadable_values(df: DataFrame, doc: str = "doc", keep=(), title_cap: int | None = None) -> DataFrame:
    """``keep…, field, value``: numbers of the first item and issue dates that
    are given (not blank) but cannot be read (the records use defaults
    instead), and titles that ``title_cap`` cuts."""
    return df.select(*keep, F.inline(_unreadable(doc, title_cap)))


def digitisation_records(df: DataFrame, doc: str = "doc", keep=()) -> DataFrame:
    """The four process fields; no row when software is absent or blank."""
    # a filtered one-element array instead of a Filter: a Filter on a parsed
    # field is pushed below the parse and would parse every document twice
    kept = F.filter(F.array(F.struct(*_named(_digitisation(doc)))),
                    lambda r: r["software"].isNotNull() & (r["software"] != ""))
    return df.select(F.inline(kept), *keep)


#: Record kinds of a document and the type of each, in the order in which ``fan_out`` gives them.
KINDS = {
    "newspaper": "struct<publication_code:string,title:string,location:string,shard:string,issue_date:string,"
                 "input_sub_path:string>",
    "issue": "struct<issue_code:string,issue_date:string,publication_code:string,input_sub_path:string,shard:string>",
    "item": "struct<item_code:string,word_count:bigint,title:string,item_type:string,input_filename:string,"
            "ocr_quality_mean:double,ocr_quality_sd:double,digitisation_software:string,ingest_name:string,"
            "ingest_version:string,issue_code:string,publication_code:string,shard:string>",
    "ingest": "struct<lwm_tool_name:string,lwm_tool_version:string>",
    "digitisation": "struct<xml_flavour:string,software:string,mets_namespace:string,alto_namespace:string>",
    "dataprovider": "struct<collection:string>",
    "quarantine": "struct<error:string>",
    "rejected": "struct<field:string,value:string>",
}


def document_records(df: DataFrame, error, doc: str = "doc", keep=(), collection: str = "collection",
                     title_cap: int | None = None) -> DataFrame:
    """One pass over parsed documents: a row each with all of its records.

    Columns are ``keep…`` and one per kind of ``KINDS``: a struct, NULL where
    the document gives no such record, and for ``rejected`` an array.  Stored,
    a table reads only its own columns, and the parsed struct itself is never
    stored.  A document with an ``error`` gives only ``quarantine``; any other
    its six records (no digitisation without software) and a ``rejected`` one
    for each value that cannot be read.
    """
    software = F.col(f"{doc}.process.software")
    shard = F.col("shard")
    fields = {
        "newspaper": {**_newspaper(doc), "shard": shard, "issue_date": F.col("issue_date"),
                      "input_sub_path": F.col(f"{doc}.process.input_sub_path")},
        "issue": {**_issue(doc), "shard": shard},
        "item": {**_item(doc, _first_item(doc), title_cap), "publication_code": F.col("publication_code"), "shard": shard},
        "ingest": _ingest(doc), "digitisation": _digitisation(doc),
        "dataprovider": {"collection": F.col(collection)}, "quarantine": {"error": F.col("_error")},
    }
    used = F.col("_error").isNull()
    given = {k: used for k in fields} | {"digitisation": used & (software != ""), "quarantine": ~used}
    records = {k: F.when(given[k], F.struct(*_named(f))) for k, f in fields.items()}
    records["rejected"] = F.when(used, _unreadable(doc, title_cap)).otherwise(
        F.array().cast(f"array<{KINDS['rejected']}>"))
    return df.withColumn("_error", error).select(*keep, *[records[k].alias(k) for k in KINDS])


def record_rows(records: DataFrame, kind: str, keep=()) -> DataFrame:
    """``keep…`` and the fields of one kind, a row per record, from the rows of ``document_records``."""
    if kind == "rejected":
        return records.select(*keep, F.inline(kind))
    return records.filter(F.col(kind).isNotNull()).select(*keep, f"{kind}.*")


def fan_out(df: DataFrame, error, doc: str = "doc", keep=(), collection: str = "collection",
            title_cap: int | None = None) -> DataFrame:
    """A row for each record of each document (see ``document_records``).

    Rows are ``keep…, kind`` and one struct per kind of ``KINDS``, of which only
    the row's own is set.
    """
    def record(kind, value):
        return F.struct(F.lit(kind).alias("kind"), *[
            (value if k == kind else F.lit(None)).cast(t).alias(k) for k, t in KINDS.items()])

    single = F.array(*[F.when(F.col(k).isNotNull(), record(k, F.col(k))) for k in KINDS if k != "rejected"])
    rows = F.concat(F.array_compact(single), F.transform("rejected", lambda r: record("rejected", r)))
    # other names, as ``keep`` may have a kind's
    kept = {c: f"_keep{i}" for i, c in enumerate(keep)}
    wide = document_records(df.withColumns({k: F.col(c) for c, k in kept.items()}), error, doc, list(kept.values()),
                            collection, title_cap)
    return wide.select(*[F.col(k).alias(c) for c, k in kept.items()], F.inline(rows))
