"""Adjacent job: press-directory entries, gazetteer and linking data → eight
keyed tables (Place, AdminCounty, HistoricCounty, Country; Entry, Issue,
Price, PoliticalLeaning) plus audits of unmatched places and newspapers.

All lookups are joins against reduced dimensions; list columns stay typed
arrays and are resolved with an explode → join → ordered regroup.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relnorm.functions.codes import zero_fill
from relnorm.functions.predicates import not_blank
from relnorm.functions.text import split_list, trim_elements
from relnorm.operators.aggregates import sorted_distinct_dim
from relnorm.operators.audit import multi_match_keys, unmatched_keys
from relnorm.operators.checks import Checks
from relnorm.operators.dedupe import keep_first
from relnorm.operators.keys import dense_key
from relnorm.operators.records import stamp
from relnorm.operators.resolve import lookup_first, resolve_array_fk, resolve_fk
from relnorm.session import staging
from relnorm.sources.tables import read_csv, read_json_dictionary, read_json_records

# Columns used of the gazetteer and of the linking file.
GAZETTEER_COLUMNS = ["wikidata_id", "english_label", "latitude", "longitude", "geonamesIDs"]
LINKING_COLUMNS = ["NLP", "Title", "AcquiredYears", "Editions", "EditionTitles", "City", "Publisher",
                   "UnavailableYears", "Collection", "UK", "Complete", "Notes", "County",
                   "HistoricCounty", "First date held", "Publication title", "link_to_mpd"]


def _dim_from_places(places: DataFrame, prefix: str, pk: str) -> DataFrame:
    """Distinct non-blank (label, wikidata_id) pairs keyed in order of their
    first place (places are keyed by wikidata id)."""
    lab, wid = f"{prefix}_label", f"{prefix}_wikidata_id"
    d = places.filter(not_blank(lab, wid)).groupBy(lab, wid).agg(F.min("place_pk").alias("_first"))
    d = dense_key(d, ["_first", lab, wid], pk=pk)
    return d.select(pk, F.col(lab).alias("label"), F.col(wid).alias("wikidata_id"))


def build_tables(spark: SparkSession, mitchells: DataFrame, gazetteer: DataFrame,
                 historic: DataFrame, admin: DataFrame, countries: DataFrame,
                 linking: DataFrame, newspapers: DataFrame, run_ts: str, strict_keys: bool = False,
                 checks: Checks | None = None) -> dict:
    """``mitchells``: directory rows with an ``row_order`` column;
    ``gazetteer``: the five gazetteer columns; dictionaries: rows
    ``(place_wikidata_id, label, wikidata_id)``; ``linking``: linking rows;
    ``newspapers``: flat newspaper records ``(pk, publication_code)``.
    Unresolved keys are measured by ``checks`` when the tables are written."""
    checks = checks if checks is not None else Checks()
    mentions = mitchells.select(F.col("PLACE_PUB_WIKI").alias("place_wikidata_id")).distinct()
    gaz = gazetteer.select(F.col("wikidata_id").alias("place_wikidata_id"),
                           F.col("english_label").alias("place_label"), "latitude", "longitude",
                           F.col("geonamesIDs").alias("geonames_ids"))
    gaz = gaz.join(mentions, "place_wikidata_id", "left_semi")
    gaz = dense_key(gaz, ["place_wikidata_id"], pk="place_pk",
                    tiebreak=["place_label", "latitude", "longitude", "geonames_ids"])

    def attach(df, d, prefix):
        d = keep_first(d, ["place_wikidata_id"], ["label", "wikidata_id"])
        return df.join(d.select("place_wikidata_id", F.col("label").alias(f"{prefix}_label"),
                                F.col("wikidata_id").alias(f"{prefix}_wikidata_id")),
                       "place_wikidata_id", "left")

    enriched = attach(attach(attach(gaz, historic, "hc"), admin, "ac"), countries, "co")
    hc = _dim_from_places(enriched, "hc", "pk")
    ac = _dim_from_places(enriched, "ac", "pk")
    co = _dim_from_places(enriched, "co", "pk")

    place = enriched
    for prefix, dim, out in (("hc", hc, "historic_county"), ("ac", ac, "admin_county"), ("co", co, "country")):
        place = resolve_fk(place, dim.withColumnsRenamed({"label": f"_{prefix}_l", "wikidata_id": f"_{prefix}_w"}),
                           {f"{prefix}_label": f"_{prefix}_l", f"{prefix}_wikidata_id": f"_{prefix}_w"},
                           as_name=out).drop(f"{prefix}_label", f"{prefix}_wikidata_id")
    place = place.select(F.col("place_pk").alias("pk"), F.col("place_wikidata_id").alias("wikidata_id"),
                         F.col("place_label").alias("label"), "latitude", "longitude", "geonames_ids",
                         "historic_county", "admin_county", "country")

    m = mitchells.select(
        "row_order", F.col("ID").alias("mpd_id"), F.col("TITLE").alias("title"),
        split_list(F.col("POLITICS")).alias("political_leaning_raw"),
        split_list(F.col("PRICE")).alias("price_raw"),
        split_list(F.col("PERSONS")).alias("persons"),
        split_list(F.col("ORGANIZATIONS")).alias("organisations"),
        F.col("YEAR").try_cast("bigint").alias("year"),
        F.col("PLACE_PUB_WIKI").alias("place_of_publication_id"),
        F.col("ESTABLISHED_DATE").alias("date_established_raw"),
        F.col("PUBLISED_DATE").alias("day_of_publication_raw"))

    leanings = sorted_distinct_dim(m.select(F.explode(trim_elements(F.col("political_leaning_raw"))).alias("label")),
                                   "label", pk="pk")
    prices = sorted_distinct_dim(m.select(F.explode(trim_elements(F.col("price_raw"))).alias("label")),
                                 "label", pk="pk")
    issues = sorted_distinct_dim(m, "year", pk="pk")

    link = linking.select(F.col("NLP").cast("string").alias("newspaper"),
                          F.col("link_to_mpd").alias("mpd_id"))
    # SQL join: a NULL mpd_id never matches
    entry = m.join(link, "mpd_id", "inner")
    entry = entry.withColumns({
        "place_of_circulation_raw": F.lit(""), "publication_district_raw": F.lit(""),
        "publication_county_raw": F.lit(""),
        "_lean": trim_elements(F.col("political_leaning_raw")), "_price": trim_elements(F.col("price_raw")),
        "newspaper_code": zero_fill(F.col("newspaper")),
    })
    order = ["row_order", "newspaper"]
    entry = dense_key(entry, order, pk="pk", tiebreak=[c for c in entry.columns if c not in order])
    # the keyed entries are a staged table already
    entry = resolve_array_fk(entry, "_lean", leanings, label="label", as_name="political_leanings", stage_input=False)
    entry = resolve_array_fk(entry, "_price", prices, label="label", as_name="prices", stage_input=False)
    entry = resolve_fk(entry, issues, "year", as_name="issue", policy="strict" if strict_keys else "null",
                       checks=checks.part("mitchells.Entry"))
    # a place or paper that is not found is reported by the audits and never fatal
    entry = resolve_fk(entry, place.select("pk", F.col("wikidata_id").alias("place_of_publication_id")),
                       "place_of_publication_id", as_name="place_of_publication", checks=checks.part("mitchells.Entry"))
    entry = lookup_first(entry.withColumnRenamed("newspaper", "newspaper_nlp"),
                         newspapers.select(F.col("pk").alias("newspaper"), "publication_code"),
                         {"newspaper_code": "publication_code"}, ["newspaper"], "newspaper")
    entry = entry.select(
        "pk", "title", "political_leaning_raw", "price_raw", "year", "date_established_raw",
        "day_of_publication_raw", "place_of_circulation_raw", "publication_district_raw",
        "publication_county_raw", "organisations", "persons", "newspaper", "political_leanings",
        "prices", "issue", "place_of_publication")

    m_link = m.join(link, "mpd_id", "inner").select(zero_fill(F.col("newspaper")).alias("code"),
                                                   "place_of_publication_id")
    audits = {
        "places_not_found": unmatched_keys(m_link, place, "place_of_publication_id", "wikidata_id"),
        "papers_not_found": unmatched_keys(m_link, newspapers, "code", "publication_code"),
        "papers_many": multi_match_keys(newspapers, "publication_code"),
    }
    tables = {
        "gazetteer.Place": place, "gazetteer.AdminCounty": ac, "gazetteer.HistoricCounty": hc,
        "gazetteer.Country": co, "mitchells.PoliticalLeaning": leanings, "mitchells.Price": prices,
        "mitchells.Issue": issues, "mitchells.Entry": entry,
    }
    tables = {k: stamp(v, run_ts) for k, v in tables.items()}
    tables.update(audits)
    return tables


def read_inputs(spark: SparkSession, mitchells_csv: str, gazetteer_csv: str, historic_json: str,
                admin_json: str, countries_json: str, linking_csv: str, newspapers_json: str) -> dict:
    """Read the seven inputs with explicit string schemas (codes keep zeros)."""
    m = read_csv(spark, mitchells_csv)
    first = m.columns[0]
    m = m.withColumn("row_order", F.col(first).try_cast("bigint"))
    gaz = read_csv(spark, gazetteer_csv).select(*GAZETTEER_COLUMNS)
    gaz = gaz.withColumns({"latitude": F.col("latitude").try_cast("double"),
                           "longitude": F.col("longitude").try_cast("double")})
    link = read_csv(spark, linking_csv).select(*LINKING_COLUMNS)
    papers = read_json_records(spark, newspapers_json, "pk bigint, model string, fields struct<publication_code:string>",
                               glob="*.json")
    papers = papers.select("pk", "fields.publication_code")
    return dict(mitchells=m, gazetteer=gaz, historic=read_json_dictionary(spark, historic_json),
                admin=read_json_dictionary(spark, admin_json),
                countries=read_json_dictionary(spark, countries_json), linking=link, newspapers=papers)


def run(spark: SparkSession, inputs: dict, output: str, run_ts: str, formats=("json", "csv"),
        strict_keys: bool = False) -> dict:
    """Write the eight tables in the given formats, and the audits and
    ``checks`` as JSON Lines.  Returns the records of each table, counted while
    it was written first."""
    from relnorm.sinks.fixtures import export_tables
    checks = Checks()
    with staging(spark):
        tables = build_tables(spark, run_ts=run_ts, strict_keys=strict_keys, checks=checks, **inputs)
        main = {k: checks.count(v, k) for k, v in tables.items() if "." in k}
        export_tables(main, output, formats, gates={k: checks.part(k).verify for k in main})
        for name in (k for k in tables if "." not in k):
            checks.count(tables[name], name).write.mode("overwrite").json(f"{output}/{name}")
        checks.table(spark).write.mode("overwrite").json(f"{output}/checks")
    return checks.counts()
