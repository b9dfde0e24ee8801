"""Damaged archives, encodings, malformed JSON and unreadable values: the good
rest comes through whole and every loss is listed."""

import json
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from relnorm.operators import resolve
from relnorm.plans import fulltext, news
from relnorm.sinks import fixtures as SK
from relnorm.sources import tables as ST
from relnorm.sources.archives import archive_entries, archive_manifest, read_entries
from tests.test_news_job import _doc


def _zip(path, entries, method=zipfile.ZIP_DEFLATED):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with zipfile.ZipFile(path, "w", method) as zf:
        for name, data in entries:
            zf.writestr(name, data)


def _flip(path, needle):
    raw = bytearray(open(path, "rb").read())
    raw[raw.index(needle)] ^= 1
    open(path, "wb").write(raw)


def test_damaged_entries_and_archives(spark, scratch):
    _zip(f"{scratch}/a.zip", [("p/good.txt", "kept"), ("p/bad.txt", "NEEDLE text")], zipfile.ZIP_STORED)
    _flip(f"{scratch}/a.zip", b"NEEDLE")
    open(f"{scratch}/b.zip", "wb").write(b"no zip at all")
    for got in (archive_entries(spark, scratch, content=True), read_entries(archive_entries(spark, scratch), on_error="report")):
        rows = {r.entry_name: r for r in got.collect()}
        _check_damage(rows)
    with pytest.raises(Exception, match="damaged entry"):
        archive_entries(spark, scratch, content=True, suffix=".txt", on_error="raise").collect()
    texts = {r.path: r for r in fulltext.fulltext_table(spark, scratch).collect()}
    assert texts["p/good.txt"].text == "kept" and texts["p/bad.txt"].text == ""
    assert "damaged" in texts["p/bad.txt"].errors and sorted(r.pk for r in texts.values()) == [1, 2]
    assert [r.archive.rsplit("/", 1)[-1] for r in fulltext.unreadable_archives(spark, scratch).collect()] == ["b.zip"]


def _check_damage(rows):
    assert bytes(rows["p/good.txt"].content) == b"kept" and rows["p/good.txt"].error is None
    assert rows["p/bad.txt"].content is None and "damaged" in rows["p/bad.txt"].error
    assert rows[None].entry_index == -1 and rows[None].error == "unreadable archive"


def test_text_crosses_no_shuffle_before_the_sink(spark, scratch):
    _zip(f"{scratch}/a.zip", [("p/a.txt", "x")])
    plan = fulltext.fulltext_table(spark, scratch)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInPandas") == 1 and plan.index("MapInPandas") < plan.index("Repartition")


def test_news_encodings_names_and_rejects(spark, scratch):
    latin = ('<?xml version="1.0" encoding="ISO-8859-1"?>' + _doc(
        "0002083", "Café", "1850-01-01", "art1", "0002083/1850/0101")).encode("latin-1")
    _zip(f"{scratch}/x-alto2txt/metadata/A_metadata.zip", [
        ("latin.xml", latin),
        ("utf16.xml", _doc("0002084", "Café", "1850-01-01", "art1", "0002084/1850/0101").encode("utf-16")),
        ("noname", _doc("0002085", "T", "not a date", "art1", "0002085/1850/0101", ocr="n/a")
         .replace("<word_count>12<", "<word_count>1,200<")),
        ("bad.xml", b"<lwm>\xff\xfe</lwm>"),
        ("odd.xml", b'<?xml version="1.0" encoding="klingon"?><lwm/>'),
    ])
    _zip(f"{scratch}/x-alto2txt/metadata/B_metadata.zip", [("broken.xml", "<lwm><process>")])
    _zip(f"{scratch}/x-alto2txt/metadata/C_metadata.zip", [])
    open(f"{scratch}/x-alto2txt/metadata/D_metadata.zip", "wb").write(b"cut")
    t = news.build_tables(spark, news.read_documents(spark, scratch), manifest=archive_manifest(spark, scratch),
                          run_id="r1")
    assert {r.publication_code: r.title for r in t["newspaper"].collect()} == {
        "0002083": "Café", "0002084": "Café", "0002085": "T"}
    assert {(r.archive.rsplit("/", 1)[-1][0], r.entry_index, r.error) for r in t["quarantine"].collect()} == {
        ("A", 3, "not valid utf-8"), ("A", 4, "unknown encoding klingon"),
        ("B", 0, "malformed document"), ("D", -1, "unreadable archive")}
    assert {(r.entry_index, r.field, r.value) for r in t["rejected_values"].collect()} == {
        (2, "word_count", "1,200"), (2, "ocr_quality_mean", "n/a"), (2, "issue_date", "not a date")}
    report = {r.archive_name[0]: (r.n_documents, r.n_rejected, r.n_items, r.n_papers, r.n_issues, r.run_id)
              for r in t["report"].collect()}
    assert report == {"A": (3, 2, 3, 3, 3, "r1"), "B": (0, 1, 0, 0, 0, "r1"), "C": (0, 0, 0, 0, 0, "r1"),
                      "D": (0, 1, 0, 0, 0, "r1")}
    assert [(r.collection, r.n_archives, r.is_empty) for r in t["collections"].collect()] == [("x", 4, False)]


def test_bad_json_costs_no_other_record(spark, scratch):
    files = {"a.json": '[{"pk": 1, "v": {"n": [1, 2]}}, {"pk": "oops"}, {"pk": 3}]', "b.json": '[{"pk": 4',
             "c.json": ' {"pk": 5,\n "v": {"n": []}}', "d.json": "", "e.json": "[]"}
    for name, text in files.items():
        open(f"{scratch}/{name}", "w").write(text)
    schema = "pk bigint, v struct<n:array<bigint>>"
    got = ST.read_json_records(spark, scratch, schema)
    assert got.columns == ["pk", "v"]
    assert sorted((r.pk, r.v and r.v.n) for r in got.collect()) == [(1, [1, 2]), (3, None), (5, [])]
    rejects = {(os.path.basename(r.path), r.text.replace(" ", "")) for r in ST.json_rejects(spark, scratch, schema).collect()}
    assert rejects == {("a.json", '{"pk":"oops"}'), ("b.json", '[{"pk":4')}
    with pytest.raises(Exception):
        ST.read_json_records(spark, scratch, schema, strict=True).collect()


def test_json_dictionary_over_several_lines(spark, scratch):
    open(f"{scratch}/d.json", "w").write('{\n "Q1": ["Q2", "Devon"],\n "Q3": ["Kent", "Q4"]\n}')
    rows = ST.read_json_dictionary(spark, f"{scratch}/d.json").collect()
    assert sorted(map(tuple, rows)) == [("Q1", "Devon", "Q2"), ("Q3", "Kent", "Q4")]


def test_array_chunks_of_any_size(spark, scratch):
    df = spark.range(1, 251).select(F.col("id").alias("pk"), F.lit('a "q"\n').alias("v")).repartition(5)
    SK.write_fixture_json(df, f"{scratch}/a", "m", chunk_size=200_000, array=True)
    SK.write_fixture_json(df, f"{scratch}/b", "m", chunk_size=100, array=True)
    for folder, sizes in (("a", [250]), ("b", [100, 100, 50])):
        back = [json.load(open(f"{scratch}/{folder}/{f}")) for f in sorted(os.listdir(f"{scratch}/{folder}"))]
        assert [len(b) for b in back] == sizes
        assert [r["pk"] for b in back for r in b] == list(range(1, 251))


def test_cut_titles_are_reported_and_off_by_default(spark, scratch):
    _zip(f"{scratch}/x-alto2txt/metadata/A_metadata.zip", [
        ("a.xml", _doc("0002083", "T", "1850-01-01", "art1", "0002083/1850/0101"))])
    docs = news.read_documents(spark, scratch)
    whole, cut = news.build_tables(spark, docs), news.build_tables(spark, docs, title_cap=4)
    assert [r.title for r in whole["item"].collect()] == ["Art art1"] and whole["rejected_values"].count() == 0
    assert [r.title for r in cut["item"].collect()] == ["Art "]
    assert [(r.field, r.value) for r in cut["rejected_values"].collect()] == [("title", "Art art1")]


def test_quarantined_keys_and_checked_broadcast(spark, monkeypatch):
    facts = spark.createDataFrame([("a",), ("b",), ("",), (None,)], "k string")
    dim = spark.createDataFrame([(1, "a")], "pk int, k string")
    out = resolve.resolve_fk(facts, dim, "k", as_name="id", policy="quarantine", broadcast=True)
    assert sorted((str(r.k), r.id, r.id_error) for r in out.collect()) == [
        ("", None, None), ("None", None, None), ("a", 1, None), ("b", None, "unresolved id")]
    monkeypatch.setattr(resolve, "BROADCAST_BYTES", 0)
    plan = resolve.resolve_fk(facts, dim, "k", as_name="id", broadcast=True)._jdf.queryExecution().analyzed().toString()
    assert "hint" not in plan.lower()
