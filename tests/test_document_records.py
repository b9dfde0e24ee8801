import os
import zipfile

from pyspark.sql import functions as F

from relnorm.operators import extract as X
from relnorm.plans import news
from relnorm.plans.archive_files import write_archives
from relnorm.sources.archives import archive_list, archive_manifest
from tests.test_news_job import _doc, _fixture


def _records(spark):
    docs = spark.createDataFrame([
        (1, _doc("0002083", "T.", "1850-01-01", "a1", "x/y", ocr="n/a"), "c"),
        (2, _doc("0002083", "T.", "undated", "a2", "x/y", software=""), "c"),
        (3, "<lwm><process>", "c")], "n int, xml string, collection string")
    return X.with_codes(X.parse_documents(docs)), F.coalesce("parse_error", "code_error")


def test_a_document_is_one_row_with_all_its_records(spark):
    parsed, error = _records(spark)
    records = X.document_records(parsed, error, keep=["n"])
    plan = records._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and plan.count("from_xml") == 1
    assert plan.count("regexp_extract_all") <= 2  # once in the condition, once in the value; not again per code
    rows = {r.n: r for r in records.collect()}
    assert len(rows) == 3 and rows[3].quarantine.error == "malformed document"
    assert not any(rows[3][k] for k in X.KINDS if k != "quarantine")
    assert rows[1].digitisation.software == "abbyy/11" and rows[2].digitisation is None
    assert [tuple(v) for v in rows[1].rejected] == [("ocr_quality_mean", "n/a")]
    for kind in X.KINDS:
        flat = X.fan_out(parsed, error, keep=["n"]).filter(F.col("kind") == kind).select("n", f"{kind}.*")
        wide = X.record_rows(records, kind, ["n"])
        assert sorted(map(str, flat.collect())) == sorted(map(str, wide.collect()))


def test_archives_are_listed_without_opening_them(spark, scratch):
    _fixture(scratch)
    open(f"{scratch}/none.zip", "wb").close()
    os.makedirs(f"{scratch}/.hidden")
    open(f"{scratch}/.hidden/h.zip", "wb").write(b"h")
    names = ["path", "length", "archive_name", "collection"]
    listed = archive_list(spark, scratch).select(*names)
    assert sorted(listed.collect()) == sorted(archive_manifest(spark, scratch).select(*names).collect())
    assert listed.count() == 3


def test_written_entries_are_whole(spark, scratch):
    bodies = {"é/ü.txt": "text é" * 500, "empty": "", "folder/": ""}
    for method in ("stored", "deflated"):
        rows = spark.createDataFrame([(f"file:{scratch}", f"{method}.zip", method, n, b.encode()) for n, b in bodies.items()],
                                     "folder string, archive string, method string, entry string, body binary")
        assert write_archives(rows) == 1
        with zipfile.ZipFile(f"{scratch}/{method}.zip") as z:
            assert z.testzip() is None and z.namelist() == sorted(bodies)
            assert {n: z.read(n).decode() for n in bodies} == bodies
            assert {i.compress_type for i in z.infolist() if not i.is_dir()} == {
                zipfile.ZIP_STORED if method == "stored" else zipfile.ZIP_DEFLATED}


def test_news_records_are_staged_once_a_document(spark, scratch, monkeypatch):
    staged = []
    monkeypatch.setattr(news, "stage", lambda df, **k: staged.append((df.columns, k)) or df)
    _fixture(scratch)
    news.build_tables(spark, news.read_documents(spark, scratch))
    assert set(X.KINDS) <= set(staged[0][0]) and "kind" not in staged[0][0] and not staged[0][1]
