import os
import zipfile

from pyspark.sql import functions as F

from relnorm.plans import news


def _doc(pid, title, date, item_id, sub, software="abbyy/11", location=None, item_type="article",
         ocr="0.5", tool_version="1.0"):
    sw = f"<software>{software}</software>" if software is not None else ""
    loc = f"<location>{location}</location>" if location is not None else ""
    it = f"<item_type>{item_type}</item_type>" if item_type is not None else ""
    return (f"<lwm><process><input_sub_path>{sub}</input_sub_path><xml_flavour>alto</xml_flavour>{sw}"
            f"<mets_namespace>m</mets_namespace><alto_namespace>a</alto_namespace>"
            f"<lwm_tool><name>extract</name><version>{tool_version}</version></lwm_tool></process>"
            f'<publication id="{pid}"><title>{title}</title>{loc}<issue><date>{date}</date>'
            f'<item id="{item_id}"><title>Art {item_id}</title><word_count>12</word_count>'
            f"<ocr_quality_mean>{ocr}</ocr_quality_mean><plain_text_file>{item_id}.txt</plain_text_file>{it}"
            f"</item></issue></publication></lwm>")


def _zip(path, docs):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as zf:
        for name, xml in docs:
            zf.writestr(name, xml)


def _fixture(root):
    _zip(f"{root}/hmd-alto2txt/metadata/0002083_metadata.zip", [
        ("a/0002083_18500101_art0001.xml", _doc("0002083", "The Times.", "1850-01-01", "art0001", "0002083/1850/0101")),
        ("a/0002083_18500101_art0002.xml", _doc("0002083", "The Times.", "1850-01-01", "art0002", "0002083/1850/0101",
                                                software="", item_type=None, ocr="")),
        ("a/0002083_18500102_art0001.xml", _doc("0002083", "Other title", "1850-01-02", "art0001", "0002083/1850/0102")),
        ("a/broken.xml", "<lwm><process>"),
        ("a/badcode.xml", _doc("NCBL7777", "X", "1850-01-01", "art9", "no/code/here")),
        ("a/empty.xml", ""),
    ])
    _zip(f"{root}/jisc-alto2txt/metadata/IPJL_metadata.zip", [
        ("b/1.xml", _doc("", "", "1801-05-05", "art0001", "IPJL/1801/0505/3000123", software="abbyy/11")),
        ("b/2.xml", _doc("", "", "1801-05-06", "art0001", "IPJL/1801/0506/3000123", software="abbyy/12")),
    ])
    _zip(f"{root}/jisc-alto2txt/metadata/BHCH_metadata.zip", [
        ("c/1.xml", _doc("3000777", "", "1790-03-03", "art0001", "BHCH/1790/0303", location="Bath")),
    ])
    with open(f"{root}/authority.csv", "w") as fh:
        fh.write("Newspaper Title,NLP,Abbr,StartD,StartM,StartY,EndD,EndM,EndY\n")
        fh.write('"Ipswich Journal, The",3000123,IPJL,1,Jan,1800,31,Dec.,1802\n')
        fh.write("Bath Herald,3000200,BHCH,1,Jan,1780,31,Dec,1789\n")
        fh.write("Bath Herald,3000201,BHCH,1,Jan,1791,31,Sept,1795\n")


def test_news_tables(spark, scratch):
    _fixture(scratch)
    docs = news.read_documents(spark, scratch)
    authority = news.read_title_authority(spark, f"{scratch}/authority.csv")
    t = news.build_tables(spark, docs, authority, run_ts="2024-01-01 00:00:00.000000+00:00")

    prov = {r["name"]: r for r in t["dataprovider"].collect()}
    assert set(prov) == {"Heritage Made Digital", "Joint Information Systems Committee"}
    assert sorted(r.pk for r in prov.values()) == [1, 2]

    q = {r.error for r in t["quarantine"].collect()}
    assert q == {"malformed document", "publication code look-up failed"}

    papers = {r.publication_code: r for r in t["newspaper"].collect()}
    # first document wins; title cleaned
    assert papers["0002083"].title == "The Times"
    # path-code tier: the authority row for the code, article inverted
    assert papers["3000123"].title == "The Ipswich Journal"
    # no code in path, date outside both intervals -> the abbreviation's sole title
    assert papers["3000777"].title == "Bath Herald"
    assert papers["3000777"].location == "Bath"
    assert sorted(r.pk for r in papers.values()) == [1, 2, 3]

    issues = t["issue"].collect()
    assert len(issues) == 5
    assert {r.issue_code for r in issues} >= {"0002083-18500101", "0002083-18500102", "3000123-18010505"}
    assert all(r.newspaper_id is not None for r in issues)

    dig = t["digitisation"].collect()
    assert sorted(r.software for r in dig) == ["abbyy/11", "abbyy/12"]

    items = t["item"].collect()
    assert len(items) == 6
    assert sorted(r.pk for r in items) == list(range(1, 7))
    assert all(r.issue_id is not None and r.ingest_id is not None and r.data_provider_id is not None
               for r in items)
    no_sw = [r for r in items if r.item_code == "0002083-18500101-art0002"][0]
    assert no_sw.digitisation_id is None and no_sw.item_type is None and no_sw.ocr_quality_mean == 0.0
    assert {r.created_at for r in items} == {"2024-01-01 00:00:00.000000+00:00"}

    rep = {r.archive_name: r for r in t["report"].collect()}
    assert rep["0002083_metadata.zip"].n_documents == 3
    assert rep["IPJL_metadata.zip"].publication_codes == ["3000123"]


def test_title_cascade_tiers(spark):
    auth = spark.createDataFrame(
        [("Alpha Gazette", "0000001", "ALPH", "1800-01-01", "1810-12-31"),
         ("Alpha Times", "0000002", "ALPH", "1811-01-01", "1820-12-31"),
         ("Beta", "0000003", "BETA", "1800-01-01", "1801-01-01"),
         ("Twice", "0000004", "BETA2", "1800-01-01", "1801-01-01"), ("Twice", "0000004", "BETA3", "1800-01-01", "1801-01-01")],
        "title string, publication_code string, abbr string, start_date string, end_date string",
    ).select("title", "publication_code", "abbr", F.to_date("start_date").alias("start_date"),
             F.to_date("end_date").alias("end_date"))
    papers = spark.createDataFrame(
        [("p1", "", "1805-01-01", "x/y", "ALPH"),        # interval
         ("p2", "", "1830-01-01", "x/y", "ALPH"),        # no interval, two titles -> abbreviation
         ("p3", "", "1830-01-01", "x/y", "BETA"),        # sole title
         ("p4", "", "1830-01-01", "x/y", "LSIR"),        # exception
         ("p5", "", "1830-01-01", "x/9999999", "ALPH"),  # path code not in authority -> blank, stop
         ("p6", "Given", "1805-01-01", "x/y", "ALPH"),   # title present
         ("0000002", "", "1830-01-01", "x/y", "ALPH"),   # no interval, but the abbreviation's code
         ("p7", "", None, "x/0000003/y", "ALPH"),        # path code
         ("p8", None, "1830-01-01", "0000004", "ALPH"),  # path code with two rows, no title given
         ("p9", "", "1830-01-01", "x/y", None)],         # nothing to go by
        "publication_code string, title string, issue_date string, input_sub_path string, abbr string")
    matched = news.match_titles(papers, auth)
    assert matched._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1
    got = {r.publication_code: (r.title, r.match_tier) for r in matched.collect()}
    assert got["0000002"] == ("Alpha Times", "abbreviation_code") and got["p7"] == ("Beta", "path_code")
    assert got["p8"] == (None, "path_code") and got["p9"] == (None, None)
    assert got["p1"] == ("Alpha Gazette", "interval")
    assert got["p2"] == ("ALPH", "abbreviation")
    assert got["p3"] == ("Beta", "sole_title")
    assert got["p4"] == ("Leeds Intelligencer", "exception")
    assert got["p5"] == ("", "path_code")
    assert got["p6"] == ("Given", "document")
