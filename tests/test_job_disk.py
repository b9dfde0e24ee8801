"""What a job leaves on the disk while it runs: no shuffle files of ended queries, nothing that is read no more."""

import os
import shutil
import zipfile

from pyspark.sql import functions as F

from relnorm import session
from relnorm.operators.keys import dense_key
from relnorm.plans import news
from relnorm.plans.archive_files import write_archives
from relnorm.sinks import fixtures
from tests.test_news_job import _fixture

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}


def _content(spark, out):
    return {name: sorted(map(str, spark.read.json(f"{out}/{name}").collect())) for name in os.listdir(out)}


def test_a_news_run_makes_room_as_it_goes(spark, scratch, monkeypatch):
    mount, out = f"{scratch}/mount", f"{scratch}/out"
    _fixture(mount)
    shutil.copy(f"{mount}/authority.csv", scratch)
    options = dict(authority_csv=f"{scratch}/authority.csv", run_ts="2024-01-01", requested=["hmd", "jisc"])
    whole = news.run(spark, mount, f"{scratch}/kept", **options)
    kept, files, before = [], [], _shuffle_files(spark)
    of_documents, write = news.stage_records, fixtures.write_fixture_json
    monkeypatch.setattr(news, "stage_records", lambda *a: kept.append(of_documents(*a)) or kept[-1])

    def watched(df, path, *a, **k):
        # the reports are written, and nothing of the documents or of ended queries is left
        assert {"quarantine", "rejected_values", "report", "collections", "title_matches"} <= set(os.listdir(out))
        assert not any(os.path.exists(f.removeprefix("file://")) for f in files) and _shuffle_files(spark) <= before
        write(df, path, *a, **k)

    def read():
        assert not os.path.exists(out)
        files.extend(kept[0].inputFiles())
        assert files and all(os.path.exists(f.removeprefix("file://")) for f in files)
        shutil.rmtree(mount)

    monkeypatch.setattr(fixtures, "write_fixture_json", watched)
    assert news.run(spark, mount, out, after_reading=read, **options) == whole
    assert not os.path.exists(mount) and _shuffle_files(spark) <= before
    assert _content(spark, out) == _content(spark, f"{scratch}/kept") and spark.conf.get(CLEANUP, None) is None


def test_shuffle_files_go_with_their_query(spark, scratch):
    rows = spark.range(1000).repartition(3, "id")
    before = _shuffle_files(spark)
    kept = rows.groupBy(F.col("id") % 7).count()
    assert len(kept.collect()) == 7 and _shuffle_files(spark) > before
    held = _shuffle_files(spark)
    with session.brief_shuffles(spark):
        with session.brief_shuffles(spark):
            again = rows.groupBy(F.col("id") % 5).count()
            assert len(again.collect()) == 5 and _shuffle_files(spark) <= held
        again.write.parquet(f"{scratch}/t")
        assert spark.read.parquet(f"{scratch}/t").count() == 5 and _shuffle_files(spark) <= held
    assert spark.conf.get(CLEANUP, None) is None


def test_single_staged_tables_are_removed(spark):
    with session.staging(spark):
        a, b = session.stage(spark.range(3)), session.stage(spark.range(4))
        files = [f.removeprefix("file://") for f in a.inputFiles()]
        session.unstage(a, spark.range(1))
        assert files and not any(map(os.path.exists, files)) and b.count() == 4
        keyed = dense_key(spark.range(5).withColumn("v", F.lit("x")), ["id"])
        files = [f.removeprefix("file://") for f in keyed.inputFiles()]
        assert any(map(os.path.exists, files)) and keyed.count() == 5
        session.unstage(keyed)
        assert not any(map(os.path.exists, files))


def test_items_are_linked_before_they_are_written(spark, scratch):
    _fixture(scratch)
    with session.staging(spark):
        first = len(session._staged)
        item = news.build_tables(spark, news.read_documents(spark, scratch))["item"]
        assert "Join" not in item._jdf.queryExecution().optimizedPlan().toString()
        # of the staged tables with items only one is left
        kept = [t for t in session._staged[first:] if "item_code" in spark.read.parquet(t).columns]
        assert len(kept) == 1 and all(f"file://{kept[0]}/" in f for f in item.inputFiles())
        rows = sorted(item.collect(), key=lambda r: r.pk)
        assert [r.pk for r in rows] == [1, 2, 3, 4, 5, 6] and all(r.issue_id and r.ingest_id and r.data_provider_id for r in rows)


def test_bodies_made_after_the_deal_cross_no_shuffle(spark, scratch, monkeypatch):
    frame = type(spark.range(1))
    plans, task = [], frame.mapInArrow
    monkeypatch.setattr(frame, "mapInArrow", lambda df, *a: plans.append(
        df._jdf.queryExecution().optimizedPlan().toString()) or task(df, *a))
    # every row comes twice, and two rows share an entry's name with other bodies
    rows = spark.range(300).select((F.col("id") % 150).alias("k"), (F.col("id") % 2).alias("v"))
    columns = dict(archive=F.format_string("z%02d.zip", F.col("k") % 20), method=F.lit("deflated"),
                   entry=F.format_string("e%03d", 99 - F.floor(F.col("k") / 2)),
                   body=F.concat(F.lit("text "), F.col("v").cast("string")).cast("binary"))
    made = dict(columns, folder=F.lit(f"file:{scratch}/made"))
    plain = rows.select(*[c.alias(n) for n, c in dict(columns, folder=F.lit(f"file:{scratch}/plain")).items()])
    assert write_archives(rows, **made) == write_archives(plain) == 20
    below = [p[p.index("RepartitionByExpression"):].partition("\n")[2] for p in plans]
    assert "text " not in below[0] and "text " in below[1]
    for name in os.listdir(f"{scratch}/plain"):
        with zipfile.ZipFile(f"{scratch}/plain/{name}") as p, zipfile.ZipFile(f"{scratch}/made/{name}") as m:
            assert [(i.filename, i.CRC) for i in p.infolist()] == [(i.filename, i.CRC) for i in m.infolist()]
