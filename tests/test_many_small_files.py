import os
import zipfile

from pyspark.sql import functions as F

from relnorm.plans.archive_files import write_archives
from relnorm.sinks import fixtures
from relnorm.sources import blocks
from relnorm.sources.archives import SPLIT_BYTES, plan_splits


def test_many_small_files_are_spread_over_splits():
    files = [(f"f{i:05}", 500, i % 2 == 0) for i in range(5000)]
    splits = plan_splits(files, SPLIT_BYTES)
    assert max(len(s.parts) for s in splits) <= 257
    parts = [p for s in splits for p in s.parts]
    assert sorted({p[0] for p in parts}) == [f[0] for f in files]
    for uri, size, loose in files:  # every byte in one part, the loose ones whole
        mine = sorted(p[2:4] for p in parts if p[0] == uri)
        assert mine[0][0] == 0 and mine[-1][1] == size and all(a[1] == b[0] for a, b in zip(mine, mine[1:]))
        assert not loose or len(mine) == 1


def test_archives_are_written_from_sorted_rows(spark, scratch):
    rows = spark.range(700).select(
        F.lit(f"file:{scratch}/a").alias("folder"), F.format_string("z%02d.zip", F.col("id") % 40).alias("archive"),
        F.lit("deflated").alias("method"), F.format_string("e%03d", 999 - F.col("id")).alias("entry"),
        F.col("id").cast("string").cast("binary").alias("body"))
    assert write_archives(rows) == 40
    for i in range(40):
        with zipfile.ZipFile(f"{scratch}/a/z{i:02}.zip") as z:
            assert z.namelist() == sorted(f"e{999 - k:03}" for k in range(i, 700, 40))
            assert all(z.read(n) == str(999 - int(n[1:])).encode() for n in z.namelist())


def test_small_blocks_share_tasks(spark, scratch):
    with open(f"{scratch}/a.json", "w") as out:
        out.write("[" + ",".join('{"a": %d}' % i for i in range(5000)) + "]")
    files = blocks.listed(spark, scratch, "*.json", False)
    records, refused = blocks.split_records(files, "json", block_bytes=100)
    assert not refused and records.count() == 5000
    assert len(records.select(F.spark_partition_id()).distinct().collect()) <= blocks.MIN_TASKS


def test_long_files_are_sorted_in_parts(spark, scratch, monkeypatch):
    monkeypatch.setattr(fixtures, "PART_ROWS", 70)
    df = spark.range(1, 1001).select(F.col("id").alias("pk"), F.concat(F.lit("v"), "id").alias("v")).repartition(5, "v")
    for kind, write in (("json", lambda p: fixtures.write_fixture_json(df, p, "m", chunk_size=300)),
                        ("csv", lambda p: fixtures.write_fixture_csv(df, p, chunk_size=300))):
        write(f"{scratch}/t.{kind}")
        ending = {"json": ".jsonl", "csv": ".csv"}[kind]
        assert sorted(os.listdir(f"{scratch}/t.{kind}")) == [f"t-{i:06}{ending}" for i in range(1, 5)]
        for i in range(4):
            lines = open(f"{scratch}/t.{kind}/t-{i + 1:06}{ending}").read().splitlines()
            keys = range(300 * i + 1, min(300 * i + 300, 1000) + 1)
            assert lines == (["pk,v"] + [f"{k},v{k}" for k in keys] if kind == "csv" else
                             [f'{{"pk":{k},"model":"m","fields":{{"v":"v{k}"}}}}' for k in keys])
    assert sorted(os.listdir(scratch)) == ["t.csv", "t.json"]
