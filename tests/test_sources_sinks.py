import json
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from relnorm.operators.audit import UnresolvedError
from relnorm.operators.checks import Checks
from relnorm.plans import fulltext
from relnorm.sinks import fixtures as SK
from relnorm.sinks import incremental as I
from relnorm.sinks.incremental import append_distinct, compact, insert_if_absent, read_store, vacuum
from relnorm.sources import tables as ST
from relnorm.sources.archives import ENTRY_SCHEMA, archive_entries, archive_manifest, plan_splits, read_entries


def _zip(path, entries, method=zipfile.ZIP_DEFLATED):
    with zipfile.ZipFile(path, "w", method) as zf:
        for name, data in entries:
            zf.writestr(name, data)


def test_archive_entries_and_content(spark, scratch):
    _zip(f"{scratch}/a.zip", [(f"d/{i:04d}.txt", f"text {i}\n" * (i % 5)) for i in range(300)])
    _zip(f"{scratch}/b.zip", [("d/x.txt", b"stored"), ("d/y.xml", b"<a/>")], zipfile.ZIP_STORED)
    open(f"{scratch}/loose.txt", "w").write("loose")
    m = archive_manifest(spark, scratch)
    assert "content" not in m.columns and m.count() == 2
    e = archive_entries(spark, scratch)
    assert e.columns == ENTRY_SCHEMA.fieldNames() and e.count() == 302
    assert archive_entries(spark, scratch, suffix=".xml").count() == 1
    c = archive_entries(spark, scratch, loose_glob="*.txt", content=True, split_bytes=2000)
    got = {(os.path.basename(r.archive), r.entry_name.split("/")[-1]): bytes(r.content) for r in c.collect()}
    assert got["a.zip", "0007.txt"] == b"text 7\n" * 2 and got["b.zip", "x.txt"] == b"stored"
    assert got["loose.txt", "loose.txt"] == b"loose" and len(got) == 303
    with pytest.raises(ValueError):
        archive_entries(spark, scratch, convert="nonsense")


def test_splits_follow_bytes():
    """One archive of 1.5 GB and a thousand of 1.5 MB give equal loads."""
    files = [("big", 1_500_000_000, False)] + [(f"s{k:04}", 1_500_000, False) for k in range(1000)]
    splits = plan_splits(files, 64_000_000)
    loads = [sum(high - low for _, _, low, high, _ in s.parts) for s in splits]
    assert sum(loads) == 3_000_000_000 and set(loads[:-1]) == {64_000_000} and loads[-1] <= 64_000_000
    covered = {}
    for s in splits:
        for uri, size, low, high, _ in s.parts:
            assert low == covered.get(uri, 0) and high > low
            covered[uri] = high
    assert covered == {uri: size for uri, size, _ in files}
    loose = plan_splits([("a", 0, False), ("t", 10**9, True), ("b", 5, False)], 100)
    assert sorted(p[0] for s in loose for p in s.parts) == ["a", "b", "t"]
    assert plan_splits([], 100)[0].parts == []


def test_every_entry_is_read_once_whatever_the_splits(spark, scratch):
    _zip(f"{scratch}/a.zip", [(f"{i}.bin", os.urandom(5000)) for i in range(40)], zipfile.ZIP_STORED)
    for k in range(5):
        _zip(f"{scratch}/s{k}.zip", [("x.bin", bytes([k]) * 700)])
    for split in (1, 3000, 50_000, 1 << 30):
        e = archive_entries(spark, scratch, split_bytes=split) if split > 1 else archive_entries(spark, scratch, split_bytes=9000)
        assert e.count() == 45
    e = archive_entries(spark, scratch, split_bytes=20_000).withColumn("error_code", F.lit(7))
    got = read_entries(e, keep=["archive_size", "error_code"])
    rows = got.collect()
    assert len(rows) == 45 and got.rdd.getNumPartitions() > 8
    assert {r.error_code for r in rows} == {7}
    assert {r.archive_size for r in rows if len(r.content) == 5000} == {os.path.getsize(f"{scratch}/a.zip")}


def test_fulltext_first_archive_wins_and_keys(spark, scratch):
    _zip(f"{scratch}/0001-test_plaintext.zip", [("p/1904/0707/a.txt", "first\r\nline"),
                                                 ("p/1904/0707/b.txt", b"\xff\xfe bad")])
    _zip(f"{scratch}/0002-test_plaintext.zip", [("p/1904/0707/a.txt", "second"),
                                                 ("p/1898/0204/c.txt", "third")])
    with open(f"{scratch}/loose.txt", "w") as fh:
        fh.write("loose text")
    t = fulltext.fulltext_table(spark, scratch, initial_pk=5)
    rows = {r.path.split("/")[-1]: r for r in t.collect()}
    assert sorted(r.pk for r in rows.values()) == [5, 6, 7, 8]
    assert rows["a.txt"].text == "first\nline" and rows["a.txt"].compressed_path.endswith("0001-test_plaintext.zip")
    assert rows["b.txt"].text == "" and rows["b.txt"].errors
    assert rows["loose.txt"].compressed_path is None and rows["loose.txt"].pk == 8
    assert rows["a.txt"].pk == 5 and rows["c.txt"].pk == 7


def test_fulltext_job_writes_errors_and_leaves_nothing_staged(spark, scratch):
    from relnorm.session import checkpoint_dir
    before = set(os.listdir(checkpoint_dir(spark)))
    os.makedirs(f"{scratch}/in")
    _zip(f"{scratch}/in/1.zip", [("p/a.txt", "first"), ("p/b.txt", b"\xff bad")])
    open(f"{scratch}/in/2.zip", "wb").write(b"no archive")
    open(f"{scratch}/in/loose.txt", "w").write("loose")
    counts = fulltext.run(spark, f"{scratch}/in", f"{scratch}/out", initial_pk=5, max_records_per_file=2, compression="gzip")
    assert counts == {"fulltext": 3, "unreadable_archives": 1}
    assert sorted(os.listdir(f"{scratch}/out/fulltext")) == ["fulltext-000001.jsonl.gz", "fulltext-000002.jsonl.gz"]
    back = {r.pk: r.fields for r in spark.read.json(f"{scratch}/out/fulltext").collect()}
    assert sorted(back) == [5, 6, 7] and back[5].text == "first" and back[6].errors and back[7].text == "loose"
    bad = spark.read.json(f"{scratch}/out/unreadable_archives").collect()
    assert [(os.path.basename(r.archive), r.error) for r in bad] == [("2.zip", "unreadable archive")]
    assert set(os.listdir(checkpoint_dir(spark))) == before


def test_fixture_json_chunks(spark, scratch):
    df = spark.range(1, 251).select(F.col("id").alias("pk"), (F.col("id") * 2).alias("v"))
    SK.write_fixture_json(df, f"{scratch}/j", "Test.Model", chunk_size=100)
    # no folder per chunk, no empty trailing file
    assert sorted(os.listdir(f"{scratch}/j")) == ["j-000001.jsonl", "j-000002.jsonl", "j-000003.jsonl"]
    back = spark.read.json(f"{scratch}/j")
    assert back.count() == 250 and back.select("model").distinct().first().model == "test.model"
    SK.write_fixture_json(df, f"{scratch}/a", "m", chunk_size=100, array=True, prefix="x")
    assert sorted(os.listdir(f"{scratch}/a")) == [f"x-00000{k}.json" for k in (1, 2, 3)]
    assert spark.read.option("multiLine", "true").json(f"{scratch}/a").count() == 250
    far = spark.createDataFrame([(9_999_901,), (99_999_901,), (100_000_001,), (1,)], "pk long").withColumn("v", F.lit(1))
    SK.write_fixture_json(far, f"{scratch}/far", "m", chunk_size=100)
    assert sorted(os.listdir(f"{scratch}/far")) == [f"far-{n}.jsonl" for n in ("000001", "100000", "1000000", "1000001")]


def test_many_chunks_make_many_files_and_no_folders(spark, scratch):
    df = spark.range(1, 5001).select(F.col("id").alias("pk"), F.lit("x").alias("v"))
    SK.write_fixture_csv(df, f"{scratch}/c", chunk_size=2)
    names = os.listdir(f"{scratch}/c")
    assert len(names) == 2500 and all(os.path.isfile(f"{scratch}/c/{n}") for n in names)
    assert open(f"{scratch}/c/c-002500.csv").read() == "pk,v\n4999,x\n5000,x\n"


def test_a_failed_write_leaves_the_old_files_and_nothing_else(spark, scratch):
    good = spark.range(1, 11).select(F.col("id").alias("pk"), F.lit("old").alias("v"))
    SK.write_fixture_json(good, f"{scratch}/t", "m", chunk_size=5)
    bad = spark.range(1, 101).select(F.col("id").alias("pk"), F.when(F.col("id") == 77, F.raise_error(F.lit("boom"))).otherwise("new").alias("v"))
    with pytest.raises(Exception, match="boom"):
        SK.write_fixture_json(bad, f"{scratch}/t", "m", chunk_size=5)
    with pytest.raises(FileExistsError):
        SK.write_fixture_json(good, f"{scratch}/t", "m", mode="error")
    assert os.listdir(scratch) == ["t"] and sorted(os.listdir(f"{scratch}/t")) == ["t-000001.jsonl", "t-000002.jsonl"]
    assert {r.fields.v for r in spark.read.json(f"{scratch}/t").collect()} == {"old"}


def test_strict_keys_stop_publication_without_a_second_run(spark, scratch):
    from relnorm.operators.resolve import resolve_fk
    seen = spark.sparkContext.accumulator(0)
    facts = spark.createDataFrame([(1, "a"), (2, "zz"), (3, None)], "pk long, code string")
    facts = facts.rdd.map(lambda r: (seen.add(1), r)[1]).toDF("pk long, code string")
    dim = spark.createDataFrame([(10, "a")], "pk long, code string")
    checks = Checks()
    out = resolve_fk(facts, dim, "code", as_name="fk", policy="strict", checks=checks.part("t"))
    with pytest.raises(UnresolvedError, match="unresolved fk: 1 row.*zz"):
        SK.write_fixture_json(checks.count(out, "t"), f"{scratch}/t", "m", gate=checks.part("t").verify)
    assert os.listdir(scratch) == [] and seen.value == 3
    assert checks.counts() == {"t": 3} and [f[:2] for f in checks.found()] == [("unresolved fk", 1)]
    checks = Checks()
    out = resolve_fk(facts, dim, "code", as_name="fk", checks=checks.part("t"))
    SK.write_fixture_json(out, f"{scratch}/t", "m", gate=checks.part("t").verify)
    assert os.listdir(scratch) == ["t"]


def test_insert_if_absent_idempotent(spark, scratch):
    store = f"{scratch}/store"
    df = spark.range(10).select(F.when(F.col("id") > 0, F.col("id")).alias("k"), F.lit("x").alias("v"))
    assert insert_if_absent(spark, df.filter("k < 5 or k is null"), store, ["k"], pk="pk") == 0
    assert insert_if_absent(spark, df, store, ["k"], pk="pk") == 5
    versions = os.listdir(f"{store}/_manifest")
    assert insert_if_absent(spark, df.withColumn("v", F.lit("y")), store, ["k"], pk="pk") == 10
    assert os.listdir(f"{store}/_manifest") == versions  # nothing new, nothing written
    got = {r.k: (r.pk, r.v) for r in read_store(spark, store).collect()}
    assert got == {k or None: (k + 1, "x") for k in range(10)}   # the NULL key is stored once
    with pytest.raises(ValueError):
        insert_if_absent(spark, df, store, ["v"], pk="pk")


def test_store_reads_touched_buckets_only_and_keys_only(spark, scratch):
    store = f"{scratch}/store"
    rows = spark.range(2000).select(F.col("id").alias("k"), F.concat(F.lit("v"), "id").alias("v"))
    insert_if_absent(spark, rows.filter("k % 2 = 0"), store, ["k"], buckets=16)
    m = I._manifest(I._Folder(spark, store))
    few = I.stage(rows.filter("k in (10, 11, 5000)"))
    maybe = I.possibly_stored(spark, store, few, ["k"], m.buckets, m.commits)
    assert {r.k for r in maybe.collect()} == {10}   # the filter rules 11 out
    assert I.possibly_stored(spark, store, rows.selectExpr("k + 10000 as k", "v"), ["k"], 16, m.commits).count() == 0
    absent = I.absent_rows(spark, store, m, few)
    plan = absent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan and {r.k for r in absent.collect()} == {11}
    assert not any("v:string" in line and "_s0" in line for line in plan.splitlines())


def test_a_crash_before_the_swap_changes_nothing(spark, scratch, monkeypatch):
    store = f"{scratch}/store"
    rows = spark.range(20).select(F.col("id").alias("k"))
    insert_if_absent(spark, rows.filter("k < 5"), store, ["k"], pk="pk", buckets=4)

    def crash(self, name, text):
        raise KeyboardInterrupt
    with monkeypatch.context() as patch:
        patch.setattr(I._Folder, "put", crash)
        with pytest.raises(KeyboardInterrupt):
            insert_if_absent(spark, rows, store, ["k"], pk="pk")
    assert read_store(spark, store).count() == 5
    insert_if_absent(spark, rows, store, ["k"], pk="pk")
    assert sorted((r.k, r.pk) for r in read_store(spark, store).collect()) == [(k, k + 1) for k in range(20)]
    assert len(vacuum(spark, store)) == 3 and vacuum(spark, store) == []
    compact(spark, store)
    assert len(I._manifest(I._Folder(spark, store)).commits) == 1
    assert insert_if_absent(spark, rows, store, ["k"], pk="pk") == 20
    assert read_store(spark, store).agg(F.count("k"), F.max("pk")).first() == (20, 20)


def test_append_distinct_compares_nulls_equal(spark, scratch):
    store = f"{scratch}/store"
    rows = spark.createDataFrame([(1, None), (1, "a"), (None, "a"), (1, "a"), (None, None)], "a int, b string")
    for _ in range(2):
        append_distinct(spark, rows, store, buckets=4)
    got = read_store(spark, store)
    assert got.columns == ["a", "b"] and sorted(map(str, map(tuple, got.collect()))) == sorted(
        ["(1, None)", "(1, 'a')", "(None, 'a')", "(None, None)"])


# ---------------------------------------------------------------- large JSON arrays and quoted CSVs

def _texts(rng, letters):
    return "".join(rng.choice(letters) for _ in range(rng.randrange(25)))


def test_json_arrays_are_split_over_tasks(spark, scratch):
    import random
    rng = random.Random(2)
    letters = 'ab"\\\n[]{},é: '
    records = [{"pk": i, "v": {"t": _texts(rng, letters), "l": [_texts(rng, letters)] * 2}} for i in range(150)]
    json.dump(records[:120], open(f"{scratch}/a.json", "w"), indent=1, ensure_ascii=False)
    json.dump(records[120:], open(f"{scratch}/b.json", "w"))
    open(f"{scratch}/c.json", "w").write(json.dumps({"pk": 900, "v": None}))
    open(f"{scratch}/d.json", "w").write(" [] \n")
    schema = "pk bigint, v struct<t:string,l:array<string>>"
    want = sorted((r["pk"], r["v"]["t"], r["v"]["l"][0]) for r in records) + [(900, None, None)]
    for block in (1 << 20, 3000, 301):
        got = ST.read_json_records(spark, scratch, schema, block_bytes=block)
        assert sorted((r.pk, r.v and r.v.t, r.v and r.v.l[0]) for r in got.collect()) == want
        assert ST.json_rejects(spark, scratch, schema, block_bytes=block).count() == 0
    assert got.rdd.getNumPartitions() > 40


def test_a_cut_array_keeps_its_whole_records(spark, scratch):
    text = json.dumps([{"pk": i} for i in range(100)])
    open(f"{scratch}/a.json", "w").write(text[:-5])
    got = ST.read_json_records(spark, scratch, "pk bigint", block_bytes=200)
    assert sorted(r.pk for r in got.collect()) == list(range(99))
    assert [r.text for r in ST.json_rejects(spark, scratch, "pk bigint", block_bytes=200).collect()] == ['{"pk":']


def test_quoted_csvs_are_split_over_tasks(spark, scratch):
    import csv
    import random
    rng = random.Random(3)
    rows = [(str(i), _texts(rng, 'ab",\n é'), _texts(rng, 'ab",\n é')) for i in range(200)]
    for name, some in (("a", rows[:150]), ("b", rows[150:])):
        with open(f"{scratch}/{name}.csv", "w", newline="") as f:
            writer = csv.writer(f, lineterminator="\n")
            writer.writerow(["k", "x", "y"])
            writer.writerows(some)
    # a quote inside an unquoted field: only the plain reader takes this file
    open(f"{scratch}/odd.csv", "w").write("k,x,y\n" + '9000,5" pipe,a\n9001,x,"a\nb"\n' * 30)
    plain = sorted(map(tuple, ST.read_csv(spark, scratch, "k string, x string, y string").collect()), key=str)
    assert len(plain) == 260
    for block in (3000, 151):
        got = ST.read_csv(spark, scratch, "k string, x string, y string", block_bytes=block)
        assert sorted(map(tuple, got.collect()), key=str) == plain
    assert ST.read_csv(spark, scratch, block_bytes=3000).columns == ["k", "x", "y"]


def test_compressed_files_are_not_split(spark, scratch):
    import gzip
    import random
    rng = random.Random(4)
    rows = [(str(i), str(rng.random())) for i in range(500)]
    os.makedirs(f"{scratch}/c")
    with gzip.open(f"{scratch}/c/a.csv.gz", "wt") as f:
        f.write("k,x\n" + "".join(f"{k},{x}\n" for k, x in rows))
    with gzip.open(f"{scratch}/a.json.gz", "wt") as f:
        json.dump([{"k": k, "x": x} for k, x in rows], f)
    assert sorted(map(tuple, ST.read_csv(spark, f"{scratch}/c", "k string, x string", block_bytes=500).collect())) == sorted(rows)
    got = ST.read_json_records(spark, scratch, "k string, x string", glob="*.json.gz", block_bytes=500)
    assert sorted(map(tuple, got.collect())) == sorted(rows)
