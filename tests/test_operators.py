import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from relnorm import operators as O
from relnorm.operators.audit import UnresolvedError


def _skewed(spark, n=30_000):
    # a third of the rows share one leading key value
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 97).cast("string"))).alias("grp"),
        F.col("id"))


def test_dense_key_matches_row_number_under_skew(spark):
    df = _skewed(spark)
    k = O.dense_key(df, ["grp", "id"])
    ref = df.withColumn("rpk", F.row_number().over(Window.orderBy("grp", "id")))
    j = k.join(ref, ["grp", "id"])
    assert j.filter(F.col("pk") != F.col("rpk")).count() == 0
    assert k.agg(F.min("pk"), F.max("pk"), F.count_distinct("pk")).first() == (1, 30_000, 30_000)


def test_dense_key_independent_of_shuffle_partitions(spark):
    df = _skewed(spark, 5_000)
    results = []
    for n in (1, 7, 200):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        results.append(sorted(tuple(r) for r in O.dense_key(df, ["grp", "id"]).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert results[0] == results[1] == results[2]


def test_dense_key_offset_and_chunks(spark):
    df = spark.range(25).select(F.col("id").alias("x"))
    k = O.dense_key(df, ["x"], start=5)
    rows = k.select("x", "pk", O.chunk_number("pk", 10, initial=5).alias("c")).orderBy("x").collect()
    assert rows[0].pk == 5 and rows[-1].pk == 29
    assert [r.c for r in rows][:11] == [1] * 10 + [2]


def test_keep_first_and_last(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (1, 2, "b"), (2, 5, "z")], "k int, o int, v string")
    assert {tuple(r) for r in O.keep_first(df, ["k"], ["o"]).collect()} == {(1, 1, "a"), (2, 5, "z")}
    assert {tuple(r) for r in O.keep_last(df, ["k"], ["o"]).collect()} == {(1, 3, "c"), (2, 5, "z")}


def test_resolve_strict_raises(spark):
    facts = spark.createDataFrame([(1, "a"), (2, "zz"), (3, None), (4, "")], "id int, code string")
    dim = spark.createDataFrame([(10, "a")], "pk int, code string")
    with pytest.raises(UnresolvedError):
        O.resolve_fk(facts, dim, "code", as_name="fk", policy="strict")
    ok = O.resolve_fk(facts.filter("id <> 2"), dim, "code", as_name="fk", policy="strict")
    assert {r.id: r.fk for r in ok.collect()} == {1: 10, 3: None, 4: None}


def test_resolve_last_wins(spark):
    facts = spark.createDataFrame([(1, "a")], "id int, code string")
    dim = spark.createDataFrame([(10, "a"), (11, "a")], "pk int, code string")
    assert O.resolve_fk(facts, dim, "code", as_name="fk").first().fk == 11


def test_resolve_array_keeps_order_duplicates_and_empty(spark):
    facts = spark.createDataFrame([(1, ["b", "a", "b"]), (2, []), (3, None), (4, ["a", "nope"])],
                                  "id int, xs array<string>")
    dim = spark.createDataFrame([(1, "a"), (2, "b")], "pk int, label string")
    got = {r.id: r.ids for r in O.resolve_array_fk(facts, "xs", dim, "label", as_name="ids").collect()}
    assert got == {1: [2, 1, 2], 2: [], 3: [], 4: [1, None]}


def test_interval_exactly_one(spark):
    auth = spark.createDataFrame([("A", "2000-01-01", "2000-12-31", "x"), ("A", "2000-06-01", "2001-12-31", "y")],
                                 "abbr string, s string, e string, v string").select(
        "abbr", F.to_date("s").alias("s"), F.to_date("e").alias("e"), "v")
    facts = spark.createDataFrame([(1, "A", "2000-02-01"), (2, "A", "2000-07-01"), (3, "A", "2001-07-01"),
                                   (4, "B", "2000-02-01"), (5, "A", "2000-12-31")],
                                  "id int, abbr string, d string").withColumn("d", F.to_date("d"))
    got = {r.id: r.v for r in O.interval_lookup(facts, auth, "abbr", "d", "s", "e", "v").collect()}
    assert got == {1: "x", 2: None, 3: "y", 4: None, 5: None}


def test_snowflake_split_skips_blank(spark):
    df = spark.createDataFrame([(1, "x"), (2, ""), (3, None), (4, "x"), (5, "a")], "id int, seg string")
    fact, dim = O.snowflake_split(df, ["seg"], pk="pk", fk_name="seg_id")
    assert {r.seg: r.pk for r in dim.collect()} == {"a": 1, "x": 2}
    assert {r.id: r.seg_id for r in fact.collect()} == {1: 2, 2: None, 3: None, 4: 2, 5: 1}


def test_dense_key_breaks_ties_the_same_way_for_any_partitioning(spark):
    df = spark.range(400).select((F.col("id") % 5).alias("k"), (F.col("id") % 50).alias("t"), F.col("id").alias("v"))
    keyed = [sorted(tuple(r) for r in O.dense_key(df.repartition(n), ["k"], tiebreak=["t", "v"]).collect()) for n in (2, 7)]
    assert keyed[0] == keyed[1] and [r[3] for r in sorted(keyed[0], key=lambda r: r[:3])] == list(range(1, 401))


def test_text_follows_python_strip_rules(spark):
    from relnorm.functions.text import clean_title, invert_article, renumber_label
    titles = ["The Times.\n", "\u00a0The Times\u2003", "Echo .:", "Echo...", "A:\n", "\x1cB\x1f"]
    got = spark.createDataFrame([(t,) for t in titles], "t string").select(clean_title("t")).collect()
    assert [r[0] for r in got] == [t.rstrip(".").strip().rstrip(":").strip() for t in titles]
    one = spark.createDataFrame([("Times, The", "page " + "9" * 45)], "t string, p string")
    row = one.select(invert_article("t"), renumber_label("p", F.lit(12))).first()
    assert row[0] == "The Times" and row[1] == "page " + "9" * 45


def test_dense_key_refuses_an_order_that_is_not_total(spark, monkeypatch):
    from relnorm.operators import keys
    plans = []

    def stage(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return keep(df)
    keep = keys.stage
    monkeypatch.setattr(keys, "stage", stage)
    df = spark.createDataFrame([(1, "a"), (2, None), (2, None), (3, "b"), (None, "c")], "k int, v string")
    with pytest.raises(keys.NotTotalOrder, match='1 row.*"_ok0":2'):
        O.dense_key(df, ["k"])
    # equal rows can't be told apart anyway
    assert sorted(r.pk for r in O.dense_key(df, ["k", "v"]).collect()) == [1, 2, 3, 4, 5]
    assert all(p.count("Exchange") == 1 for p in plans) and "Window" in plans[0]   # the proof costs no shuffle


def test_late_keep_first_moves_no_payload_of_losers(spark, monkeypatch):
    from relnorm.operators import dedupe
    df = spark.range(5000).select((F.col("id") % 97).alias("k"), (F.col("id") * 7919 % 100).alias("o"),
                                  F.concat(F.lit("p"), F.col("id") % 300).alias("v")).repartition(6)
    want = sorted(map(tuple, O.keep_first(df, ["k"], ["o"]).collect()))
    late = O.keep_first(df, ["k"], ["o"], late=True)
    assert sorted(map(tuple, late.collect())) == want and len(want) == 97
    assert "Exchange hashpartitioning" not in late._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(dedupe, "BITMAP_BYTES", 0)   # too many bitmaps to broadcast
    assert sorted(map(tuple, O.keep_first(df.union(df), ["k"], ["o"], late=True).collect())) == want
    last = sorted(map(tuple, O.keep_last(df, ["k"], ["o"]).collect()))
    assert sorted(map(tuple, O.keep_last(df, ["k"], ["o"], late=True).collect())) == last
    assert O.keep_first(df.limit(0), ["k"], ["o"], late=True).collect() == []


def test_intervals_meet_their_points_in_bins(spark):
    """A key with many intervals and many points makes candidates near its matches."""
    import datetime as dt
    import random
    from relnorm.operators.resolve import interval_candidates
    rng, first = random.Random(1), dt.date(1800, 1, 1)
    spans = [(rng.choice("AAB"), rng.randrange(4000), rng.choice((0, 1, 5, 100, 900, -3))) for _ in range(150)]
    spans = [(k, first + dt.timedelta(days=s), first + dt.timedelta(days=s + n), f"t{i}") for i, (k, s, n) in enumerate(spans)]
    points = [(i, rng.choice("ABC"), first + dt.timedelta(days=rng.randrange(-10, 5000))) for i in range(600)]
    a = spark.createDataFrame(spans + [("A", None, first, "n"), ("A", first, None, "n")], "k string, s date, e date, t string")
    p = spark.createDataFrame(points + [(900, "A", None)], "i int, k string, d date")
    got = {r.i: r.t for r in O.interval_lookup(p, a, "k", "d", "s", "e", "t").collect()}
    found = {i: [t for k2, s, e, t in spans if k2 == k and s <= d <= e] for i, k, d in points}
    assert got == {**{i: m[0] if len(m) == 1 else None for i, m in found.items()}, 900: None}
    many = spark.range(3000).select(F.lit("A").alias("k"), F.expr("date_add(date'1800-01-01', cast(id * 3 as int))").alias("d"))
    spans = many.select("k", F.col("d").alias("s"), F.date_add("d", 2).alias("e"), F.lit("t").alias("t"))
    cand = interval_candidates(many, spans, [("k", "k")], "d", "s", "e", ["t"])
    plan = cand._jdf.queryExecution().executedPlan().toString()
    assert cand.count() == 3000 and "_il_bin" in plan and "NestedLoop" not in plan


def test_slug_transliterates(spark):
    from relnorm.functions.text import slug
    words = ["Ærøskøbing, Straße", "L'Éclair — Œuvre", "Łódź Ñandú 1,000,000", "e\u0301te\u0301", "Жук 7", None]
    got = spark.createDataFrame([(w,) for w in words], "w string").select(slug("w")).collect()
    assert [r[0] for r in got] == ["aeroskobing-strasse", "l-eclair-oeuvre", "lodz-nandu-1000000", "ete", "7", None]


def test_checkpoint_folder_must_be_set_on_a_cluster():
    from types import SimpleNamespace
    from relnorm.session import checkpoint_dir
    context = SimpleNamespace(master="spark://host:7077", getConf=lambda: {}, getCheckpointDir=lambda: None)
    session = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda k, d=None: d))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(session)
