import datetime as dt
import random

from pyspark.sql import functions as F

from relnorm.operators.resolve import sole_interval
from relnorm.plans import news


def _day(n):
    return dt.date(1800, 1, 1) + dt.timedelta(days=n)


def test_sole_interval_equals_brute_force(spark):
    rng = random.Random(5)
    rows = [(f"K{rng.randrange(4)}", _day(a), _day(a + rng.randrange(-1, 12)), f"T{i}") for i in range(60)
            for a in [rng.randrange(80)]]
    rows += [rows[0], rows[1], (None, _day(1), _day(90), "no key"), ("K0", None, _day(90), "no start"),
             ("K0", _day(1), None, "no end"), ("K9", _day(5), _day(5), None)]
    points = [(f"K{k}", _day(d)) for k in (0, 1, 2, 3, 7, 9) for d in range(100)] + [("K0", None)]
    expected = set()
    for key, at in points:
        held = [t for k, s, e, t in rows if at and k == key and s and e and s <= at <= e]
        if len(held) == 1:
            expected.add((key, at, held[0]))
    got = sole_interval(spark.createDataFrame(points, "k string, at date"),
                        spark.createDataFrame(rows, "k string, s date, e date, t string"), ["k"], "at", "s", "e", ["t"])
    assert {tuple(r) for r in got.collect()} == expected and len(expected) > 50


def test_title_match_carries_no_lists_of_the_authority(spark):
    """A paper meets rows of fixed width, however many intervals its abbreviation has."""
    n = 300
    authority = spark.range(n).select(
        F.format_string("Title %s", "id").alias("title"), F.format_string("%07d", "id").alias("publication_code"),
        F.lit("AB").alias("abbr"), F.to_date(F.lit("1800-01-01")).alias("start_date"), F.to_date(F.lit("1800-12-31")).alias("end_date"))
    assert not [f for f in news.compile_authority(authority).schema if f.dataType.typeName() in ("array", "map")]
    papers = spark.createDataFrame(
        [(1, "0000007", "", "1800-05-05", "x", "AB"), (2, "9999999", "", "1800-05-05", "x", "AB"),
         (3, "0000007", "", None, "news/0000009/x", "AB"), (4, "0000007", None, "1800-05-05", "x", None),
         (5, "0000007", "", None, "news/8888888/x", None), (6, None, "", None, "x", "LSIR")],
        "n int, publication_code string, title string, issue_date string, input_sub_path string, abbr string")
    got = {r.n: (r.title, r.match_tier) for r in news.match_titles(papers, authority).collect()}
    assert got == {1: ("Title 7", "abbreviation_code"), 2: ("AB", "abbreviation"), 3: ("Title 9", "path_code"),
                   4: (None, None), 5: ("", "path_code"), 6: ("Leeds Intelligencer", "exception")}
