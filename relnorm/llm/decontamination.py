"""Benchmark decontamination by a prefix-filtered set join, native throughout.

Each window of a benchmark item is a set of word shingles.  A document that
contains the window contains every shingle of it, so the necessary prefix of
a window, its shingles ordered by rarity in the corpus, is the rarest one.
Documents are joined on that one shingle; a positional and a length bound keep
the places where the window fits; the words there are then compared exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relnorm.llm.shared import staged
from relnorm.llm.words import broadcast_if_small, words


def _shingles(width: int):
    """Array of hashes of ``width`` consecutive words of column ``w``; none if there are fewer words."""
    return F.when(F.size("w") < width, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.size("w") - width + 1), lambda i: F.xxhash64(F.slice("w", i, width))))


def windows(items: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """Distinct windows of all items: window (words), item_ids, wid."""
    w = items.select(F.col(id_col).cast("string").alias("item"), words(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    at = F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))
    return (w.select("item", F.explode(F.transform(at, lambda i: F.slice("w", i, window))).alias("window"))
            .groupBy("window").agg(F.collect_set("item").alias("item_ids"))
            .withColumn("wid", F.xxhash64("window")))


def contamination(docs: DataFrame, items: DataFrame, window: int = 10, shingle: int = 5,
                  id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
                  item_text_col: str = "text", broadcast_rows: int = 500_000) -> DataFrame:
    """One row per document: id, n_words, n_hit, places, items, contaminated.

    ``places`` are the occurrences (start, size in words), ``items`` the sorted
    ids, as strings, of the items that have one.

    A document word is hit when it lies in an occurrence of a window of an
    item: ``window`` consecutive words, or all words of a shorter item.  Null
    and empty texts have no words; items without words have no window; a null
    item id never counts as an item but its words are hit; ids of both tables
    can be of any type.  Repeated rows are judged one by one.  An empty
    benchmark hits nothing; an empty table gives no rows, other columns are
    not read.
    """
    win = staged(windows(items, item_id_col, item_text_col, window), "windows")
    # A window shorter than a shingle is looked up by all its words.
    tokens = win.select("wid", F.size("window").alias("width"), F.posexplode(
        F.when(F.size("window") < shingle, F.array(F.xxhash64("window"))).otherwise(
            F.transform(F.sequence(F.lit(1), F.size("window") - shingle + 1),
                        lambda i: F.xxhash64(F.slice("window", i, shingle))))).alias("at", "token"),
        F.least(F.size("window"), F.lit(shingle)).alias("span"))
    tokens = staged(tokens, "tokens")
    spans = [r[0] for r in tokens.select("span").distinct().collect()]  # at most `shingle` values
    # A row is known by its id and its text, so that rows of one id, or without one, don't gather in one group.
    own = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("digest"), words(F.col(text_col)).alias("w"))
    known = broadcast_if_small(staged(tokens.select("token", "span").distinct(), "known"), broadcast_rows)
    places = None
    for span in sorted(spans) or [shingle]:
        found = own.select(
            "id", "digest", F.size("w").alias("n_words"), F.posexplode(_shingles(span)).alias("pos", "token"))
        found = found.join(known.where(F.col("span") == span).drop("span"), "token")
        places = found if places is None else places.unionByName(found)
    places = staged(places, "places")
    rarity = places.groupBy("token").agg(F.count(F.lit(1)).alias("places"))
    # The rarest token of each window; a token the corpus lacks rules the window out.
    prefix = (tokens.join(rarity, "token", "left").groupBy("wid", "width")
              .agg(F.min(F.struct(F.coalesce("places", F.lit(0)).alias("places"), "token", "at")).alias("first"))
              .where(F.col("first.places") > 0)
              .select("wid", "width", F.col("first.token").alias("token"), F.col("first.at").alias("at")))
    fits = (places.join(prefix, "token")
            .where((F.col("pos") >= F.col("at")) & (F.col("pos") - F.col("at") + F.col("width") <= F.col("n_words")))
            .select("id", "digest", (F.col("pos") - F.col("at")).alias("start"), "wid"))
    texts = win.select("wid", "window", "item_ids")
    candidates = (fits.distinct().join(broadcast_if_small(texts, broadcast_rows), "wid")
                  .groupBy(F.col("id").alias("cid"), F.col("digest").alias("cdigest"))
                  .agg(F.collect_list(F.struct("start", "window", "item_ids")).alias("fits")))
    joined = own.join(candidates, F.col("id").eqNullSafe(F.col("cid")) & (F.col("digest") == F.col("cdigest")), "left")
    hits = F.filter(F.coalesce("fits", F.array().cast("array<struct<start:int,window:array<string>,item_ids:array<string>>>")),
                    lambda c: F.slice("w", c.start + 1, F.size(c.window)) == c.window)
    rows = joined.select("id", F.size("w").alias("n_words"), hits.alias("hits"))
    covered = F.flatten(F.transform("hits", lambda c: F.sequence(c.start, c.start + F.size(c.window) - 1)))
    found_items = F.array_sort(F.transform(F.array_distinct(F.flatten(F.transform("hits", lambda c: c.item_ids))),
                                           lambda i: i))
    places = F.array_sort(F.array_distinct(F.transform(
        "hits", lambda c: F.struct(c.start.alias("start"), F.size(c.window).alias("size")))))
    rows = rows.select("id", F.col("n_words").cast("long"), F.size(F.array_distinct(covered)).cast("long").alias("n_hit"),
                       places.alias("places"), found_items.alias("items"))
    return rows.withColumn("contaminated", F.col("n_hit") > 0).withColumnRenamed("id", id_col)
