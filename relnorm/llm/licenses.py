"""License scan with a positional rare-token index, native throughout.

Templates are short word sequences, each with a mandatory key phrase.  The
index posts, for every template, the words of its key phrase that are rarest
in the corpus with their place in the template.  A file is looked up by these
words only; each posting names a place where the template would have to start,
the postings of the template's other rare words must agree on that place, and
the key phrase is then compared word by word.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relnorm.llm.words import words


@dataclass(frozen=True)
class Template:
    """``text`` with its mandatory ``phrase`` (consecutive words of it); ``base`` phrases are counted."""
    label: str
    text: str
    phrase: str
    base: bool = False


# The phrases and labels that every scan reports.
BASE = (
    Template("gpl", "gnu general public license", "gnu general public license", True),
    Template("apache", "apache license", "apache license", True),
    Template("cc-by", "cc by", "cc by", True),
    Template("mit", "mit license", "mit license", True),
)

# Further templates, by the usual wording of each notice.
FURTHER = (
    Template("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
             "provided that the following conditions are met", "redistribution and use in source and binary forms"),
    Template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    Template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    Template("gpl-2.0", "this work is licensed under the gnu general public license version 2",
             "gnu general public license version 2"),
    Template("gpl-3.0", "this work is licensed under the gnu general public license version 3",
             "gnu general public license version 3"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without "
             "fee is hereby granted", "permission to use copy modify and or distribute this software"),
    Template("lgpl", "gnu lesser general public license", "gnu lesser general public license"),
    Template("mit-notice", "permission is hereby granted free of charge to any person obtaining a copy of this "
             "software and associated documentation files", "permission is hereby granted free of charge"),
    Template("mit-release", "released under the mit license", "released under the mit license"),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0",
             "mozilla public license"),
    Template("unlicense", "this is free and unencumbered software released into the public domain",
             "free and unencumbered software"),
)

TEMPLATES = BASE + FURTHER


def _strings(items) -> Column:
    return F.array(*[F.lit(i) for i in items])


def document_frequencies(files: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """In how many of ``files`` (column ``w``) each word of the fixed vocabulary occurs."""
    found = files.select(F.explode(F.array_intersect("w", _strings(vocabulary))).alias("word"))
    return {r["word"]: r["n"] for r in found.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}


def license_places(docs: DataFrame, templates=TEMPLATES, keys: int = 2, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Files with their words ``w`` and ``places``: array of (start, template number, agreement).

    ``start`` is where the key phrase starts, ``agreement`` the share of the
    template's words that stand at their place around it.
    """
    files = docs.select(F.col(id_col).alias("id"), words(F.col(text_col)).alias("w"))
    phrases = [t.phrase.split() for t in templates]
    texts = [t.text.split() for t in templates]
    offsets = [next(k for k in range(len(x)) if x[k:k + len(p)] == p) for x, p in zip(texts, phrases)]
    frequency = document_frequencies(files, sorted({w for p in phrases for w in p}))
    postings: dict[str, list[tuple[int, int, str, int]]] = {}
    for number, phrase in enumerate(phrases):
        # The highest-IDF words; of a word that a phrase repeats, its first place serves.
        rare = sorted(range(len(phrase)), key=lambda k: (frequency.get(phrase[k], 0), k))[:keys]
        other = rare[-1]
        postings.setdefault(phrase[rare[0]], []).append((number, rare[0], phrase[other], other))
    index = F.create_map(*[x for word, places in sorted(postings.items()) for x in (
        F.lit(word), F.array(*[F.struct(F.lit(n).alias("t"), F.lit(at).alias("at"), F.lit(w2).alias("w2"),
                                        F.lit(at2).alias("at2")) for n, at, w2, at2 in places]))])
    rare_words = _strings(sorted(postings))
    length = F.size("w")
    phrase_list = F.array(*[_strings(p) for p in phrases])
    text_list = F.array(*[_strings(t) for t in texts])
    offset_list = F.array(*[F.lit(o) for o in offsets])

    def word_at(i: Column) -> Column:  # null outside the file
        return F.when((i >= 0) & (i < length), F.get("w", i))

    def looked_up(i: Column) -> Column:
        """Places that the postings of word ``i`` name, where the second rare word agrees."""
        return F.filter(F.transform(F.col("index")[F.get("w", i)],
                                    lambda p: F.struct((i - p["at"]).alias("start"), p["t"].alias("t"),
                                                       p["w2"].alias("w2"), p["at2"].alias("at2"))),
                        lambda c: (c["start"] >= 0) & (word_at(c["start"] + c["at2"]) == c["w2"]))

    def agreement(c: Column) -> Column:
        text = F.get(text_list, c["t"])
        first = c["start"] - F.get(offset_list, c["t"])
        same = F.filter(F.sequence(F.lit(0), F.size(text) - 1),
                        lambda j: F.coalesce(word_at(first + j) == F.get(text, j), F.lit(False)))
        return F.size(same) / F.size(text)

    hits = F.filter(F.sequence(F.lit(0), length - 1), lambda i: F.array_contains(rare_words, F.get("w", i)))
    named = F.flatten(F.transform(hits, looked_up))
    verified = F.filter(named, lambda c: F.slice("w", c["start"] + 1, F.size(F.get(phrase_list, c["t"])))
                        == F.get(phrase_list, c["t"]))
    places = F.transform(verified, lambda c: F.struct(c["start"].alias("start"), c["t"].alias("t"),
                                                      agreement(c).alias("agreement")))
    empty = F.array().cast("array<struct<start:int,t:int,agreement:double>>")
    return files.withColumn("index", index).select(
        "id", "w", F.when(F.arrays_overlap("w", rare_words), places).otherwise(empty).alias("places"))


def license_scan(docs: DataFrame, templates=TEMPLATES, keys: int = 2, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per file: id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``score`` is the best agreement of a place with its whole template, 0
    without any.  Null and empty texts have no words and no label (empty
    strings, null first and last word).  Repeated rows are judged one by one,
    other columns are not carried, an empty table gives no rows.
    """
    rows = license_places(docs, templates, keys, id_col, text_col)
    base = _strings([t.label for t in templates if t.base])
    labels = _strings([t.label for t in templates])
    numbers = F.array(*[F.lit(k) for k, t in enumerate(templates) if t.base])
    starts = F.transform(F.filter("places", lambda p: F.array_contains(numbers, p["t"])), lambda p: p["start"])
    found = F.array_sort(F.array_distinct(F.transform("places", lambda p: F.get(labels, p["t"]))))
    rows = rows.select("id", F.size("w").cast("long").alias("n_words"), starts.alias("starts"), found.alias("found"),
                       F.array_max(F.transform("places", lambda p: p["agreement"])).alias("best"))
    return rows.select(
        F.col("id").alias(id_col), "n_words", F.size("starts").cast("long").alias("n_base"),
        F.array_min("starts").cast("long").alias("first_word"), F.array_max("starts").cast("long").alias("last_word"),
        F.array_join(F.filter("found", lambda l: F.array_contains(base, l)), ",").alias("base_labels"),
        F.array_join("found", ",").alias("labels"), F.round(F.coalesce("best", F.lit(0.0)), 6).alias("score"))
