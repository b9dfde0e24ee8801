"""Toxicity classifier with counterfactual regularisation.

A logistic model on hashed words and byte 5-grams.  Identity terms in the
labelled texts are swapped for others of their kind; the loss adds the squared
change of the score that a swap causes, so that the mere mention of a group
does not move it.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relnorm.llm.grams import BITS, SCORED, chosen_places, feature_counts, keep_rows, sample_features, score_rows
from relnorm.llm.samples import fold, labelled_sample
from relnorm.llm.shared import release, staged

FEATURES = {"sizes": (5,), "lower": True, "with_words": True}

# Identity terms, in rings; a term is swapped for the next of its ring.
IDENTITY_TERMS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("female", "male"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino"), ("africans", "europeans", "asians"),
    ("gay", "lesbian", "bisexual", "straight"), ("transgender", "cisgender"),
    ("immigrants", "refugees", "natives"), ("old", "young"), ("deaf", "blind", "disabled"),
)


def swap_terms(text: str, rings=IDENTITY_TERMS) -> str:
    """``text`` with every identity term replaced by the next of its ring (case of its first letter kept)."""
    following = {t: ring[(k + 1) % len(ring)] for ring in rings for k, t in enumerate(ring)}

    def swapped(found: re.Match) -> str:
        new = following[found[0].lower()]
        return new.capitalize() if found[0][0].isupper() else new
    return re.sub(r"\b(?:" + "|".join(sorted(following, key=len, reverse=True)) + r")\b", swapped, text, flags=re.I)


class Rows:
    """Sparse 0/1 rows for products with weights."""

    def __init__(self, rows: list[np.ndarray], columns: int):
        self.lens = np.array([len(r) for r in rows], np.int64)
        self.at = np.concatenate(rows) if len(rows) else np.empty(0, np.int64)
        self.row = np.repeat(np.arange(len(rows)), self.lens)
        self.columns = columns

    def dot(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.at], minlength=len(self.lens))

    def back(self, per_row: np.ndarray) -> np.ndarray:
        return np.bincount(self.at, per_row[self.row], minlength=self.columns)


def clearest(total: np.ndarray, hits: np.ndarray, n: int, n1: int, most: int, least: int = 4,
             clear: float = 20.0) -> np.ndarray:
    """At most ``most`` features: the largest chi-square statistics over ``clear``, where ``least`` rows have it.

    ``total`` and ``hits``: how many of ``n`` rows, and of the ``n1`` positive ones, have each feature.
    """
    expected = total * n1 / n
    with np.errstate(divide="ignore", invalid="ignore"):
        chi = (hits - expected) ** 2 / (expected * (1 - total / n) * (1 - n1 / n))
    chi[(total < least) | ~np.isfinite(chi)] = 0
    best = np.argsort(-chi, kind="stable")[:most]
    return np.sort(best[chi[best] > clear])


def informative(rows: list[np.ndarray], positive: np.ndarray, most: int, least: int = 4,
                clear: float = 20.0) -> np.ndarray:
    """``clearest`` of rows that are at hand."""
    total, hits = np.zeros(1 << BITS), np.zeros(1 << BITS)
    for row, p in zip(rows, positive):
        total[row] += 1
        if p:
            hits[row] += 1
    return clearest(total, hits, len(rows), positive.sum(), most, least, clear)


def one_class(n: int, n1: int) -> tuple[np.ndarray, float]:
    """The model of ``n`` rows that are all positive or all negative, or of none."""
    return np.zeros(1 << BITS), 4.0 if n1 else -4.0 if n else 0.0


def fit(labels: np.ndarray, rows: list[np.ndarray], pairs: list[tuple[np.ndarray, np.ndarray]],
        features: int = 4096, ridge: float = 1e-4, fairness: float = 1.0, steps: int = 400):
    """Weights (2 ** BITS) and bias that minimise log loss + ridge + fairness * mean squared change of a swap."""
    positive = labels == "1"
    if positive.all() or not positive.any():
        return one_class(len(labels), int(positive.sum()))
    chosen = informative(rows, positive, features)
    place = np.full(1 << BITS, -1, np.int64)
    place[chosen] = np.arange(len(chosen))
    pick = lambda r: (p := place[r])[p >= 0]
    return descend(positive, [pick(r) for r in rows], [(pick(a), pick(b)) for a, b in pairs], chosen, ridge, fairness,
                   steps)


def descend(positive: np.ndarray, rows: list[np.ndarray], pairs: list[tuple[np.ndarray, np.ndarray]],
            chosen: np.ndarray, ridge: float = 1e-4, fairness: float = 1.0, steps: int = 400):
    """What ``fit`` returns, from rows and pairs of places in ``chosen``.

    Full-batch Adam; deterministic.
    """
    weights = np.zeros(1 << BITS)
    x, a, b = (Rows(some, len(chosen)) for some in (rows, [p[0] for p in pairs], [p[1] for p in pairs]))
    target, n = positive.astype(float), len(rows)
    w, bias = np.zeros(len(chosen)), float(np.log(target.mean() / (1 - target.mean())))
    first, second = np.zeros(len(chosen) + 1), np.zeros(len(chosen) + 1)
    for step in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(x.dot(w) + bias, -50, 50)))
        slope = np.append(x.back(p - target) / n + ridge * w, (p - target).mean())
        if pairs:
            change = a.dot(w) - b.dot(w)
            slope[:-1] += 2 * fairness / len(pairs) * (a.back(change) - b.back(change))
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope ** 2
        move = 0.05 * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
        w, bias = w - move[:-1], bias - move[-1]
    weights[chosen] = w
    return weights, float(bias)


def mentions(sample: DataFrame) -> DataFrame:
    """The sampled texts that mention an identity term, labelled by a number of their own."""
    terms = "|".join(t for ring in IDENTITY_TERMS for t in ring)
    found = sample.where(F.col("text").rlike(rf"(?i)\b({terms})\b"))
    return found.select(F.format_string("%020d", F.monotonically_increasing_id()).alias("label"), "text")


def counterfactual_pairs(sample: DataFrame, options: dict) -> list[tuple[np.ndarray, np.ndarray]]:
    """Features of the sampled texts that mention an identity term, before and after the swap."""
    _, found = sample_features(mentions(sample), options, swap_terms)
    return [(found[k], found[k + 1]) for k in range(0, len(found), 2)]


def fit_model(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, most_rows: int,
              id_col: str, text_col: str, features: int = 4096) -> tuple[np.ndarray, float]:
    """``fit`` on the bounded sample and its swapped texts.

    The features are counted by Spark; only counts, and the places of the chosen ones, reach the driver.
    """
    sample = staged(labelled_sample(docs, labels, label, folds, held_out, most_rows, id_col, text_col), "sample")
    n, n1 = sample.agg(F.count(F.lit(1)), F.count_if(F.col("label") == "1")).first()
    if n1 in (0, n):
        model = one_class(n, n1)
    else:
        chosen = clearest(*feature_counts(sample, FEATURES, "1"), n, n1, features)
        names, rows = chosen_places(sample, FEATURES, chosen)
        _, swapped = chosen_places(mentions(sample), FEATURES, chosen, swap_terms)
        model = descend(names == "1", rows, list(zip(swapped[::2], swapped[1::2])), chosen)
    release(sample)
    return model


def toxicity_scores(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 3, held_out: int = 1,
                    threshold: float = 0.7, most_rows: int = 6000, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per document: id, held_out, score, predicted.

    Fitted on at most ``most_rows`` labelled rows outside the held-out fold;
    every whole text is scored, a null or empty one by the bias alone.  Without
    usable labels every score is 0.5, with labels of one class only it is near
    that class.  Repeated rows are scored one by one; rows with a null id count
    as fold 0.  An empty table gives no rows, other columns are not read.
    """
    weights, bias = fit_model(docs, labels, label, folds, held_out, most_rows, id_col, text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), (fold(id_col, folds) == held_out).alias("held_out"),
                       F.col(text_col).alias("text"))
    return rows.mapInArrow(score_rows(weights, bias, 1.0, FEATURES, threshold), SCORED).withColumnRenamed("id", id_col)


def drop_toxic(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 3, held_out: int = 1,
               threshold: float = 0.7, most_rows: int = 6000, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``toxicity_scores`` predicts 0 for, with all their columns; nothing is shuffled."""
    weights, bias = fit_model(docs, labels, label, folds, held_out, most_rows, id_col, text_col)
    keep = keep_rows(weights, bias, 1.0, FEATURES, threshold, docs.columns.index(text_col))
    return docs.mapInArrow(keep, docs.schema)
