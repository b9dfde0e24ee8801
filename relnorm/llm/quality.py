"""Quality classifier: naive Bayes support vectors.

Indicators of byte n-grams, and of how often words repeat, are scaled by the log-count ratio of the two
classes; a linear hinge-loss model is fitted on them by dual coordinate descent
and its margins are turned into probabilities on rows it was not fitted on.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relnorm.llm.grams import BITS, SCORED, platt, sample_features, score_rows
from relnorm.llm.samples import fold, labelled_sample

FEATURES = {"sizes": (1, 2, 3), "lower": False, "with_words": False, "repeats": 4}


def log_count_ratios(rows: list[np.ndarray], positive: np.ndarray, smoothing: float = 1.0) -> np.ndarray:
    """log of the two classes' smoothed shares of each indicator."""
    counts = []
    for side in (True, False):
        total = np.full(1 << BITS, smoothing)
        for row, p in zip(rows, positive):
            if p == side:
                total[row] += 1
        counts.append(total / total.sum())
    return np.log(counts[0] / counts[1])


def dual_coordinate_descent(rows: list[np.ndarray], scale: np.ndarray, positive: np.ndarray, cost: float = 0.01,
                            epochs: int = 12, seed: int = 7) -> np.ndarray:
    """Weights of the L2-regularised hinge-loss model on the scaled indicators; the last one is the bias.

    One dual variable is optimised at a time, kept within [0, cost]; passes
    stop early once no projected gradient is large.
    """
    weights = np.zeros(len(scale) + 1)
    values = [scale[r] for r in rows]
    square = np.array([float(v @ v) + 1 for v in values])
    sign = np.where(positive, 1.0, -1.0)
    alpha = np.zeros(len(rows))
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        worst = 0.0
        for k in order.permutation(len(rows)):
            gradient = sign[k] * (float(values[k] @ weights[rows[k]]) + weights[-1]) - 1
            projected = min(gradient, 0) if alpha[k] == 0 else max(gradient, 0) if alpha[k] == cost else gradient
            worst = max(worst, abs(projected))
            if projected:
                new = min(max(alpha[k] - gradient / square[k], 0.0), cost)
                step = (new - alpha[k]) * sign[k]
                weights[rows[k]] += step * values[k]
                weights[-1] += step
                alpha[k] = new
        if worst < 1e-3:
            break
    return weights


def fit(labels: np.ndarray, rows: list[np.ndarray], cost: float = 0.01, share: float = 0.25):
    """(weights per indicator, bias, slope): of every fourth row the margin calibrates, the rest fit."""
    positive = labels == "1"
    if positive.all() or not positive.any():
        return np.zeros(1 << BITS), 4.0 if positive.any() else -4.0 if len(labels) else 0.0, 1.0
    aside = np.random.default_rng(3).random(len(rows)) < share
    if len(set(positive[~aside])) < 2:
        aside[:] = False
    ratios = log_count_ratios([r for r, a in zip(rows, aside) if not a], positive[~aside])
    raw = dual_coordinate_descent([r for r, a in zip(rows, aside) if not a], ratios, positive[~aside], cost)
    weights = raw[:-1] * ratios
    judged = aside if aside.any() else ~aside
    margins = np.array([weights[r].sum() + raw[-1] for r, j in zip(rows, judged) if j])
    slope, bias = platt(margins, positive[judged])
    return weights, slope * raw[-1] + bias, slope


def quality_scores(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 5, held_out: int = 0,
                   threshold: float = 0.3, most_rows: int = 6000, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """One row per document: id, held_out, score, predicted.

    Fitted on at most ``most_rows`` labelled rows outside the held-out fold;
    every whole text is scored, a null or empty one by the bias alone.  Without
    usable labels every score is 0.5, with labels of one class only it is near
    that class.  Repeated rows are scored one by one; rows with a null id count
    as fold 0.  An empty table gives no rows, other columns are not read.
    """
    weights, bias, slope = fit(*sample_features(
        labelled_sample(docs, labels, label, folds, held_out, most_rows, id_col, text_col), FEATURES))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), (fold(id_col, folds) == held_out).alias("held_out"),
                       F.col(text_col).alias("text"))
    return rows.mapInArrow(score_rows(weights, bias, slope, FEATURES, threshold), SCORED).withColumnRenamed("id", id_col)
