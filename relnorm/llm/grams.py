"""Hashed indicator features of whole texts: distinct byte n-grams and words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from relnorm.llm.arrays import LOWER, NON_SPACE, byte_columns, slices, word_hashes

BITS = 18


def _distinct(x: np.ndarray) -> np.ndarray:
    x.sort()
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


def repeat_classes(hashes: np.ndarray, bounds: np.ndarray, distances: int, bits: int) -> np.ndarray:
    """Per text and distance one feature: the class of the share of words equal to the word that far back."""
    words = np.diff(bounds)
    out = np.empty((len(words), distances), np.uint32)
    for k in range(1, distances + 1):
        equal = np.zeros(len(hashes) + 1, np.int64)
        if len(hashes) > k:
            equal[k + 1:] = np.cumsum(hashes[k:] == hashes[:-k])
        start = np.minimum(bounds[:-1] + k, bounds[1:])
        share = (equal[bounds[1:]] - equal[start]) / np.maximum(words, 1)
        out[:, k - 1] = (1 << bits) - 8 * k + np.searchsorted([0.0, 0.01, 0.03, 0.1, 0.3], share, side="left")
    return out


def gram_features(column, sizes: tuple[int, ...], lower: bool, with_words: bool, repeats: int = 0,
                  bits: int = BITS) -> Iterator[np.ndarray]:
    """For each text the sorted distinct numbers of its features, below ``2 ** bits``.

    ``repeats``: also how much each text repeats its words at distances up to this.
    """
    shift = np.uint32(32 - bits)
    for _, _, data, offsets in slices(*byte_columns(column)):
        codes = (LOWER[data] if lower else data).astype(np.uint32)
        rolled = []
        for n in sizes:
            size = max(len(codes) - n + 1, 0)
            acc = np.full(size, n, np.uint32)
            for k in range(n):
                acc = acc * np.uint32(0x01000193) + codes[k:k + size]
            rolled.append((acc * np.uint32(0x9E3779B1)) >> shift)
        if with_words or repeats:
            hashes, bounds = word_hashes(data, offsets, NON_SPACE)
            again = repeat_classes(hashes, bounds, repeats, bits)
            hashes = (hashes >> np.uint64(64 - bits)).astype(np.uint32)
        for row, (lo, hi) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
            parts = [r[lo:max(hi - n + 1, lo)] for n, r in zip(sizes, rolled)]
            if with_words:
                parts.append(hashes[bounds[row]:bounds[row + 1]])
            if repeats:
                parts.append(again[row])
            yield _distinct(np.concatenate(parts))


def _labelled_texts(parts, changed=None):
    """Labels and texts of (label, text) batches, 500 at a time.

    ``changed``: also ``changed(text)`` of each text, after it, labelled ``label-0`` and ``label-1``.
    """
    for part in parts:
        for k in range(0, part.num_rows, 500):
            labels, texts = part.column(0).slice(k, 500), part.column(1).slice(k, 500)
            if changed:
                labels = pa.array([f"{x}-{side}" for x in labels.to_pylist() for side in (0, 1)], pa.string())
                texts = pa.array([t for x in texts.to_pylist() for t in (x, changed(x))], pa.string())
            yield labels, texts


def _collected(sample, features, kind) -> tuple[np.ndarray, list[np.ndarray]]:
    """Labels and arrays of numbers, ``features(texts)``, of a bounded (label, text) sample, in a fixed order."""
    def run(parts):
        for labels, arrays in features(parts):
            yield pa.RecordBatch.from_arrays([labels, pa.array([f.tobytes() for f in arrays], pa.binary())],
                                             names=["label", "features"])

    got = sample.select("label", "text").mapInArrow(run, "label string, features binary").toArrow()
    rows = sorted(zip(got.column(0).to_pylist(), got.column(1).to_pylist()))
    return np.array([r[0] for r in rows], "U64"), [np.frombuffer(r[1], kind) for r in rows]


def sample_features(sample, options: dict, changed=None) -> tuple[np.ndarray, list[np.ndarray]]:
    """Labels and feature arrays of a bounded (label, text) sample, collected; ``changed`` as above."""
    def features(parts):
        return ((labels, gram_features(texts, **options)) for labels, texts in _labelled_texts(parts, changed))
    return _collected(sample, features, np.uint32)


def chosen_places(sample, options: dict, chosen: np.ndarray, changed=None,
                  bits: int = BITS) -> tuple[np.ndarray, list[np.ndarray]]:
    """As ``sample_features``, but with the places in ``chosen`` of the features that are there; all others stay in the tasks."""
    kind = np.min_scalar_type(len(chosen))

    def places(parts):
        place = np.full(1 << bits, -1, np.int64)
        place[chosen] = np.arange(len(chosen))
        for labels, texts in _labelled_texts(parts, changed):
            found = (place[f] for f in gram_features(texts, **options))
            yield labels, (p[p >= 0].astype(kind) for p in found)
    return _collected(sample, places, kind)


def feature_counts(sample, options: dict, label: str, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """For each feature how many texts of a (label, text) sample have it, and how many of those labelled ``label``.

    Tasks add up their rows; one row per feature, ``2 ** bits`` at most, reaches the driver.
    """
    schema = pa.schema([("feature", pa.int32()), ("n", pa.int64()), ("hits", pa.int64())])

    def run(parts):
        total, hits = np.zeros(1 << bits, np.int64), np.zeros(1 << bits, np.int64)
        for labels, texts in _labelled_texts(parts):
            for name, found in zip(labels.to_pylist(), gram_features(texts, **options)):
                total[found] += 1
                if name == label:
                    hits[found] += 1
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used]), pa.array(hits[used])],
                                         schema=schema)

    got = (sample.select("label", "text").mapInArrow(run, "feature int, n long, hits long").groupBy("feature")
           .agg(F.sum("n").cast("int").alias("n"), F.sum("hits").cast("int").alias("hits")).toArrow())
    out = np.zeros((2, 1 << bits))
    at = got.column("feature").to_numpy()
    out[0, at], out[1, at] = got.column("n").to_numpy(), got.column("hits").to_numpy()
    return out[0], out[1]


def score_rows(weights: np.ndarray, bias: float, slope: float, options: dict, threshold: float):
    """A task that scores (id, held_out, text) rows: logistic of ``slope * (sum of weights + bias)``."""
    weights = weights.astype(np.float32)
    schema = pa.schema([("id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])

    def run(parts):
        for part in parts:
            sums = np.fromiter((weights[f].sum(dtype=np.float64) for f in gram_features(part.column(2), **options)),
                               np.float64, part.num_rows)
            scores = 1 / (1 + np.exp(-np.clip(slope * sums + bias, -500, 500)))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))],
                schema=schema)
    return run


SCORED = "id long, held_out boolean, score double, predicted int"


def platt(margins: np.ndarray, positive: np.ndarray, rounds: int = 100) -> tuple[float, float]:
    """Slope and bias of the logistic curve that fits labels to margins, by Newton steps."""
    scale = max(float(np.abs(margins).mean()), 1e-12) if len(margins) else 1.0
    x = np.column_stack([margins / scale, np.ones(len(margins))])
    n1, n0 = positive.sum(), len(positive) - positive.sum()
    target = np.where(positive, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    beta = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -50, 50)))
        hessian = x.T @ (x * (p * (1 - p))[:, None]) + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (p - target) + 1e-3 * (beta - [1.0, 0.0]))
        beta -= step
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0] / scale), float(beta[1])


def keep_rows(weights: np.ndarray, bias: float, slope: float, options: dict, threshold: float, text_at: int):
    """A task that passes on the rows whose score is below the threshold, all columns as they are."""
    weights = weights.astype(np.float32)
    limit = np.log(threshold / (1 - threshold))

    def run(parts):
        for some in (part.slice(k, 1000) for part in parts for k in range(0, part.num_rows, 1000)):
            sums = np.fromiter((weights[f].sum(dtype=np.float64) for f in gram_features(some.column(text_at), **options)),
                               np.float64, some.num_rows)
            yield some.filter(pa.array(slope * sums + bias < limit))
    return run
