"""Language identification by a byte convolutional network, trained in numpy.

Bytes become symbols (letters without case, bytes of other scripts, one symbol
for the rest), embedded and read by filters of three widths; the maxima over a
fixed-length window feed a softmax.  A text's probabilities are the mean over
all its windows, weighted by their letters.  For scoring, the filters' sums over
pairs of symbols are tabulated once, which gives the same numbers by look-up.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relnorm.llm.arrays import byte_columns, slices
from relnorm.llm.samples import fold

WINDOW = 128
SYMBOLS = 27 + 128
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8

SYMBOL = np.zeros(256, np.int64)
SYMBOL[97:123] = np.arange(1, 27)
SYMBOL[65:91] = np.arange(1, 27)
SYMBOL[128:] = np.arange(27, SYMBOLS)


def windows_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all windows (zero-padded, one row each) and the text each is from; empty texts have none."""
    lens = np.diff(offsets)
    counts = -(-lens // WINDOW)
    first = np.concatenate([[0], np.cumsum(counts)])
    out = np.zeros(first[-1] * WINDOW, np.int64)
    target = np.repeat(first[:-1] * WINDOW - offsets[:-1], lens) + np.arange(len(data))
    out[target] = SYMBOL[data]
    return out.reshape(-1, WINDOW), np.repeat(np.arange(len(lens)), counts)


class Network:
    """Embedding, filters per width, softmax layer."""

    def __init__(self, languages: list[str], seed: int = 1):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.p = {"embed": rng.normal(0, 0.5, (SYMBOLS, EMBEDDING))}
        for w in WIDTHS:
            self.p[f"filter{w}"] = rng.normal(0, (2 / (w * EMBEDDING)) ** 0.5, (w * EMBEDDING, FILTERS))
            self.p[f"shift{w}"] = np.zeros(FILTERS)
        self.p["out"] = rng.normal(0, 0.2, (len(WIDTHS) * FILTERS, len(languages)))
        self.p["bias"] = np.zeros(len(languages))

    def gradients(self, x: np.ndarray, y: np.ndarray) -> dict:
        p, rows = self.p, np.arange(len(x))[:, None]
        embedded = p["embed"][x]
        steps = WINDOW - max(WIDTHS) + 1
        tops, ats = [], []
        for w in WIDTHS:
            seen = np.concatenate([embedded[:, j:j + steps] for j in range(w)], axis=2)
            made = seen @ p[f"filter{w}"]
            at = made.argmax(1)
            tops.append(np.take_along_axis(made, at[:, None], 1)[:, 0] + p[f"shift{w}"])
            ats.append(at)
        hidden = np.maximum(np.concatenate(tops, 1), 0)
        logits = hidden @ p["out"] + p["bias"]
        prob = np.exp(logits - logits.max(1, keepdims=True))
        prob /= prob.sum(1, keepdims=True)
        prob[np.arange(len(x)), y] -= 1
        delta = prob / len(x)
        g = {"out": hidden.T @ delta, "bias": delta.sum(0), "embed": np.zeros_like(p["embed"])}
        down = (delta @ p["out"].T) * (hidden > 0)
        for k, w in enumerate(WIDTHS):
            d, at = down[:, k * FILTERS:(k + 1) * FILTERS], ats[k]
            symbols = np.stack([x[rows, at + j] for j in range(w)], 2)           # rows, filters, w
            seen = p["embed"][symbols].reshape(len(x), FILTERS, w * EMBEDDING)
            g[f"filter{w}"] = np.einsum("bf,bfk->kf", d, seen)
            g[f"shift{w}"] = d.sum(0)
            back = (d[:, :, None] * p[f"filter{w}"].T[None]).reshape(len(x), FILTERS, w, EMBEDDING)
            np.add.at(g["embed"], symbols, back)
        return g

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int, batch: int = 64, rate: float = 0.01) -> None:
        """Adam over shuffled batches; deterministic for the same rows in the same order."""
        rng = np.random.default_rng(5)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        step, total = 0, epochs * -(-len(x) // batch)
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for k in range(0, len(x), batch):
                step += 1
                for name, g in self.gradients(x[order[k:k + batch]], y[order[k:k + batch]]).items():
                    first[name] = 0.9 * first[name] + 0.1 * g
                    second[name] = 0.999 * second[name] + 0.001 * g * g
                    pace = rate * (1 - 0.9 * step / total)
                    self.p[name] -= pace * (first[name] / (1 - 0.9 ** step)) / (
                        np.sqrt(second[name] / (1 - 0.999 ** step)) + 1e-8)

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Filter sums over the symbol pairs at t, t+1 and at t+2, t+3."""
        part = {(w, j): self.p["embed"] @ self.p[f"filter{w}"][j * EMBEDDING:(j + 1) * EMBEDDING]
                for w in WIDTHS for j in range(w)}
        pair = lambda a, b: (a[:, None] + b[None]).reshape(-1, FILTERS)
        near = np.hstack([pair(part[w, 0], part[w, 1]) for w in WIDTHS])
        nothing = np.zeros_like(part[3, 2])
        far = np.hstack([pair(part[3, 2], nothing), pair(part[4, 2], part[4, 3])])
        return near.astype(np.float32), far.astype(np.float32)


def _predict(network: Network):
    near, far = network.tables()
    shift = np.concatenate([network.p[f"shift{w}"] for w in WIDTHS]).astype(np.float32)
    out, bias, languages = network.p["out"], network.p["bias"], network.languages
    steps = WINDOW - max(WIDTHS) + 1
    schema = pa.schema([("id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def probabilities(x: np.ndarray) -> np.ndarray:
        pairs = x[:, :-1] * SYMBOLS + x[:, 1:]
        made = near[pairs[:, :steps]]
        made[:, :, FILTERS:] += far[pairs[:, 2:2 + steps]]
        logits = np.maximum(made.max(1) + shift, 0) @ out + bias
        prob = np.exp(logits - logits.max(1, keepdims=True))
        return prob / prob.sum(1, keepdims=True)

    def run(parts):
        for part in parts:
            total = np.zeros((part.num_rows, len(languages)))
            for first, last, data, offsets in slices(*byte_columns(part.column(2))):
                x, text = windows_of(data, offsets)
                for k in range(0, len(x), 128):
                    some = x[k:k + 128]
                    weighted = probabilities(some) * (some > 0).sum(1)[:, None]
                    np.add.at(total, first + text[k:k + 128], weighted)
            mass = total.sum(1)
            share = total / np.maximum(mass, 1e-300)[:, None]
            lettered = part.column(3).to_numpy(zero_copy_only=False).astype(bool) & (mass > 0)
            best = share.argmax(1)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1),
                 pa.array([languages[b] if ok else "und" for b, ok in zip(best, lettered)], pa.string()),
                 pa.array(np.where(lettered, share.max(1), 0.0))], schema=schema)
    return run


def _sample_windows(per_text: int):
    """Up to ``per_text`` windows of each sampled text, spread evenly over it."""
    schema = pa.schema([("lang", pa.string()), ("window", pa.binary())])

    def run(parts):
        for part in parts:
            langs = part.column(0).to_pylist()
            rows = []
            for first, last, data, offsets in slices(*byte_columns(part.column(1))):
                x, text = windows_of(data, offsets)
                for k in range(last - first):
                    lo, hi = np.searchsorted(text, [k, k + 1])
                    take = np.unique(np.linspace(lo, hi - 1, min(per_text, hi - lo)).astype(int)) if hi > lo else []
                    rows += [(langs[first + k], x[j].astype(np.uint8).tobytes()) for j in take if (x[j] > 0).sum() > 8]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()),
                                              pa.array([r[1] for r in rows], pa.binary())], schema=schema)
    return run


def train_language_network(docs: DataFrame, most_rows: int = 4000, per_text: int = 3, epochs: int = 5,
                           id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Network | None:
    """The network fitted on at most ``most_rows`` texts with a language; None without any.

    The rows with the smallest hashes of their ids serve: the hashes alone are
    ordered, then the texts below the last one are read.
    """
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.xxhash64(id_col).alias("k"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    cut = rows.select("k").orderBy("k").limit(most_rows).agg(F.max("k")).first()[0]
    if cut is None:
        return None
    chosen = rows.where(F.col("k") <= cut).select("lang", "text").limit(most_rows)
    got = chosen.mapInArrow(_sample_windows(per_text), "lang string, window binary").toArrow()
    rows = sorted(zip(got.column(0).to_pylist(), got.column(1).to_pylist()))
    if not rows:
        return None
    languages = sorted({r[0] for r in rows})
    network = Network(languages)
    x = np.frombuffer(b"".join(r[1] for r in rows), np.uint8).reshape(-1, WINDOW).astype(np.int64)
    network.train(x, np.array([languages.index(r[0]) for r in rows]), epochs)
    return network


def identify_languages(docs: DataFrame, folds: int = 4, held_out: int = 2, most_rows: int = 4000,
                       id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per document: id, held_out, lang_pred, score.

    Learned from at most ``most_rows`` documents outside the held-out fold.  A
    null text or one without a letter is ``und`` with score 0, and so is every
    text if no document has a language.  Repeated rows are judged one by one;
    rows with a null id count as fold 0.  An empty table gives no rows.
    """
    aside = fold(id_col, folds) == held_out
    network = train_language_network(
        docs.where(F.col(id_col).isNotNull() & ~aside).select(id_col, text_col, lang_col), most_rows,
        id_col=id_col, text_col=text_col, lang_col=lang_col)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), aside.alias("held_out"), F.col(text_col).alias("text"),
                       F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("lettered"))
    if network is None:
        return rows.select(F.col("id").alias(id_col), "held_out", F.lit("und").alias("lang_pred"),
                           F.lit(0.0).alias("score"))
    return rows.mapInArrow(_predict(network), "id long, held_out boolean, lang_pred string, score double"
                           ).withColumnRenamed("id", id_col)
