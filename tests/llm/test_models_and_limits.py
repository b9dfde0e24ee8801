"""The fitted models against plain formulas, and the limits that must not drop, cut or end anything."""

import numpy as np
import pyarrow as pa
import pytest

from relnorm.llm import hash_arrays as H
from relnorm.llm import kneser_ney as K
from relnorm.llm import language as L
from relnorm.llm import quality as Q
from relnorm.llm import shared
from relnorm.llm import toxicity as T
from relnorm.llm.decontamination import contamination
from relnorm.llm.exact_dedup import exact_dedup
from relnorm.llm.grams import BITS
from relnorm.llm.packing import encoder
from relnorm.llm.queries import tokenizer_path
from relnorm.llm.samples import labelled_sample


def sparse_rows(rng, n, features=40, most=12):
    return [np.unique(rng.integers(0, features, rng.integers(1, most))).astype(np.uint32) for _ in range(n)]


# ---------------------------------------------------------------- op2

def test_toxicity_fit_takes_dense_gradient_steps():
    """A few Adam steps on the dense objective: log loss + ridge + mean squared change under a swap."""
    rng = np.random.default_rng(1)
    rows, pairs = sparse_rows(rng, 200), list(zip(sparse_rows(rng, 30), sparse_rows(rng, 30)))
    labels = np.array([str(int(5 in r or rng.random() < .2)) for r in rows])
    steps, ridge, fairness = 5, 1e-4, 0.7
    weights, bias = T.fit(labels, rows, pairs, ridge=ridge, fairness=fairness, steps=steps)
    chosen = T.informative(rows, labels == "1", 4096)
    assert 0 < len(chosen) < 40 and set(np.flatnonzero(weights)) <= set(chosen.tolist())

    def dense(some):
        out = np.zeros((len(some), 1 << BITS))
        for k, r in enumerate(some):
            out[k, r] = 1
        return out[:, chosen]
    x, a, b = dense(rows), dense([p[0] for p in pairs]), dense([p[1] for p in pairs])
    y = (labels == "1").astype(float)
    w, c = np.zeros(len(chosen)), np.log(y.mean() / (1 - y.mean()))
    m = v = np.zeros(len(chosen) + 1)
    for t in range(1, steps + 1):
        p = 1 / (1 + np.exp(-(x @ w + c)))
        change = (a - b) @ w
        g = np.append(x.T @ (p - y) / len(y) + ridge * w + 2 * fairness / len(pairs) * (a - b).T @ change, (p - y).mean())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = 0.05 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w, c = w - move[:-1], c - move[-1]
    assert np.allclose(weights[chosen], w, atol=1e-9) and abs(bias - c) < 1e-9


def test_neutral_mentions_are_not_called_toxic(spark):
    """Toxic training texts mention a group; the penalty keeps neutral mentions of it below the threshold."""
    import random
    rng = random.Random(3)
    words = [f"w{k}" for k in range(200)]
    group = T.IDENTITY_TERMS[0][0]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    docs, labels = [], []
    for k in range(600):
        toxic = k % 2
        text = prose(12) + (f" {group} are awful scum" if toxic and k % 4 == 1 else " you awful scum" if toxic else "")
        docs.append((k, text))
        labels.append((k, toxic))
    docs += [(1000 + k, f"{prose(12)} {group} {prose(3)}") for k in range(100)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r.doc_id: r.predicted for r in T.toxicity_scores(d, lab).collect()}
    assert sum(got[1000 + k] for k in range(100)) == 0
    assert sum(got[k] for k, t in labels if t) >= 270 and sum(got[k] for k, t in labels if not t) == 0


def test_only_counts_and_chosen_features_of_the_sample_reach_the_driver(spark, monkeypatch):
    """The model is that of the whole sample at the driver, made from a part of its bytes."""
    from pyspark.sql.classic.dataframe import DataFrame

    def sort(self, *by, **how):
        raise AssertionError("a sort by features samples them to the driver")
    rng = np.random.default_rng(8)
    group = T.IDENTITY_TERMS[0][0]
    texts = [" ".join(f"w{j}" for j in rng.integers(0, 40, 400)) + (f" {group}" if k % 5 == 0 else "")
             + (" awful scum" if k % 3 == 0 else "") for k in range(300)] + ["", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(len(texts))], "doc_id long, toxic int")
    sample = T.labelled_sample(docs, labels, "toxic", 3, 1, 6000)
    names, rows = T.sample_features(sample, T.FEATURES)
    want, bias = T.fit(names, rows, T.counterfactual_pairs(sample, T.FEATURES))
    received = []

    def to_arrow(self, plain=DataFrame.toArrow):
        table = plain(self)
        received.append(table.nbytes)
        return table
    monkeypatch.setattr(DataFrame, "toArrow", to_arrow)
    monkeypatch.setattr(T, "labelled_sample", lambda *a: sample)  # it sorts labels alone
    monkeypatch.setattr(DataFrame, "sort", sort)
    monkeypatch.setattr(DataFrame, "orderBy", sort)
    got = T.fit_model(docs, labels, "toxic", 3, 1, 6000, "doc_id", "text")
    assert want.any() and np.allclose(got[0], want, atol=1e-9) and abs(got[1] - bias) < 1e-9
    assert sum(received) < 0.5 * sum(r.nbytes for r in rows)


def test_toxicity_model_of_one_class_or_none(spark):
    docs = spark.createDataFrame([(k, f"text {k}") for k in range(9)], "doc_id long, text string")
    for value, bias in ((1, 4.0), (0, -4.0), (None, 0.0)):
        labels = spark.createDataFrame([(k, value) for k in range(9)], "doc_id long, toxic int")
        weights, got = T.fit_model(docs, labels, "toxic", 3, 1, 6000, "doc_id", "text")
        assert not weights.any() and got == bias


# ---------------------------------------------------------------- op4

def test_quality_model_meets_the_optimality_conditions():
    """At the optimum a row beyond the margin has no dual weight, one inside has all of it."""
    rng = np.random.default_rng(4)
    rows = sparse_rows(rng, 120)
    positive = np.array([3 in r or 7 in r for r in rows]) ^ (rng.random(120) < .1)
    scale, cost = Q.log_count_ratios(rows, positive), 0.05
    weights = Q.dual_coordinate_descent(rows, scale, positive, cost, epochs=3000)
    x = np.zeros((len(rows), 40))
    for k, r in enumerate(rows):
        x[k, r] = scale[r]
    x = np.column_stack([x, np.ones(len(rows))])
    sign = np.where(positive, 1.0, -1.0)
    w = np.append(weights[:40], weights[-1])
    assert not weights[40:-1].any()
    margin = sign * (x @ w)
    # the weights are a combination of the rows with duals in [0, cost]: none beyond, all inside the margin
    inside, beyond = margin < 1 - 2e-3, margin > 1 + 2e-3
    on = ~inside & ~beyond
    rest = w - cost * (sign[inside, None] * x[inside]).sum(0)
    duals, *_ = np.linalg.lstsq((sign[on, None] * x[on]).T, rest, rcond=None) if on.any() else (np.zeros(0), 0)
    assert np.allclose((sign[on, None] * x[on]).T @ duals, rest, atol=1e-3)

    def objective(v):
        return v @ v / 2 + cost * np.maximum(0, 1 - sign * (x @ v)).sum()
    best = objective(w)
    for _ in range(300):  # convex: no direction leads down
        assert objective(w + rng.normal(0, 1, len(w)) * rng.choice((1e-3, 1e-2, 0.1))) > best - 1e-5


# ---------------------------------------------------------------- op8

def test_tabulated_filters_equal_the_plain_convolution():
    rng = np.random.default_rng(5)
    network = L.Network(["a", "b", "c"], seed=3)
    for name in network.p:
        network.p[name] = network.p[name] + rng.normal(0, 0.1, network.p[name].shape)
    texts = ["Hello, Wörld! " * 30, "x", "", None, "été à la plage " * 200, "Привет мир " * 40, "12 34"]
    part = pa.RecordBatch.from_arrays(
        [pa.array(range(len(texts)), pa.int64()), pa.array([False] * len(texts)), pa.array(texts),
         pa.array([bool(t) and any(c.isalpha() for c in t) for t in texts])], names=["id", "held_out", "text", "lettered"])
    got = next(iter(L._predict(network)([part]))).to_pylist()
    for text, row in zip(texts, got):
        symbols = [int(L.SYMBOL[c]) for c in (text or "").encode()]
        total = np.zeros(3)
        for k in range(0, len(symbols), L.WINDOW):
            x = np.array(symbols[k:k + L.WINDOW] + [0] * max(0, k + L.WINDOW - len(symbols)))
            tops = []
            for w in L.WIDTHS:
                made = [np.concatenate([network.p["embed"][x[t + j]] for j in range(w)]) @ network.p[f"filter{w}"]
                        for t in range(L.WINDOW - max(L.WIDTHS) + 1)]
                tops.append(np.maximum(np.max(made, axis=0) + network.p[f"shift{w}"], 0))
            logits = np.concatenate(tops) @ network.p["out"] + network.p["bias"]
            total += np.exp(logits - logits.max()) / np.exp(logits - logits.max()).sum() * (x > 0).sum()
        if not total.any() or not any(c.isalpha() for c in text or ""):
            assert row["lang_pred"] == "und" and row["score"] == 0
        else:
            share = total / total.sum()
            assert row["lang_pred"] == "abc"[share.argmax()] and abs(row["score"] - share.max()) < 1e-4


# ---------------------------------------------------------------- limits

def test_a_sample_has_one_row_per_id(spark):
    docs = spark.createDataFrame([(k, f"t{j}") for k in range(9) for j in range(300)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, j % 2) for k in range(9) for j in range(10)], "doc_id long, quality int")
    rows = labelled_sample(docs, labels, "quality", 7, 6, 2).collect()
    assert len(rows) == 2 and {tuple(r) for r in rows} == {("0", "t0")}


def test_a_missing_file_of_a_range_is_an_error(tmp_path):
    H.write_columns(f"{tmp_path}/a", [np.arange(3, dtype=np.uint64), np.array([5, 6, 7])])
    H.write_columns(f"{tmp_path}/none", [np.empty(0, np.uint64), np.empty(0, np.int64)])
    assert H.read_columns(f"{tmp_path}/a", 2)[1].tolist() == [5, 6, 7]
    assert [len(c) for c in H.read_columns(f"{tmp_path}/none", 2)] == [0, 0]
    with pytest.raises(FileNotFoundError):
        H.read_columns(f"{tmp_path}/b", 2)


def test_staged_folders_have_a_scheme(spark):
    assert shared.folder(spark, "x").startswith("file:/")


def test_ranges_follow_the_input_without_a_cap(spark, monkeypatch):
    size = 10 ** 14

    class Plan:
        def __getattr__(self, name):
            return lambda: size if name == "sizeInBytes" else Plan()
    frame = type("Frame", (), {"_jdf": Plan()})()
    assert shared.bins_for(spark, frame, 8 << 20) == size // (8 << 20)


def test_counts_over_32_bits_add_up(tmp_path):
    words = np.array([3, 9, 12], np.uint64)
    columns = [np.array([5, 3 * 2 ** 32 + 7, 0]), np.array([2 ** 32 - 1, 2 ** 32, 1]), *[np.array([1, 0, 2])] * 3]
    split, narrow = K._narrow(words, columns)
    assert all(c.dtype == np.dtype("<u4") for c in narrow) and len(split) == 6
    payload = b"".join(np.ascontiguousarray(c).tobytes() for c in [split, *narrow])
    table = pa.table({"bin": pa.array([4], pa.int64()), "payload": pa.array([payload], pa.binary())})
    K._merge_words(str(tmp_path))(table)
    stored = H.read_columns(f"{tmp_path}/words-4", 6)
    assert stored[0].tolist() == [3, 9, 12] and [c.tolist() for c in stored[1:]] == [c.tolist() for c in columns]
    assert len(K._narrow(words[:0], [c[:0] for c in columns])[0]) == 0


def test_exact_dedup_of_a_hot_text_without_ids(spark):
    rows = [(None, "hot")] * 400 + [(7, "warm")] * 300 + [(8, "warm"), (None, "warm")] + [(None, None), (1, ""), (1, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    for counters in (1000, 2):
        got = exact_dedup(docs, counters=counters)
        assert "Generate" not in got._jdf.queryExecution().optimizedPlan().toString()
        got = got.collect()
        kept = sorted(str((r.doc_id, r.keep_id, r.group_size)) for r in got if r.kept)
        assert kept == sorted(["(None, None, 400)", "(8, 8, 302)", "(1, 1, 3)"]) and len(got) == len(rows)


def test_contamination_with_string_item_ids_and_rows_without_ids(spark):
    passage = " ".join(f"p{k}" for k in range(14))
    docs = spark.createDataFrame([(None, f"x {passage} y"), (None, "clean words only here"), (None, None), (4, passage),
                                  (4, "other text of the same id")] + [(None, f"text {k}") for k in range(50)],
                                 "doc_id long, text string")
    items = spark.createDataFrame([("b-2", passage), ("a-1", passage + " more"), (None, "zzz")], "item_id string, text string")
    got = contamination(docs, items).collect()
    hits = sorted(str((r.doc_id, r.n_hit, r["items"])) for r in got if r.contaminated)
    assert hits == sorted(["(None, 14, ['a-1', 'b-2'])", "(4, 14, ['a-1', 'b-2'])"]) and len(got) == 55


def test_other_tokenizers_are_refused():
    encoder(tokenizer_path(), 1)
    with pytest.raises(ValueError, match="byte_bpe_50k"):
        encoder(tokenizer_path("byte_bpe_50k.json"), 1)


# ---------------------------------------------------------------- op10

def test_rank_groups_stay_in_arrays_at_the_driver(spark, monkeypatch):
    """Up to size x RANK_GROUPS groups are never a list of rows; their offsets are those of a plain loop."""
    from pyspark.sql.classic.dataframe import DataFrame
    from relnorm.llm import packing
    rng = np.random.default_rng(4)
    groups = [(int(t), int(p), int(rng.integers(1, 9)), int(rng.integers(0, 3)))
              for t in (0, 1, 5, 9) for p in sorted(rng.choice(64, 7, replace=False))]
    table = pa.table({k: pa.array(v, pa.int64()) for k, v in zip(("tail", "part", "rows", "full"), zip(*groups))})
    histogram, offsets, fulls = {}, [], 0
    for tail, part, count, full in groups:
        offsets.append((tail, part, histogram.get(tail, 0), fulls))
        histogram[tail] = histogram.get(tail, 0) + count
        fulls += full
    histogram.pop(0)
    assert packing._histogram(table) == histogram
    assert [tuple(r.values()) for r in packing._offsets(table).to_pylist()] == offsets

    docs = spark.createDataFrame([(k, "word " * (k % 50)) for k in range(200)], "doc_id long, text string")
    none = docs.limit(0)

    def collect(self):
        raise AssertionError("rows are collected as objects")
    with monkeypatch.context() as m:
        m.setattr(DataFrame, "collect", collect)
        pieces, empty = packing.pack(docs, tokenizer_path(), 64), packing.pack(none, tokenizer_path(), 64)
    assert pieces.groupBy("doc_id").count().count() == 200 and empty.count() == 0
