"""The n-gram join on one large group of near copies, of which each links to few others."""

import random

from relnorm.llm import ngram_jaccard as N
from relnorm.llm.ngram_jaccard import NgramJoin


def brute_components(texts):
    sets = [{tuple(w[k:k + 5]) for k in range(len(w) - 4)} for w in (t.split() for t in texts)]
    label = list(range(len(texts)))

    def find(k):
        while label[k] != k:
            k = label[k]
        return k
    for a in range(len(texts)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                label[y] = x
    return [find(k) for k in range(len(texts))], sets


def drifting(rng, copies, words):
    """Each text is the one before with a word or two replaced; a shared sentence keeps all in one candidate group."""
    text = [f"w{rng.randrange(10 ** 6)}" for _ in range(words)]
    out = []
    for _ in range(copies):
        for _ in range(rng.choice((1, 1, 2, 4))):
            text[rng.randrange(12, words)] = f"w{rng.randrange(10 ** 6)}"
        out.append(" ".join(text))
    return out


def test_a_group_of_near_copies_whose_hub_links_few(spark, monkeypatch):
    rng = random.Random(6)
    texts = drifting(rng, 500, 70) + drifting(rng, 40, 300) + [" ".join(f"x{rng.randrange(40)}" for _ in range(90)) for _ in range(40)]
    want, _ = brute_components(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    rounds = []
    keep = N.NgramJoin._cell_round

    def cell_round(self, left, rejected, quota):
        met = keep(self, left, rejected, quota)
        rounds.append(met.where("b is not null").count())
        return met
    monkeypatch.setattr(N.NgramJoin, "_cell_round", cell_round)
    for limit, per_bin in ((4096, 100_000), (50, 500)):
        rounds.clear()
        got = {r.id: r.component_id for r in NgramJoin(docs, cell_limit=limit, per_bin=per_bin).run().groups().collect()}
        assert [got[k] for k in range(len(texts))] == want
        # as many pairs as would connect what they join, a few times over; the group has 124,750
        assert rounds and sum(rounds) < 60 * len(texts) and len(rounds) < 12


def test_one_stored_set_for_repeated_rows(spark):
    text = " ".join(f"a{k}" for k in range(40))
    docs = spark.createDataFrame([(1, text)] * 30 + [(2, text + " end")] * 30 + [(None, text)] * 3, "doc_id long, text string")
    job = NgramJoin(docs)
    stored = []
    keep = N.staged

    def staged(df, name):
        out = keep(df, name)
        if name == "sets":
            stored.append(out.count())
        return out
    try:
        N.staged = staged
        got = job.run().groups().collect()
    finally:
        N.staged = keep
    assert stored and stored[-1] == 2
    assert sorted(str((r.id, r.component_id)) for r in got) == sorted(
        ["(1, 1)"] * 30 + ["(2, 1)"] * 30 + ["(None, 1)"] * 3)


def test_pairs_of_a_cell_stay_few_and_reach_every_pair(spark):
    """In a cell of entries that all look alike, forests leave first; rejected pairs are not offered again."""
    import numpy as np
    import pyarrow as pa
    n = 60
    parity = pa.array([[0] * N.PARITY_WORDS] * n, pa.list_(pa.int64()))
    base = {"cell": [1] * n, "cls": list(range(100, 100 + n)), "n": [50] * n, "i": [0] * n, "h": [7] * n, "root": list(range(100, 100 + n))}
    rejected, seen = [[] for _ in range(n)], set()
    for turn in range(30):
        table = pa.table({**{k: pa.array(v, pa.int64()) for k, v in base.items()}, "parity": parity,
                          "rejected": pa.array(rejected, pa.list_(pa.int64()))})
        out = N._cell_pairs(80, 1 << turn)(table)
        pairs = set(zip(out.column("a").to_pylist(), out.column("b").to_pylist()))
        alive = {a for a, b in pairs if b is None}
        pairs = {(a, b) for a, b in pairs if b is not None}
        if not pairs:
            assert not alive
            break
        assert {x for pair in pairs for x in pair} <= alive
        assert not pairs & seen and (turn or len(pairs) < 2 * n)
        seen |= pairs
        for a, b in pairs:
            rejected[a - 100].append(b)
            rejected[b - 100].append(a)
    assert len(seen) == n * (n - 1) // 2 and turn < 12
    assert np.all([a < b for a, b in seen])


def words_of(rng, n):
    return [f"z{rng.randrange(10 ** 7)}" for _ in range(n)]


def test_large_unlike_sets_are_told_apart_by_their_sketches(spark, monkeypatch):
    rng = random.Random(3)
    base = words_of(rng, 3000)
    near = base[:2900] + words_of(rng, 60)
    half = base[:1900] + words_of(rng, 1000)
    texts = [" ".join(t) for t in (base, near, half, words_of(rng, 2900), words_of(rng, 700), words_of(rng, 90))]
    job = NgramJoin(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).run()
    name = {r.id: r.cls for r in job.sets.collect()}
    assert {r.id: r.component_id for r in job.groups().collect()} == {0: 0, 1: 0, 2: 2, 3: 3, 4: 4, 5: 5}
    stored, keep = [], N.staged

    def staged(df, table):
        out = keep(df, table)
        if table == "sets":
            stored.append({r.cls for r in out.collect()})
        return out
    monkeypatch.setattr(N, "staged", staged)
    pairs = spark.createDataFrame([tuple(sorted((name[a], name[b]))) for a in range(4) for b in range(a)], "a long, b long")
    found = [tuple(r) for r in job.verified(keep(pairs, "candidates")).collect()]
    assert found == [tuple(sorted((name[0], name[1])))]
    assert stored == [{name[0], name[1]}]  # the whole sets of the others are not sent


def test_long_sketches_bound_the_difference_from_below():
    import numpy as np
    rng = np.random.default_rng(5)
    for n, m, common in ((600, 600, 590), (1000, 1100, 950), (1025, 1020, 1000), (4000, 3500, 3300), (700, 90_000, 600)):
        grams = np.unique(rng.integers(0, 1 << 63, n + m - common, dtype=np.uint64))
        x, y = grams[:n], grams[n - common:]
        differ = N.sketch_difference(N.long_sketch(x), N.long_sketch(y))
        assert 0 <= differ <= len(x) + len(y) - 2 * common
        assert N.sketch_difference(N.long_sketch(x), N.long_sketch(x)) == 0
    assert N.long_sketch(grams[:512]) is None


def test_entries_keep_through_packing():
    import numpy as np
    import pyarrow as pa
    entries = np.zeros(5, N._ENTRY)
    entries["h"] = [1, 1 << 63, 7, 7, (1 << 64) - 1]
    entries["cls"] = [-1, 5, -(1 << 63), 6, 0]
    entries["n"], entries["i"], entries["more"] = [9, 300, 1 << 20, 4, 5], [0, 1, 70_000, 3, 2], [0, 1, 0, 1, 0]
    assert (N._unpacked(N._packed(entries)) == entries).all()
    for place, kept in ((3, [1 << 63, 7, 7]), (-2, entries["h"].tolist())):
        table = pa.table({"bin": pa.array([place], pa.int64()), "payload": pa.array([N._packed(entries)], pa.binary())})
        got = N._shared(table).column("h").to_numpy().view(np.uint64).tolist()
        assert sorted(got) == sorted(kept)


def test_tables_that_are_no_longer_read_are_removed(spark, monkeypatch):
    import os
    from urllib.parse import urlparse
    from relnorm.llm import shared
    rng = random.Random(9)
    texts = drifting(rng, 60, 70)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    names, keep, before = [], N.staged, set(shared._written)

    def staged(df, name):
        names.append(name)
        return keep(df, name)
    monkeypatch.setattr(N, "staged", staged)
    job = NgramJoin(docs).run()
    left = [p for p in shared._written if p not in before]
    assert "dealt" not in names and {"sets", "open", "met"} <= set(names)
    for name in ("sets", "wanted", "open", "met", "unlike"):
        assert not [p for p in left if f"/{name}-" in p]
    folder = os.path.dirname(urlparse(left[0]).path)
    assert {f for f in os.listdir(folder) if f.startswith(("sets-", "open-", "met-"))} <= {os.path.basename(p) for p in before}
    assert len(job.groups().collect()) == len(texts)
