"""Spelling variants, centroid clusters and SimHash groups against brute force."""

import collections
import hashlib
import math
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
import xxhash

from relnorm.llm import centroids as C
from relnorm.llm import simhash as S
from relnorm.llm import spelling as W
from relnorm.llm.dealing import cells, join_class
from relnorm.llm.shared import staged

LOWER = {c: c + 32 for c in range(65, 91)}
EXTRA = "id long, key string, n string, v string, cell long, bin long, word long, cluster string"


def frame(spark, rows, schema):
    """Rows with further columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, 1, "k", "n", "v", 2, 3, 4, "c") for r in rows], f"{schema}, {EXTRA}")


# ---------------------------------------------------------------- spelling variants

def brute_variants(rows, least=6, occurrences=5, every=199, factor=5):
    counts = collections.Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += len(run) >= least
    n = {w: k for w, k in counts.items() if k >= occurrences and len(w) >= least}

    def edit(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))

    near = {w: [x for x in n if edit(w, x)] for w in n}
    form = {}
    for w, some in near.items():
        best = min(some, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= factor * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return sorted((w, n[w], len(near[w]), form[w] or "", n.get(form[w], -1), root(w)) for w in n)


def variants(docs, **options):
    return sorted((r.word, r.n, r.n_near, r.form or "", -1 if r.form_n is None else r.form_n, r.root)
                  for r in W.spelling_variants(docs, **options).collect())


@pytest.fixture(scope="module")
def spelled():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcÀéÿ÷×Z") for _ in range(rng.choice((5, 6, 7, 7, 9)))) for _ in range(60)]
    rows = []
    for k in range(220):
        some = []
        for _ in range(rng.randrange(90)):
            word = rng.choice(words[:rng.choice((3, 20, 60))])
            word = word[:-1] + "bc" if rng.random() < .1 else word
            if rng.random() < .3:
                at = rng.randrange(len(word))
                word = word[:at] + rng.choice(("", "a", "é", word[at] + "b")) + word[at + 1:]
            some.append(word)
        rows.append((rng.choice([None, *range(90)]), rng.choice((" ", "-", "7", "ā")).join(some)))
    return rows + [(1, None), (2, ""), (3, " \n"), (4, "ß" * 7 + " " + "q" * 3000)] * 6 + rows[:3] * 2


def test_spelling_variants(spark, spelled):
    want = brute_variants(spelled)
    assert len(want) > 100 and sum(r[3] != "" for r in want) > 20
    docs = frame(spark, spelled, "doc_id long, text string")
    assert variants(docs) == want
    # long keys are cut into blocks, bins hold few entries
    assert variants(docs, limit=8, per_bin=64) == want
    every = brute_variants(spelled, every=3)
    assert variants(docs, every=3) == every
    assert variants(frame(spark, [], "doc_id long, text string")) == []


def test_long_texts_are_counted_in_pieces(monkeypatch):
    monkeypatch.setattr(W, "PIECE_BYTES", 50)
    rng = random.Random(1)
    text = "".join(rng.choice("abcdefgÀé  .") for _ in range(5000)) + "x" * 300
    for every in (199, 2):
        got = W.document_words(7, text.encode(), 6, every)
        want = collections.Counter()
        for run in re.findall("[A-Za-zÀ-ÿ]+", text):
            h = zlib.crc32(f"7:{run}".encode())
            run = run[:h % len(run)] + run[h % len(run) + 1:] if h % every == 0 else run
            if len(run) >= 6:
                want[run] += 1
        assert {w.decode(): n for w, n in got.items()} == want


def test_flushed_words_add_up(spark, spelled, monkeypatch):
    monkeypatch.setattr(W, "HELD_BYTES", 500)
    docs = frame(spark, spelled, "doc_id long, text string")
    assert {r.word: r.n for r in W.vocabulary(docs).collect()} == {r[0]: r[1] for r in brute_variants(spelled)}


# ---------------------------------------------------------------- centroid clusters

def brute_clusters(rows, size, k=8, rounds=10):
    kept = [(i, [math.floor(Fraction(x) * 1024) for x in v]) for i, v in rows
            if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    start = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    centroids = [v for _, v in start]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        members = collections.defaultdict(list)
        for _, v in kept:
            members[nearest(v)[1]].append(v)
        for j, some in members.items():
            centroids[j] = [sum(x) // len(some) for x in zip(*some)]
    found = [(i, *nearest(v)) for i, v in kept]
    inertia = collections.Counter()
    for _, d, j in found:
        inertia[j] += d
    long_ = lambda x: x if x < 2 ** 63 else None
    return sorted(((i, j, long_(d), long_(inertia[j]), long_(sum(inertia.values())), ",".join(map(str, centroids[j])))
                   for i, d, j in found), key=str)


def clusters(table, size):
    rows = C.centroid_clusters(table, size=size).collect()
    return sorted(((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, ",".join(r.centroid)) for r in rows),
                  key=str)


def test_centroid_clusters(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, 1, 2, 3, *range(4, 60)]),
             [rng.choice([0.0, -0.5, 1.25, rng.uniform(-9, 9)]) for _ in range(5)]) for _ in range(300)]
    rows += [(70, [1.0] * 4), (71, None), (72, [1.0] * 4 + [None]), (73, [math.nan] * 5), (74, [math.inf] * 5),
             (75, [0.1] * 5), (75, [0.1] * 5), (76, []), (77, [-0.0, 1e-300, -1e-300, 0.0, 0.0])] + [(78, [2.0] * 5)] * 200
    schema = "vec_id long, embedding array<double>"
    for some in (rows, rows[:3], rows + [(80, [1e30, -1e30, 3.0, 4.0, 1e200])], []):
        assert clusters(frame(spark, some, schema), 5) == brute_clusters(some, 5)
    without_ids = C.centroid_clusters(frame(spark, [(None, [1.0] * 5)], schema), size=5).collect()
    assert [tuple(r) for r in without_ids] == [(None, None, None, None, None, None)]


def test_nearest_settles_ties_and_stops_early():
    rng = np.random.default_rng(2)
    for k, size, high in ((1, 3, 4), (8, 2, 3), (8, 64, 900), (20, 6, 5)):
        vectors, centers = rng.integers(-high, high, (400, size)), rng.integers(-high, high, (k, size))
        distance = ((vectors[:, None] - centers[None]) ** 2).sum(2)
        number, best = C.nearest(vectors, centers)
        assert (number == distance.argmin(1)).all() and (best == distance.min(1)).all()
    # far centroids are left out as soon as the bound of the frontier is beyond the best distance
    far = np.array([[0, 0], [10 ** 6, 10 ** 6], [10 ** 6 + 1, -10 ** 6]])
    number, best = C.nearest(np.array([[1, 1]]), far)
    assert number.tolist() == [0] and best.tolist() == [2]


# ---------------------------------------------------------------- SimHash groups

def brute_fingerprint(text, width=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(words[k:k + width]) for k in range(len(words) - width + 1)] or [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_parts(values, bits=3):
    """The smallest index reachable from each value."""
    label = list(range(len(values)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x
    for a in range(len(values)):
        for b in range(a):
            if (values[a] ^ values[b]).bit_count() <= bits:
                x, y = sorted((find(a), find(b)))
                label[y] = x
    return [find(a) for a in range(len(values))]


def test_simhash_groups(spark):
    rng = random.Random(9)
    words = [f"w{k}" for k in range(40)] + ["É", "don't", "\x1fz"]
    rows = [(k, " ".join(rng.choice(words) for _ in range(rng.randrange(60)))) for k in range(60)]
    for k in range(60, 120):
        some = rows[rng.randrange(6)][1].split(" ")
        if some:
            some[rng.randrange(len(some))] = rng.choice(words)
        rows.append((k, "\t\n ".join(some).upper()))
    rows += [(200, None), (201, ""), (202, " \n"), (203, "one"), (204, "ONE"), (205, "one two"), (None, rows[3][1]),
             (None, "nobody else has this"), (7, rows[7][1]), (7, rows[7][1]), (206, "a " * 30_000)]
    values = [brute_fingerprint(t) for _, t in rows]
    parts = brute_parts(values)
    least = collections.defaultdict(lambda: None)
    for p, (i, _) in zip(parts, rows):
        if i is not None:
            least[p] = i if least[p] is None else min(least[p], i)
    want = sorted(((i, f"{v:016x}", least[p]) for p, v, (i, _) in zip(parts, values, rows)), key=str)
    docs = frame(spark, rows, "doc_id long, text string")
    for options in ({}, {"limit": 3, "per_bin": 40}):
        assert sorted(map(tuple, S.simhash_groups(docs, **options).collect()), key=str) == want
    assert S.simhash_groups(frame(spark, [], "doc_id long, text string")).collect() == []


def test_fingerprints_of_long_texts_in_pieces(monkeypatch):
    monkeypatch.setattr(S, "PIECE_BYTES", 40)
    rng = random.Random(1)
    for n in (0, 1, 2, 3, 4, 500):
        text = " ".join("".join(rng.choice("abÉ") for _ in range(rng.randrange(1, 60))) for _ in range(n))
        assert S.fingerprint(text.encode()) == brute_fingerprint(text)


def test_links_connect_a_dense_group_of_near_fingerprints(spark):
    rng = random.Random(1)
    base = [rng.getrandbits(64) for _ in range(3)]
    values = list({b ^ sum({1 << rng.randrange(64) for _ in range(rng.randrange(9))}) for b in base for _ in range(500)})
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    table = staged(spark.createDataFrame([(v,) for v in signed], "fingerprint long"), "fingerprints")
    place = {v: k for k, v in enumerate(signed)}
    for bits in (3, 1):
        want = brute_parts(values, bits)
        for limit in (20, 4096):
            forest = S.Forest(len(values))
            links = [(place[u], place[v]) for u, v in S.fingerprint_links(table, bits, limit, 2000).collect()]
            forest.unite(*np.array(links, np.int64).reshape(-1, 2).T)
            assert forest.label.tolist() == want
            assert len(links) <= 40 * len(values)  # a forest per bin, not all pairs of the group


# ---------------------------------------------------------------- dealing

def test_cells_let_all_entries_of_a_key_meet_in_bounded_cells(spark):
    rows = [(1, f"a{k}") for k in range(100)] + [(2, f"b{k}") for k in range(7)] + [(3, "c")]
    met = cells(staged(spark.createDataFrame(rows, "key long, item string"), "entries"), len(rows), "item", 10, 50).collect()
    groups = collections.defaultdict(set)
    for r in met:
        groups[r.bin, r.cell].add(r.item)
    together = {(a, b) for g in groups.values() for a in g for b in g}
    assert all((a, b) in together for x, a in rows for y, b in rows if x == y)
    assert max(map(len, groups.values())) < 60


def test_join_class_keeps_every_row_of_hot_and_rare_keys(spark):
    rows = staged(spark.createDataFrame([(k % 50 if k % 3 else 7, k) for k in range(600)], "key long, row long"), "rows")
    classes = staged(rows.groupBy("key").count().selectExpr("key", "count as n_rows", "key * 10 as name"), "classes")
    for most in (1, 5, 1000):
        got = join_class(rows, classes, "key", most).collect()
        assert sorted((r.row, r.name) for r in got) == sorted((r.row, r.key * 10) for r in rows.collect())
