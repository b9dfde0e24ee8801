"""Operators of relnorm.llm against brute force on small tables with nulls, empties, ties and repeated rows."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from relnorm.llm import toxicity as tox
from relnorm.llm.components import components
from relnorm.llm.decontamination import contamination
from relnorm.llm.exact_dedup import exact_dedup, misra_gries
from relnorm.llm.kneser_ney import lm_scores
from relnorm.llm.language import identify_languages
from relnorm.llm.licenses import license_scan
from relnorm.llm.ngram_jaccard import near_duplicates
from relnorm.llm.packing import encoder, pack, pack_histogram
from relnorm.llm.quality import quality_scores
from relnorm.llm.queries import tokenizer_path
from relnorm.llm.suffix_array import adjacent_prefixes, suffix_array, words_at
from relnorm.llm.suffix_dedup import remove_repeats

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, cls string, h long, n long, id long, label string"


def frame(spark, rows):
    """Documents with further columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "en", "x", 1, 2, 3, "y") for i, t in rows], SCHEMA)


def prose(rng, words, vocabulary):
    return " ".join(rng.choice(vocabulary) for _ in range(words))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    vocabulary = [f"w{k}" for k in range(900)] + ["Straße", "ÉTÉ", "don't", "x-y", "\x1fz"]
    out = [(k, prose(rng, rng.randint(0, 160), vocabulary)) for k in range(60)]
    for k in range(60, 90):  # copies with few and with many edits
        words = out[rng.randrange(12)][1].split(" ")
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        out.append((k, " ".join(words)))
    passage = prose(rng, 40, vocabulary)
    out += [(k, f"{prose(rng, 30, vocabulary)} {passage} {prose(rng, 20, vocabulary)}") for k in range(90, 100)]
    out += [(100, None), (101, ""), (102, " \n"), (103, "one"), (104, "one"), (105, "a " * 400), (106, "a " * 390),
            (107, out[3][1]), (107, out[3][1]), (None, out[5][1]), (None, None), (108, "the " + "long " * 6000)]
    return out


def test_suffix_array_orders_all_suffixes_to_the_depth():
    rng = np.random.default_rng(1)
    for n, letters in ((0, 2), (1, 2), (40, 2), (400, 3), (900, 1), (700, 200)):
        text = rng.integers(0, letters, n).astype(np.uint8)
        raw = text.tobytes()
        order = suffix_array(text, 24)
        assert sorted(order.tolist()) == list(range(n))
        prefixes = [raw[k:k + 24].ljust(24, b"\0") for k in order]
        assert prefixes == sorted(prefixes)
        common = adjacent_prefixes(words_at(text), order, 24)
        for k in range(1, n):
            a, b = (raw[order[j]:].ljust(24, b"\0")[:24] for j in (k - 1, k))
            assert common[k] == next((j for j in range(24) if a[j] != b[j]), 24)


def test_remove_repeats(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab é") for _ in range(rng.randint(0, 200))) for _ in range(40)]
    texts += ["a" * 300, "a" * 120, "", None, texts[0] + "b" * 70 + texts[1], texts[0][:60] + "\0" * 55 + texts[2]]
    texts += [f"{rng.random()}{texts[k][10:150]}{rng.random()}" for k in range(20)]
    docs = [(k * 3 % 100, t) for k, t in enumerate(texts)] + [(5, texts[0]), (5, texts[0]), (None, texts[1]), (None, texts[1])]
    least = {}
    blobs = [((10**9 if i is None else i), (t or "").encode()) for i, t in docs]
    for i, b in blobs:
        for k in range(len(b) - 49):
            least[b[k:k + 50]] = min(least.get(b[k:k + 50], i), i)
    want = []
    for (i, _), (rank, b) in zip(docs, blobs):
        gone = set()
        for k in range(len(b) - 49):
            if least[b[k:k + 50]] < rank:
                gone.update(range(k, k + 50))
        spans = sorted((k, next(e for e in range(k, len(b) + 1) if e not in gone)) for k in gone if k - 1 not in gone)
        want.append((str(i), len(b), spans, bytes(c for k, c in enumerate(b) if k not in gone)))
    got = remove_repeats(frame(spark, docs).repartition(3)).collect()
    got = [(str(r["doc_id"]), r["n_bytes"], [tuple(s) for s in r["spans"]], bytes(r["kept"])) for r in got]
    assert sorted(got) == sorted(want)


def test_exact_dedup(spark, rows):
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    got = exact_dedup(frame(spark, rows), counters=4).collect()
    assert len(got) == len(rows)
    for r in got:
        text = next(t for t in groups if hashlib.sha256(t.encode()).hexdigest() == r["text_sha256"])
        ids = [i for i in groups[text] if i is not None]
        assert r["keep_id"] == (max(ids) if ids else None) and r["group_size"] == len(groups[text])
    kept = collections.Counter(r["text_sha256"] for r in got if r["kept"])
    assert len(kept) == len(groups) and set(kept.values()) == {1}


def test_misra_gries_keeps_every_frequent_digest():
    import pyarrow as pa
    rng = random.Random(3)
    items = [b"hot"] * 400 + [b"warm"] * 200 + [str(k).encode() for k in range(600)]
    rng.shuffle(items)
    parts = [pa.RecordBatch.from_arrays([pa.array(items[k:k + 50])], ["digest"]) for k in range(0, len(items), 50)]
    out = {r["digest"]: r["n"] for b in misra_gries(9)(iter(parts)) for r in b.to_pylist()}
    assert len(out) <= 9 and 400 - 120 <= out[b"hot"] <= 400 and 200 - 120 <= out[b"warm"] <= 200


def test_near_duplicates(spark, rows):
    sets = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        sets.append({tuple(w[k:k + 5]) for k in range(max(len(w) - 4, 1))} if w else set())
    label = list(range(len(rows)))

    def find(k):
        while label[k] != k:
            k = label[k]
        return k
    for a in range(len(rows)):
        for b in range(a):
            same = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * same >= 80 * len(sets[a] | sets[b]):
                label[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    want = sorted((str(i), len(sets[k]), str(least.get(find(k)) if sets[k] else i)) for k, (i, _) in enumerate(rows))
    got = near_duplicates(frame(spark, rows).repartition(5)).collect()
    assert sorted((str(r[0]), r[1], str(r[2])) for r in got) == want


def test_near_duplicates_of_an_input_cut_differently_by_every_scan(spark, scratch):
    """Each scan deals the rows to its two tasks in another way, as a scan does when executors come or go."""
    import os
    import pyarrow as pa
    rng = random.Random(11)
    texts = [prose(rng, 60, [f"v{k}" for k in range(5000)]) for _ in range(6)]
    docs = [(100 * copy + k, text + " end" * copy) for copy in (0, 1) for k, text in enumerate(texts)]

    def scan(parts):
        task = next(iter(parts)).column(0)[0].as_py()
        turn = len([f for f in os.listdir(scratch) if f.startswith(f"{task}-")])
        open(f"{scratch}/{task}-{turn}", "w").close()
        mine = [d for d in docs if (d[0] // 100 if turn % 2 else d[0] % 2) == task]
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in mine], pa.int64()), pa.array([d[1] for d in mine])],
                                         ["doc_id", "text"])
    moving = spark.range(0, 2, 1, 2).mapInArrow(scan, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(moving).collect()}
    assert got == {i: i % 100 for i, _ in docs}


def test_components_of_a_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(30)] + [(100, k) for k in range(101, 130)]
    got = {r["u"]: r["v"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{k: 0 for k in range(1, 31)}, **{k: 100 for k in range(101, 130)}}


def word_list(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def test_contamination(spark, rows):
    items = [(1, " ".join(rows[4][1].split(" ")[3:25])), (2, "w1 w2"), (12, rows[7][1]), (3, ""), (4, None), (None, "one"),
             (5, rows[92][1][60:200]), (5, rows[92][1][60:200])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    windows = collections.defaultdict(set)
    for i, t in items:
        w = word_list(t)
        for k in range(max(len(w) - 9, 1) if w else 0):
            windows[tuple(w[k:k + 10])].add(i)
    want = []
    for i, t in rows:
        w, hit, found = word_list(t), set(), set()
        for x, ids in windows.items():
            for k in range(len(w) - len(x) + 1):
                if tuple(w[k:k + len(x)]) == x:
                    hit.update(range(k, k + len(x)))
                    found |= ids
        want.append((str(i), len(w), len(hit), sorted(str(f) for f in found if f is not None), bool(hit)))
    got = contamination(frame(spark, rows), bench).collect()
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], list(r["items"]), r["contaminated"]) for r in got) == sorted(want)
    assert contamination(frame(spark, rows), bench.limit(0)).where("contaminated").count() == 0


def test_license_scan(spark):
    texts = ["Released under the MIT License.", "CC BY cc by-nc 4.0", None, "", "the Apache License, Version 2.0",
             "This work is licensed under the GNU General Public License, version 3.", "mit der license", "apache Licénse",
             "license mit license apache license apache license", "word " * 3000 + "mit license"]
    docs = [(k, t) for k, t in enumerate(texts)] + [(0, texts[0]), (None, texts[1])]
    got = license_scan(frame(spark, docs)).collect()
    phrases = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
    want = []
    for i, t in docs:
        w = word_list(t)
        at = [(k, label) for p, label in phrases.items() for k in range(len(w)) if w[k:k + len(p.split())] == p.split()]
        want.append((str(i), len(w), len(at), str(min(at)[0] if at else None), str(max(at)[0] if at else None),
                     ",".join(sorted({a[1] for a in at}))))
    assert sorted((str(r[0]), r[1], r[2], str(r[3]), str(r[4]), r[5]) for r in got) == sorted(want)
    labels = {r["doc_id"]: r["labels"] for r in got}
    assert labels[0] == "mit,mit-release" and labels[4] == "apache,apache-2.0" and labels[5] == "gpl,gpl-3.0"
    assert labels[1] == "cc-by,cc-by-nc" and all(0 <= r["score"] <= 1 for r in got)


def test_packing(spark, rows):
    from tokenizers import Tokenizer
    odd = [(200, "I'm 12,345 <|endoftext|> ok"), (201, "İstanbul ﬁ é Ως x\x1cy"), (202, "ÀÉ ß don't!!"), (203, "a\x85b 　 c")]
    docs = rows + odd
    tokenizer = Tokenizer.from_file(tokenizer_path())
    want = collections.Counter((str(i), tuple(tokenizer.encode(t or "", add_special_tokens=False).ids + [1])) for i, t in docs)
    pieces = pack(frame(spark, docs), tokenizer_path(), size=64).collect()
    texts, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in pieces:
        assert len(r["ids"]) == 4 * r["length"] > 0
        texts[str(r["doc_id"])].append((r["start"], tuple(np.frombuffer(r["ids"], "<u4").tolist())))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert sum(r["length"] for r in pieces) == sum(len(k[1]) * n for k, n in want.items())
    for (i, ids), n in want.items():
        if n == 1 and sum(k[0] == i for k in want) == 1:
            assert tuple(x for _, piece in sorted(texts[i]) for x in piece) == ids
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64


def test_encoder_agrees_with_the_tokenizer():
    from tokenizers import Tokenizer
    tokenizer, rng = Tokenizer.from_file(tokenizer_path()), random.Random(5)
    encode = encoder(tokenizer_path(), 1, cached_bytes=12_000)
    for _ in range(400):
        text = "".join(rng.choice(" \n\t'sdtmrelv.,!1290aAbéÉßñ\x00\x7f|<> ́中") for _ in range(rng.randint(0, 40)))
        assert np.frombuffer(encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids + [1]


def test_pack_histogram_places_every_length():
    rng = random.Random(6)
    for histogram in ({}, {700: 10_000}, {5: 3}, {k: rng.randint(1, 90) for k in range(1, 100)}):
        patterns = pack_histogram(histogram, 1000)
        placed = collections.Counter()
        for count, lengths in patterns:
            assert count > 0 and sum(lengths) <= 1000
            for length in lengths:
                placed[length] += count
        assert placed == collections.Counter(histogram)
    assert sum(c for c, _ in pack_histogram({10: 1000}, 1000)) == 10


def test_lm_scores(spark, rows):
    got = lm_scores(frame(spark, rows).repartition(3)).collect()
    token = {k: re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)) + ["</s>"] for k, (_, t) in enumerate(rows)}
    held = [i is None or zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows]
    count, pairs = collections.Counter(), collections.Counter()
    for k, t in token.items():
        if not held[k]:
            count.update(t)
            pairs.update(zip(["<s>"] + t[:-1], t))
    total, kinds, size, seen = sum(count.values()), collections.Counter(), collections.Counter(), collections.defaultdict(lambda: [0] * 4)
    for (u, v), c in pairs.items():
        kinds[v] += 1
        size[u] += c
        seen[u][min(c, 3)] += 1

    def cuts(values):
        n = collections.Counter(values)
        y = n[1] / (n[1] + 2 * n[2])
        return [0] + [min(max(k - (k + 1) * y * n[k + 1] / n[k], 0.05), k) for k in (1, 2, 3)]
    d, e = cuts(pairs.values()), cuts(kinds.values())
    new = sum(e[min(v, 3)] for v in kinds.values()) / len(pairs)

    def low(v):
        return max(kinds[v] - e[min(kinds[v], 3)], 0) / len(pairs) + new / (len(count) + 1)

    def p(u, v):
        if not size[u]:
            return low(v)
        c = pairs.get((u, v), 0)
        return (max(c - d[min(c, 3)], 0) + sum(d[k] * seen[u][k] for k in (1, 2, 3)) * low(v)) / size[u]
    assert abs(sum(p("w1", v) for v in [*count, "<new>"]) - 1) < 1e-9
    want = collections.defaultdict(list)
    for k, t in token.items():
        want[str(rows[k][0])].append((held[k], len(t), sum(count[x] > 0 for x in t), total,
                                      sum(math.log10((count[x] + 0.1) / (total + 0.1 * (len(count) + 1))) for x in t),
                                      sum(math.log10(p(u, v)) for u, v in zip(["<s>"] + t[:-1], t))))
    assert len(got) == len(rows)
    for r in got:
        assert any(tuple(r)[1:5] == w[:4] and abs(r["base_score"] - w[4]) < 1e-6 and abs(r["score"] - w[5]) < 1e-6
                   for w in want[str(r["doc_id"])])


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(8)
    good, bad = [f"word{k}" for k in range(200)], ["vile", "idiot", "scum"]
    docs, labels = [], []
    for k in range(400):
        toxic, low = rng.random() < 0.3, rng.random() < 0.3
        text = prose(rng, 40, good)
        if toxic:
            text = f"{text} {rng.choice(bad)} {rng.choice(bad)} {text[:50]}" + (" women" if rng.random() < 0.7 else "")
        if low:
            text = text.upper().replace(" ", "!! ")
        docs.append((k, text))
        labels.append((k, int(not low), int(toxic)))
    docs += [(900, None), (901, ""), (None, "vile"), (3, docs[3][1])]
    return frame(spark, docs), spark.createDataFrame(labels + [(None, 1, 1), (7777, 1, None)], "doc_id long, quality int, toxic int")


def accuracy(scores, labels, label):
    both = scores.join(labels.where(f"{label} is not null"), "doc_id").where("held_out")
    return both.agg(F.avg((F.col("predicted") == F.col(label)).cast("int"))).first()[0]


def test_classifiers_on_held_out_rows(labelled):
    docs, labels = labelled
    for scores, label in ((tox.toxicity_scores(docs, labels), "toxic"), (quality_scores(docs, labels), "quality")):
        assert scores.count() == docs.count()
        assert scores.where("score is null or score < 0 or score > 1").count() == 0
        assert accuracy(scores, labels, label) > 0.95
        assert quality_scores(docs, labels.limit(0)).select("score").distinct().count() == 1


def test_swap_terms_keeps_case_and_other_words():
    assert tox.swap_terms("Women and a Muslim man; womenfolk") == "Men and a Christian woman; womenfolk"


def test_counterfactual_term_lowers_the_weight_of_a_group_mention(labelled):
    docs, labels = labelled
    sample = tox.labelled_sample(docs, labels, "toxic", 3, 1, 6000)
    rows = tox.sample_features(sample, tox.FEATURES)
    pairs = tox.counterfactual_pairs(sample, tox.FEATURES)
    assert pairs
    change = {}
    for strength in (0.0, 20.0):
        weights, _ = tox.fit(*rows, pairs, fairness=strength)
        change[strength] = np.mean([(weights[a].sum() - weights[b].sum()) ** 2 for a, b in pairs])
    assert change[20.0] < 0.1 * change[0.0]


def test_languages(spark):
    rng = random.Random(9)
    parts = {"en": ["the", "ing", "tion"], "de": ["sch", "ung", "über"], "fr": ["eau", "ément", "ç"]}
    docs = [(k, " ".join("".join(rng.choice(parts[lang]) for _ in range(3)) for _ in range(rng.randint(3, 90))), lang)
            for k, lang in enumerate(["en", "de", "fr"] * 60)]
    docs += [(500, None, "en"), (501, "12 + 3", None), (502, "", None), (None, "the the", "en")]
    frame_ = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in identify_languages(frame_).collect()}
    assert all(got[k]["lang_pred"] == "und" for k in (500, 501, 502))
    held = [d for d in docs[:180] if got[d[0]]["held_out"]]
    assert sum(got[d[0]]["lang_pred"] == d[2] for d in held) > 0.95 * len(held)
    assert identify_languages(frame_.where("lang is null")).where("lang_pred <> 'und'").count() == 0


def test_empty_tables(spark):
    docs, labels = frame(spark, []), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    for out in (remove_repeats(docs), tox.toxicity_scores(docs, labels), lm_scores(docs), quality_scores(docs, labels),
                license_scan(docs), contamination(docs, bench), exact_dedup(docs), identify_languages(docs),
                near_duplicates(docs), pack(docs, tokenizer_path())):
        assert out.count() == 0


def test_pipeline_stages_keep_clean_documents(spark, rows):
    import corpus_pipeline as P
    docs = frame(spark, rows)
    kept = P.exact_duplicates(spark, docs, "")
    assert sorted(kept.columns) == sorted(docs.columns)
    assert kept.count() == len({t or "" for _, t in rows})
    groups = {r["doc_id"]: r["component_id"] for r in near_duplicates(kept).collect()}
    left = P.near_duplicate_groups(spark, kept, "")
    assert {r["doc_id"] for r in left.select("doc_id").collect()} == {i for i, c in groups.items() if i is None or i == c}
    assert [name for name, _ in P.STAGES][-1] == "packing"


def test_exact_duplicates_of_repeated_rows_and_clashing_columns(spark):
    import corpus_pipeline as P
    docs = spark.createDataFrame(
        [(None, "a", "k"), (None, "a", "k"), (1, "a", "k"), (2, None, "k"), (3, "", "k"), (3, "", "k"),
         (9, "z", "k"), (9, "y", "k"), (None, "q", "k")], "doc_id long, text string, key string")
    kept = P.exact_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    assert {tuple(r) for r in kept.collect()} == {(1, "a", "k"), (3, "", "k"), (9, "z", "k"), (9, "y", "k"), (None, "q", "k")}
    assert kept.count() == 5
    assert P.exact_duplicates(spark, docs.limit(0), "").count() == 0


def test_pipeline_stages_judge_rows_with_null_and_repeated_ids_one_by_one(spark, scratch):
    import corpus_pipeline as P
    rng = random.Random(12)
    a, b, c, d, e, f = (prose(rng, 60, [f"v{k}" for k in range(5000)]) for _ in range(6))
    near = lambda t, k=1: t + " end" * k
    docs = frame(spark, [(1, a), (7, near(a)), (7, b), (None, near(b)), (None, c), (None, near(c)), (9, d), (9, near(d)),
                         (None, e), (None, f), (None, None), (None, ""), (4, None)])
    left = [(r["doc_id"], r["text"]) for r in P.near_duplicate_groups(spark, docs, "").collect()]
    first = lambda *texts: min(texts, key=lambda t: hashlib.sha256(t.encode()).digest())
    want = [(1, a), (7, b), (None, first(c, near(c))), (9, first(d, near(d))), (None, e), (None, f), (None, None),
            (None, ""), (4, None)]
    assert sorted(map(str, left)) == sorted(map(str, want))

    item = " ".join(e.split(" ")[5:25])
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{scratch}/benchmark.parquet")
    docs = frame(spark, [(None, e), (None, f), (None, None), (9, f"x {item} y"), (9, d), (3, near(e)), (5, a), (5, a)])
    left = P.benchmark_decontamination(spark, docs, scratch)
    assert left.columns == docs.columns
    assert (sorted(str((r["doc_id"], r["text"])) for r in left.collect())
            == sorted(map(str, [(None, f), (None, None), (9, d), (5, a), (5, a)])))


def test_pipeline_run_against_brute_force(spark, scratch):
    import corpus_pipeline as P
    from tokenizers import Tokenizer
    rng = random.Random(13)
    clean, foul = [f"word{k}" for k in range(300)], ["vile", "idiot", "scum", "filth"]
    toxic = {k for k in range(200) if k % 4 == 0}
    rows = [(k, prose(rng, 40, foul if k in toxic else clean)) for k in range(200)]
    rows += [(300, rows[1][1]), (None, rows[2][1]), (3, rows[3][1]), (5, rows[6][1] + " end"), (None, rows[7][1] + " end"),
             (None, prose(rng, 40, foul)), (None, None), (301, ""), (9, "x " + " ".join(rows[10][1].split(" ")[5:30]))]
    lone = prose(rng, 40, clean)
    rows += [(None, lone), (None, lone + " end"), (None, prose(rng, 40, clean)), (None, rows[11][1] + " end " * 30)]
    frame(spark, rows).write.parquet(f"{scratch}/documents.parquet")
    spark.createDataFrame([(k, int(k in toxic)) for k in range(200)], "doc_id long, toxic int").write.parquet(f"{scratch}/labels.parquet")
    item = rows[10][1].split(" ")[8:22]
    spark.createDataFrame([(1, " ".join(item))], "item_id long, text string").write.parquet(f"{scratch}/benchmark.parquet")

    left = [(i, t) for i, t in rows if not set(foul) & set((t or "").split(" "))]
    best = {}
    for i, t in left:
        if (t or "") not in best or (-1 if i is None else i) > (-1 if best[t or ""][0] is None else best[t or ""][0]):
            best[t or ""] = (i, t)
    left = sorted(best.values(), key=lambda r: (r[0] is None, r[0] or 0, hashlib.sha256((r[1] or "").encode()).digest()))
    sets = [{tuple(w[k:k + 5]) for k in range(max(len(w) - 4, 1))} if (w := (t or "").split()) else set() for _, t in left]
    label = list(range(len(left)))
    for a in range(len(left)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = [new if x == old else x for x in label]
    left = [r for k, r in enumerate(left) if label[k] == k]
    windows = {tuple(item[k:k + 10]) for k in range(len(item) - 9)}
    left = [(i, t) for i, t in left if not windows & {tuple(word_list(t)[k:k + 10]) for k in range(len(word_list(t)))}]
    tokenizer = Tokenizer.from_file(tokenizer_path())
    want = collections.Counter()
    for i, t in left:
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        want[i, 0, len(ids), zlib.crc32(ids.tobytes())] += 1

    got = P.run(spark, scratch).collect()
    assert collections.Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    sequences = collections.defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        ends = [0] + [o + n for o, n in sorted(parts)]
        assert [o for o, _ in sorted(parts)] == ends[:-1] and ends[-1] <= 2048
