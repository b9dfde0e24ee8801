"""Spelling variants: words one edit apart, found by blocked Gram matrices of letter counts.

An edit changes the counts of at most two letters, each by one, so words one
edit apart have letter-count vectors with a squared distance of 1 (inserted or
deleted) or 2 (replaced), and lengths that are equal or adjacent.  Squared
distances of a block of words follow from a matrix product of its counts.

So that blocks don't pair all words of a length, the letters are split into
groups: an edit leaves all but two of them as they were.  Words are dealt
under every choice of all but two groups with its letter counts, and meet in
blocks by length within such a key.  Every pair one edit apart meets at least
once; candidates are verified on their letters.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relnorm.llm.arrays import LOWER, batches, byte_columns, mix64
from relnorm.llm.dealing import cells
from relnorm.llm.shared import staged

PIECE_BYTES = 1 << 20
HELD_BYTES = 16 << 20
BLOCK = 128
CELL_LIMIT = 4096
PER_BIN = 50_000
CHECK_CELLS = 1 << 20

_LOWER = LOWER.tobytes()
#: Runs of a-z and U+00C0..U+00FF in UTF-8, where the latter are C3 and one more byte.
_RUN = re.compile(rb"(?:[a-z]|\xC3[\x80-\xBF])+")
_BREAK = re.compile(rb"[\x00-\x60\x7B-\x7F]")
_FIRST, _HIGH, _LETTERS = 97, 0xC0, 26 + 64
_WORDS = pa.schema([("word", pa.string()), ("n", pa.int64())])
_ENTRY = pa.schema([("key", pa.int64()), ("word", pa.string()), ("n", pa.int64())])
_PAIRS = pa.schema([("a", pa.string()), ("na", pa.int64()), ("b", pa.string()), ("nb", pa.int64())])


def _pieces(text: bytes):
    """``text`` in pieces of about a megabyte, cut at ASCII characters that no word has."""
    at = 0
    while len(text) - at > PIECE_BYTES:
        cut = _BREAK.search(text, at + PIECE_BYTES)
        if cut is None:
            break
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:]


def document_words(doc_id, text: bytes, least: int, every: int) -> Counter:
    """Counts of the words of one document of at least ``least`` letters, after the deletions that its id decides."""
    runs: Counter = Counter()
    for piece in _pieces(text):
        runs.update([w for w in _RUN.findall(piece.translate(_LOWER)) if len(w) >= least])
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    out: Counter = Counter()
    for run, n in runs.items():
        h = zlib.crc32(run, start)
        size = len(run) - run.count(b"\xc3")
        if h % every == 0:
            word, at = run.decode(), h % size
            run, size = (word[:at] + word[at + 1:]).encode(), size - 1
        if size >= least:
            out[run] += n
    return out


def _counted(least: int, every: int):
    def run(parts):
        held: dict[bytes, int] = {}
        size = 0

        def flush():
            words = pa.array(list(held), pa.binary()).cast(pa.string())
            yield from batches({"word": words, "n": np.fromiter(held.values(), np.int64, len(held))}, _WORDS)

        for part in parts:
            ids = part.column(0).to_pylist()
            data, offsets = byte_columns(part.column(1))
            data = data.tobytes()
            for id_, a, b in zip(ids, offsets[:-1].tolist(), offsets[1:].tolist()):
                for word, n in document_words(id_, data[a:b], least, every).items():
                    if word in held:
                        held[word] += n
                    else:
                        held[word] = n
                        size += len(word) + 100
                if size >= HELD_BYTES:
                    yield from flush()
                    held, size = {}, 0
        if held:
            yield from flush()
    return run


def vocabulary(docs: DataFrame, least: int = 6, occurrences: int = 5, every: int = 199, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """(word, n) of all words of at least ``least`` letters with at least ``occurrences`` occurrences."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return (rows.mapInArrow(_counted(least, every), "word string, n long").groupBy("word")
            .agg(F.sum("n").alias("n")).where(F.col("n") >= occurrences))


def letters(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Letter numbers (0..89) of all words one after the other, and the words' bounds."""
    data, offsets = byte_columns(words)
    lead = data == 0xC3
    after = np.concatenate([[False], lead[:-1]])
    codes = np.where(after, data.astype(np.int16) - 0x80 + 26, data.astype(np.int16) - _FIRST)
    bounds = offsets - np.concatenate([[0], np.cumsum(lead)])[offsets]
    return codes[~lead].astype(np.uint8), bounds


def letter_counts(codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How often each word (row) has each letter (column)."""
    rows = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    flat = np.bincount(rows * _LETTERS + codes, minlength=(len(bounds) - 1) * _LETTERS)
    return flat.reshape(-1, _LETTERS).astype(np.int32)


def letter_groups(totals: np.ndarray, groups: int) -> np.ndarray:
    """The group of each letter, so that all groups hold about equally many of all letters."""
    group, load = np.zeros(_LETTERS, np.int64), np.zeros(groups)
    for letter in np.argsort(-totals, kind="stable"):
        group[letter] = np.argmin(load)
        load[group[letter]] += totals[letter] + 1e-9
    return group


def _letter_totals(parts):
    totals = np.zeros(_LETTERS, np.int64)
    for part in parts:
        codes, _ = letters(part.column(0))
        totals += np.bincount(codes, minlength=_LETTERS)
    yield from batches({"letter": np.arange(_LETTERS), "n": totals}, pa.schema([("letter", pa.int64()), ("n", pa.int64())]))


def _keys(group: np.ndarray):
    """A key for every choice of all groups but two: a hash of its letter counts."""
    groups = int(group.max()) + 1
    factors = mix64(np.arange(1, _LETTERS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def run(parts):
        for part in parts:
            for k in range(0, part.num_rows, 20_000):
                some = part.slice(k, 20_000)
                codes, bounds = letters(some.column(0))
                sums = letter_counts(codes, bounds).astype(np.uint64)
                by_group = [mix64((sums[:, group == g] * factors[group == g]).sum(1, dtype=np.uint64) + np.uint64(g))
                            for g in range(groups)]
                for left_out in combinations(range(groups), 2):
                    kept = [g for g in range(groups) if g not in left_out]
                    key = mix64(sum((by_group[g] for g in kept), np.zeros(some.num_rows, np.uint64))
                                + np.uint64(left_out[0] * groups + left_out[1]))
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), some.column(0), some.column(1)],
                                                     schema=_ENTRY)
    return run


def one_edit(codes: np.ndarray, bounds: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether words a[k] and b[k] differ by exactly one edit; b[k] is as long as a[k] or one letter longer."""
    sizes = np.diff(bounds)
    out, order = np.zeros(len(a), bool), np.argsort(sizes[b], kind="stable")
    at = 0
    while at < len(order):
        step = max(CHECK_CELLS // max(int(sizes[b[order[min(at + 4096, len(order)) - 1]]]), 1), 1)
        some = order[at:at + min(step, 4096)]
        at += len(some)
        x, y, n = a[some], b[some], int(sizes[b[some]].max())
        place = np.arange(n)
        short, long_ = sizes[x][:, None], sizes[y][:, None]

        def head(w):  # letters from the first one
            return codes[np.minimum(bounds[w][:, None] + place, len(codes) - 1)]

        def tail(w):  # letters from the last one
            return codes[np.maximum(bounds[w + 1][:, None] - 1 - place, 0)]

        inside = place < short
        before = np.logical_and.accumulate((head(x) == head(y)) & inside, axis=1).sum(1)
        behind = np.logical_and.accumulate((tail(x) == tail(y)) & inside, axis=1).sum(1)
        short, long_ = short[:, 0], long_[:, 0]
        out[some] = np.where(short == long_, before + behind == short - 1, before + behind >= short)
    return out


def _bin_pairs(table: pa.Table) -> pa.Table:
    """Pairs one edit apart among the words that share a cell: Gram matrices of blocks by (cell, length)."""
    table = table.combine_chunks()
    names = table.column("word").combine_chunks().dictionary_encode()
    words, word = names.dictionary, names.indices.to_numpy()
    n = np.zeros(len(words), np.int64)
    n[word] = table.column("n").to_numpy()
    codes, bounds = letters(words)
    counts, sizes = letter_counts(codes, bounds), np.diff(bounds)
    kind = np.float32 if int(sizes.max(initial=0)) < 1000 else np.float64  # squared lengths stay exact
    norms = (counts.astype(np.int64) ** 2).sum(1)

    cell = np.unique(table.column("cell").to_numpy(), return_inverse=True)[1].astype(np.int64)
    order = np.lexsort((sizes[word], cell))
    cell, word = cell[order], word[order]
    wide = int(sizes.max(initial=0)) + 2
    place = cell * wide + sizes[word]                                   # blocks by cell and length, in order
    reach = np.searchsorted(place, place + 1, side="right")            # the end of the next length's block
    first, second, start = [], [], 0
    while start < len(word):
        end = min(start + BLOCK, len(word))
        last = int(reach[end - 1])
        rows, columns = word[start:end], word[start:last]
        gram = counts[rows].astype(kind) @ counts[columns].astype(kind).T
        apart = norms[rows].astype(kind)[:, None] + norms[columns].astype(kind)[None] - 2 * gram
        i, j = np.nonzero((apart <= 2) & (apart > 0))
        near = j > i
        first.append(rows[i[near]])
        second.append(columns[j[near]])
        start = end
    a, b = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (first, second))
    rank = np.empty(len(words), np.int64)
    rank[pc.sort_indices(words).to_numpy()] = np.arange(len(words))
    swap = (sizes[a] > sizes[b]) | ((sizes[a] == sizes[b]) & (rank[a] > rank[b]))  # the same order in every bin
    a, b = np.where(swap, b, a), np.where(swap, a, b)
    pairs = np.unique(a.astype(np.int64) * len(words) + b)
    a, b = pairs // max(len(words), 1), pairs % max(len(words), 1)
    fits = sizes[b] - sizes[a] <= 1
    a, b = a[fits], b[fits]
    near = one_edit(codes, bounds, a, b)
    a, b = a[near], b[near]
    return pa.Table.from_arrays([words.take(pa.array(a)), pa.array(n[a]), words.take(pa.array(b)), pa.array(n[b])],
                                schema=_PAIRS)


def near_words(words: DataFrame, limit: int = CELL_LIMIT, per_bin: int = PER_BIN) -> DataFrame:
    """(a, na, b, nb): every two words (of a written table word, n) one edit apart, once; b is not the shorter."""
    total = words.count()
    summed = (words.select("word").mapInArrow(_letter_totals, "letter long, n long").groupBy("letter")
              .agg(F.sum("n").alias("n")).toArrow())  # 90 rows
    totals = np.zeros(_LETTERS, np.int64)
    totals[summed.column("letter").to_numpy()] = summed.column("n").to_numpy()
    groups = max(4, total.bit_length() // 4 + 1)  # more words: more groups, hence finer keys
    entries = words.mapInArrow(_keys(letter_groups(totals, groups)), "key long, word string, n long")
    pairs = cells(entries, total * comb(groups, 2), "word", limit, per_bin).groupBy("bin").applyInArrow(
        _bin_pairs, "a string, na long, b string, nb long")
    return pairs.distinct()


def spelling_variants(docs: DataFrame, least: int = 6, occurrences: int = 5, every: int = 199, factor: int = 5,
                      id_col: str = "doc_id", text_col: str = "text", limit: int = CELL_LIMIT,
                      per_bin: int = PER_BIN) -> DataFrame:
    """One row per word of the vocabulary: word, n, n_near, form, form_n, root.

    A word's form is its near word of largest n (ties: the smallest) if that n
    is at least ``factor`` times its own, else null; root follows the forms to
    the last.  A null text has no words; a null id counts as empty in the
    deletions.  Repeated rows count each.  An empty table gives no rows.
    Further columns of the input are not read.
    """
    if factor < 2:
        raise ValueError("factor must be at least 2, or forms could lead in circles")
    words = staged(vocabulary(docs, least, occurrences, every, id_col, text_col), "words")
    pairs = staged(near_words(words, limit, per_bin), "near")
    both = pairs.select(F.col("a").alias("word"), F.col("na").alias("n"), F.col("b").alias("near"),
                        F.col("nb").alias("near_n")).union(pairs.select("b", "nb", "a", "na"))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                    F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    is_form = -F.col("best.less") >= factor * F.col("n")
    out = staged(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n")), "forms")
    # Each form has at least `factor` times the n, so chains are short and doubling reaches their ends soon.
    step = out.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        onward = step.toDF("root", "beyond")
        longer = step.join(onward, "root", "left")
        moved = staged(longer.select("word", F.coalesce("beyond", "root").alias("root"),
                                     F.col("beyond").isNotNull().alias("moved")), "roots")
        step = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            break
    return out.join(step, "word", "left").withColumn("root", F.coalesce("root", "word"))
