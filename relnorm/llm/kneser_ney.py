"""Interpolated modified Kneser-Ney language model (bigrams), counted in Spark.

Tasks count the bigrams of many documents and deal them by hash range of the
context word; the bigrams of words frequent in a sample are dealt by their own
hash, so that no range grows with one word.  Each range merges its counts,
stores them as a sorted hash array in the shared folder and passes on, per
word, what it has seen of it as context and as continuation.  The word ranges
sum that up into a second sorted hash array.  Scoring tasks map the files into
memory.  Nothing but counts of counts reaches the driver.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relnorm.llm.arrays import NON_SPACE, bin_of, byte_columns, mix64, slices, word_hashes
from relnorm.llm.hash_arrays import look_up, read_columns, write_columns
from relnorm.llm.samples import fold
from relnorm.llm.shared import bins_for, folder

BEGIN = np.uint64(0x5DEECE66D1234567)
END = np.uint64(0xC2B2AE3D27D4EB4F)
FLUSH = 3_000_000
BIGRAM_FILE = 2  # columns: bigram, count
#: word, count as context, contexts' bigrams seen once, twice, more often, distinct words before it
WORD_FILE = 6
_BLOBS = pa.schema([("bin", pa.int64()), ("payload", pa.binary())])
_TOTALS = pa.schema([(k, pa.int64()) for k in (
    "tokens", "types", "bigrams", "b1", "b2", "b3", "b4", "w1", "w2", "w3", "w4")])


def token_rows(column):
    """Per slice of texts: first row, token hashes (an end after each text) and the texts' bounds."""
    for first, last, data, offsets in slices(*byte_columns(column)):
        words, bounds = word_hashes(data, offsets, NON_SPACE)
        rows = last - first
        tokens = np.empty(len(words) + rows, np.uint64)
        ends = bounds[1:] + np.arange(rows)
        inner = np.ones(len(tokens), bool)
        inner[ends] = False
        tokens[inner] = words
        tokens[ends] = END
        yield first, tokens, np.concatenate([[0], ends + 1])


def contexts(tokens: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The token before each token; ``BEGIN`` at a text's start."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[bounds[:-1]] = BEGIN
    return before


def bigram_hash(before: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    return mix64(before * np.uint64(0x9E3779B97F4A7C15) + tokens)


def _blobs(bins_of_rows: np.ndarray, columns: list[np.ndarray]):
    """A batch per range: its rows' columns, one after the other; rows are sorted by range."""
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(bins_of_rows)) + 1, [len(bins_of_rows)]])
    bins, payloads = [], []
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        if hi > lo:
            bins.append(int(bins_of_rows[lo]))
            payloads.append(b"".join(np.ascontiguousarray(c[lo:hi]).tobytes() for c in columns))
    for k in range(0, len(bins), 16):
        yield pa.RecordBatch.from_arrays([pa.array(bins[k:k + 16], pa.int64()),
                                          pa.array(payloads[k:k + 16], pa.binary())], schema=_BLOBS)


def _unblob(payloads: list[bytes], types: list[str]) -> list[np.ndarray]:
    width = sum(np.dtype(t).itemsize for t in types)
    out: list[list] = [[] for _ in types]
    for blob in payloads:
        n, at = len(blob) // width, 0
        for k, t in enumerate(types):
            size = n * np.dtype(t).itemsize
            out[k].append(np.frombuffer(blob, t, n, at))
            at += size
    return [np.concatenate(c) if c else np.empty(0, t) for c, t in zip(out, types)]


def _sums(order: np.ndarray, keys: np.ndarray, columns: list[np.ndarray]):
    """Distinct sorted keys and the columns' sums over each."""
    keys = keys[order]
    heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    return heads, keys[heads], [np.add.reduceat(c[order], heads) if len(heads) else c[:0] for c in columns]


def _count(bins: int, frequent: np.ndarray):
    def flush(held):
        before = np.concatenate([h[0] for h in held])
        tokens = np.concatenate([h[1] for h in held])
        keys = bigram_hash(before, tokens)
        order = np.argsort(keys)
        heads, keys, (counts,) = _sums(order, keys, [np.ones(len(keys), np.int64)])
        before, tokens, counts = before[order[heads]], tokens[order[heads]], counts.astype("<u4")
        hot = look_up(frequent, before)[1]
        for rows, dealt in ((np.flatnonzero(hot), keys), (np.flatnonzero(~hot), before)):
            rows = rows[np.argsort(dealt[rows], kind="stable")]
            yield from _blobs(bin_of(dealt[rows], bins), [before[rows], tokens[rows], counts[rows]])

    def run(parts):
        held, size = [], 0
        for part in parts:
            for _, tokens, bounds in token_rows(part.column(0)):
                held.append((contexts(tokens, bounds), tokens))
                size += len(tokens)
                if size >= FLUSH:
                    yield from flush(held)
                    held, size = [], 0
        if held:
            yield from flush(held)
    return run


def _narrow(words: np.ndarray, columns: list[np.ndarray], most: int = 2**32 - 1):
    """Rows with 32-bit counts: a larger count is spread over several rows of its word, which add up again."""
    times = np.maximum(np.max([-(-c // most) for c in columns], axis=0, initial=0), 1) if len(words) else np.empty(0, np.int64)
    at = np.repeat(np.arange(len(words)), times)
    part = np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
    return words[at], [np.clip(c[at] - part * most, 0, most).astype("<u4") for c in columns]


def _merge_bigrams(path: str, bins: int):
    """One context range: write its bigrams, pass on per word what was seen."""
    def run(table: pa.Table) -> pa.Table:
        before, tokens, counts = _unblob(table.column("payload").to_pylist(), ["<u8", "<u8", "<u4"])
        keys = bigram_hash(before, tokens)
        order = np.argsort(keys)
        heads, keys, (counts,) = _sums(order, keys, [counts.astype(np.int64)])
        write_columns(f"{path}/bigrams-{table.column('bin')[0].as_py()}", [keys, counts])
        before, tokens = before[order[heads]], tokens[order[heads]]
        one, two, more = (counts == 1).astype(np.int64), (counts == 2).astype(np.int64), (counts > 2).astype(np.int64)
        order = np.argsort(before)
        _, left, seen = _sums(order, before, [counts, one, two, more])
        order = np.argsort(tokens)
        _, right, (kinds,) = _sums(order, tokens, [np.ones(len(tokens), np.int64)])
        words = np.concatenate([left, right])
        columns = [np.concatenate([s, np.zeros(len(right), np.int64)]) for s in seen]
        columns.append(np.concatenate([np.zeros(len(left), np.int64), kinds]))
        order = np.argsort(words, kind="stable")
        _, words, columns = _sums(order, words, columns)
        words, columns = _narrow(words, columns)
        out = list(_blobs(bin_of(words, bins), [words, *columns]))
        totals = np.array([(counts == k).sum() for k in (1, 2, 3, 4)], "<i8").tobytes()
        out.append(pa.RecordBatch.from_arrays(
            [pa.array([-1 - table.column("bin")[0].as_py() % 16], pa.int64()), pa.array([totals], pa.binary())], schema=_BLOBS))
        return pa.Table.from_batches(out)
    return run


def _merge_words(path: str):
    """One word range: write its words, return counts of counts."""
    def run(table: pa.Table) -> pa.Table:
        at = table.column("bin")[0].as_py()
        payloads = table.column("payload").to_pylist()
        if at < 0:
            b = sum(np.frombuffer(p, "<i8") for p in payloads).tolist()
            return pa.Table.from_pylist([dict(zip(_TOTALS.names, [0, 0, 0, *b, 0, 0, 0, 0]))], schema=_TOTALS)
        words, *columns = _unblob(payloads, ["<u8"] + ["<u4"] * 5)
        _, words, columns = _sums(np.argsort(words, kind="stable"), words, [c.astype(np.int64) for c in columns])
        write_columns(f"{path}/words-{at}", [words, *columns])
        kinds = columns[4]
        row = [columns[0].sum(), (kinds > 0).sum(), kinds.sum(), 0, 0, 0, 0, *((kinds == k).sum() for k in (1, 2, 3, 4))]
        return pa.Table.from_pylist([dict(zip(_TOTALS.names, map(int, row)))], schema=_TOTALS)
    return run


def discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """Modified Kneser-Ney discounts of counts 0, 1, 2 and more, from counts of counts."""
    if not (n1 and n2 and n3):
        return np.array([0, 0.5, 0.75, 0.75])  # too little text for the estimates
    y = n1 / (n1 + 2 * n2)
    return np.array([0, *np.clip([1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3], 0.05, [1, 2, 3])])


def _frequent_words(texts: DataFrame, bins: int, sample_rows: int) -> np.ndarray:
    """Sorted hashes of words that make up over 1 / (8 bins) of a sample; at most 8 bins words.

    They decide only which task counts a bigram, never its count.
    """
    def run(parts):
        for part in parts:
            for _, tokens, _ in token_rows(part.column(0)):
                words, counts = np.unique(tokens, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(counts.astype(np.int64))],
                                                 names=["word", "n"])
    seen = texts.limit(sample_rows).mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    total = seen.agg(F.sum("n")).first()[0] or 0
    rows = seen.where(F.col("n") * 8 * bins > total).select("word").collect() if total else []
    return np.unique(np.array([BEGIN] + [np.int64(r[0]).view(np.uint64) for r in rows], np.uint64))


class KneserNey:
    """A fitted model: folder of its files, ranges, frequent words and totals; small enough to ship."""

    def __init__(self, texts: DataFrame, sample_rows: int = 1000):
        """Count the column ``text`` of all rows."""
        spark = texts.sparkSession
        self.bins = bins_for(spark, texts, 8 << 20)
        self.path = folder(spark, f"kneser-ney-{uuid.uuid4().hex[:8]}")
        self.frequent = _frequent_words(texts, self.bins, sample_rows)
        counted = texts.mapInArrow(_count(self.bins, self.frequent), "bin long, payload binary")
        # Every range has a row, so that each writes its files, empty ones too.
        every = spark.range(self.bins).select(F.col("id").alias("bin"), F.lit(b"").alias("payload"))
        seen = counted.union(every).groupBy("bin").applyInArrow(_merge_bigrams(self.path, self.bins), "bin long, payload binary")
        done = seen.union(every).groupBy("bin").applyInArrow(_merge_words(self.path), ", ".join(f"{n} long" for n in _TOTALS.names))
        total = done.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in _TOTALS.names]).first().asDict()
        self.tokens, self.types, self.bigrams = total["tokens"], total["types"], total["bigrams"]
        self.bigram_cut = discounts(*(total[f"b{k}"] for k in (1, 2, 3, 4)))
        w = [total[f"w{k}"] for k in (1, 2, 3, 4)]
        self.word_cut = discounts(*w)
        rest = max(self.types - w[0] - w[1], 0)
        self.new_mass = (self.word_cut[1:] @ [w[0], w[1], rest] / self.bigrams) if self.bigrams else 1.0

    def _in_ranges(self, ranges: np.ndarray, keys: np.ndarray, name: str, columns: int) -> list[np.ndarray]:
        """Values of the stored columns for distinct keys, 0 where a key is not stored."""
        order = np.lexsort((keys, ranges))
        out = [np.zeros(len(keys), np.int64) for _ in range(columns - 1)]
        cuts = np.searchsorted(ranges[order], np.arange(self.bins + 1))
        for k in range(self.bins):
            some = order[cuts[k]:cuts[k + 1]]
            if len(some):
                stored = read_columns(f"{self.path}/{name}-{k}", columns)
                at, there = look_up(stored[0], keys[some])
                for values, column in zip(out, stored[1:]):
                    values[some[there]] = column[at[there]]
        return out

    def token_scores(self, tokens: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per token: log10 model probability, log10 base probability, training count."""
        words, at = np.unique(np.concatenate([tokens, before]), return_inverse=True)
        total, one, two, more, kinds = self._in_ranges(bin_of(words, self.bins), words, "words", WORD_FILE)
        texts = total[words == BEGIN].sum()
        count = np.where(words == END, texts, np.where(words == BEGIN, 0, total))
        spared = self.bigram_cut[1:] @ np.stack([one, two, more])
        low = np.maximum(kinds - self.word_cut[np.minimum(kinds, 3)], 0) / max(self.bigrams, 1)
        low += self.new_mass / (self.types + 1)
        token, context = at[:len(tokens)], at[len(tokens):]
        keys, first, back = np.unique(bigram_hash(before, tokens), return_index=True, return_inverse=True)
        hot = look_up(self.frequent, before[first])[1]
        ranges = np.where(hot, bin_of(keys, self.bins), bin_of(before[first], self.bins))
        seen = self._in_ranges(ranges, keys, "bigrams", BIGRAM_FILE)[0][back]
        size = total[context]
        high = np.maximum(seen - self.bigram_cut[np.minimum(seen, 3)], 0)
        p = np.where(size > 0, (high + spared[context] * low[token]) / np.maximum(size, 1), low[token])
        base = (count[token] + 0.1) / (self.tokens + 0.1 * (self.types + 1))
        return np.log10(p), np.log10(base), count[token]


def _score(model: KneserNey):
    schema = pa.schema([("id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                        ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def run(parts):
        for part in parts:
            held, rows = [], 0
            out = []

            def flush():
                tokens = np.concatenate([h[0] for h in held])
                before = np.concatenate([h[1] for h in held])
                lens = np.concatenate([h[2] for h in held])
                score, base, count = model.token_scores(tokens, before)
                starts = np.concatenate([[0], np.cumsum(lens)[:-1]])
                out.append((lens, np.add.reduceat((count > 0).astype(np.int64), starts),
                            np.add.reduceat(base, starts), np.add.reduceat(score, starts)))
            for _, tokens, bounds in token_rows(part.column(2)):
                held.append((tokens, contexts(tokens, bounds), np.diff(bounds)))
                rows += len(tokens)
                if rows >= FLUSH // 2:
                    flush()
                    held, rows = [], 0
            if held:
                flush()
            if out:
                lens, known, base, score = (np.concatenate(c) for c in zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(lens), pa.array(known),
                     pa.array(np.full(len(lens), model.tokens, np.int64)), pa.array(base), pa.array(score)], schema=schema)
    return run


def lm_scores(docs: DataFrame, folds: int = 10, held_out: int = 0, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """One row per document: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    The model learns from every row outside the held-out fold and scores every
    row; scores are log10 probabilities, the perplexity of a text is
    ``10 ** (-score / n_tokens)``.  A null or empty text is the end token
    alone.  Repeated rows count and are scored each; a row with a null id is in
    fold 0.  Without training text every token is unknown: the model gives each
    probability 1 and the base 1 / (V + 1) = 1.  An empty table gives no rows.
    """
    aside = fold(id_col, folds) == held_out
    model = KneserNey(docs.where(~aside).select(F.col(text_col).alias("text")))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), aside.alias("held_out"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_score(model), "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                           "base_score double, score double").withColumnRenamed("id", id_col)
