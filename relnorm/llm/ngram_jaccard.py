"""Similarity join of documents on their word n-gram sets (Jaccard) by prefix filtering.

All n-grams are ordered rare first, by counts over all documents kept in a
fixed number of hashed counters; any one order gives the same links, a good
one gives few candidates.  Two sets that link share an n-gram within their
prefixes.  Prefix n-grams are pre-aggregated in each task to one entry per
n-gram, dealt by hash range and met there.  Entries that share an n-gram give
candidate pairs, which pass length, positional and suffix filters and are then
verified once on their whole sets.

Pairs are not formed within groups that are known to be connected.  The first
round pairs every entry of an n-gram with one of them only.  What shares an
n-gram and is still in different components then meets in cells of bounded
size (a frequent n-gram is cut into blocks that meet two by two), where all
filters are applied and only as many pairs leave the task as would connect
what they join.  Pairs that fail the check are told to the next round, which
offers others, until no two components have a pair left: no link that matters
to the components is lost, and no round sends all pairs of a group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from relnorm.llm.arrays import NON_SPACE, batches, bin_of, byte_columns, chain_hashes, mix64, slices, word_hashes
from relnorm.llm.components import components
from relnorm.llm.dealing import broadcast_below, cells
from relnorm.llm.shared import bins_for, release, staged
from relnorm.llm.simhash import Forest

SKETCH_BITS = 19
PARITY_WORDS = 8
STAR_ROUNDS = 1
FLUSH = 400_000
SLICE_BYTES = 1 << 18
CELL_LIMIT = 4096
PER_BIN = 100_000
STRIP = 128
PIECE = 20_000

_SKETCH = pa.schema([("bucket", pa.int32()), ("n", pa.int64())])
_SETS = (("cls", pa.int64()), ("n", pa.int64()), ("parity", pa.list_(pa.int64())), ("long", pa.binary()))
_BLOBS = pa.schema([("bin", pa.int64()), ("payload", pa.binary())])
_ENTRIES = pa.schema([("h", pa.int64()), ("cls", pa.int64()), ("n", pa.int64()), ("i", pa.int64())])
_WHOLE = pa.schema([("cls", pa.int64()), ("grams", pa.binary())])
_PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("na", pa.int64()), ("nb", pa.int64()), ("h", pa.int64())])
_ENTRY_SQL = "h long, cls long, n long, i long"
_ENTRY = np.dtype([("h", "<u8"), ("cls", "<i8"), ("n", "<i4"), ("i", "<i4"), ("more", "u1")])


def gram_sets(column, width: int) -> Iterator[np.ndarray]:
    """For each text its sorted distinct n-gram hashes; all words as one n-gram if fewer than ``width``."""
    for first, last, data, offsets in slices(*byte_columns(column), SLICE_BYTES):
        hashes, bounds = word_hashes(data, offsets, NON_SPACE)
        chained = chain_hashes(hashes, width)
        for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if hi - lo >= width:
                yield np.unique(chained[lo:hi - width + 1])
            else:
                yield chain_hashes(hashes[lo:hi], max(hi - lo, 1))


def set_class(grams: np.ndarray) -> int:
    """A 64-bit name for a set of n-grams; equal sets have equal names."""
    total = int(mix64(grams).sum(dtype=np.uint64)) + len(grams) * 0x9E3779B97F4A7C15
    return int(mix64(np.array([total & 0xFFFFFFFFFFFFFFFF], np.uint64))[0].view(np.int64))


def _sketch(width: int, bits: int):
    def run(parts):
        counts = np.zeros(1 << bits, np.int64)
        for part in parts:
            for grams in gram_sets(part.column(0), width):
                np.add.at(counts, (grams >> np.uint64(64 - bits)).astype(np.int64), 1)
        used = np.flatnonzero(counts)
        yield from batches({"bucket": used, "n": counts[used]}, _SKETCH)
    return run


def parity_sketch(grams: np.ndarray) -> list[int]:
    """A bit per hash bucket: whether an odd number of the set's n-grams is in it.

    Two sets differ in at least as many n-grams as their sketches in bits.
    """
    buckets = ((grams >> np.uint64(20)) % np.uint64(64 * PARITY_WORDS)).astype(np.int64)
    odd = (np.bincount(buckets, minlength=64 * PARITY_WORDS) & 1).astype(np.uint8)
    return np.packbits(odd).view("<i8").tolist()


def long_sketch(grams: np.ndarray) -> bytes | None:
    """The parity sketch of a set too large for the short one, of a power of two of bits, at least its size."""
    if len(grams) <= 64 * PARITY_WORDS:
        return None
    bits = 1 << (len(grams) - 1).bit_length()
    odd = np.bincount(((grams >> np.uint64(20)) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def sketch_difference(x: bytes, y: bytes) -> int:
    """In how many bits two long sketches differ, the longer one folded to the shorter one's buckets."""
    x, y = sorted((np.frombuffer(v, np.uint8) for v in (x, y)), key=len)
    return int(np.bitwise_count(x ^ np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0)).sum())


def _unlike(percent: int):
    """Of pairs (a, b, na, nb, long_a, long_b) those whose sketches differ in more bits than sets that link can."""
    def run(parts):
        for part in parts:
            na, nb = part.column("na").to_numpy(), part.column("nb").to_numpy()
            most = na + nb - 2 * -(-percent * (na + nb) // (100 + percent))
            differ = [sketch_difference(x, y) for x, y in
                      zip(part.column("long_a").to_pylist(), part.column("long_b").to_pylist())]
            yield part.select(["a", "b"]).filter(pa.array(np.array(differ, np.int64) > most))
    return run


def _set_rows(width: int):
    def run(parts):
        for part in (p.slice(k, 1000) for p in parts for k in range(0, p.num_rows, 1000)):
            rows = {"cls": [], "n": [], "parity": [], "long": []}
            for grams in gram_sets(part.column(1), width):
                rows["cls"].append(set_class(grams) if len(grams) else None)
                rows["n"].append(len(grams))
                rows["parity"].append(parity_sketch(grams))
                rows["long"].append(long_sketch(grams))
            made = [pa.array(rows[name], kind) for name, kind in _SETS]
            yield pa.RecordBatch.from_arrays([part.column(0), *made], names=["id", *rows])
    return run


def _prefix_entries(parts, width: int, levels: np.ndarray, needed) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted distinct prefix entries of many documents, and which are the first of their n-gram."""
    shift = np.uint64(64 - (len(levels).bit_length() - 1))
    held: list[tuple] = []
    size = 0

    def flush():
        lens = [len(x[0]) for x in held]
        entries = np.empty(sum(lens), _ENTRY)
        entries["h"] = np.concatenate([x[0] for x in held])
        entries["cls"] = np.repeat([x[1] for x in held], lens)
        entries["n"] = np.repeat([x[2] for x in held], lens)
        entries["i"] = np.concatenate([np.arange(k) for k in lens])
        entries = entries[np.lexsort((entries["cls"], entries["n"], entries["h"]))]
        same = (entries["h"][1:] == entries["h"][:-1])
        twice = same & (entries["cls"][1:] == entries["cls"][:-1])
        entries = entries[np.concatenate([[True], ~twice])]
        leads = np.concatenate([[True], entries["h"][1:] != entries["h"][:-1]])
        entries["more"] = np.concatenate([~leads[1:], [False]])
        return entries, leads

    for part in parts:
        for grams in gram_sets(part.column(0), width):
            if len(grams):
                rare_first = np.argsort(levels[(grams >> shift).astype(np.int64)], kind="stable")
                prefix = grams[rare_first[:len(grams) - needed(len(grams)) + 1]]
                held.append((prefix, set_class(grams), len(grams)))
                size += len(prefix)
                if size >= FLUSH:
                    yield flush()
                    held, size = [], 0
    if held:
        yield flush()


def _packed(entries: np.ndarray) -> bytes:
    """Entries by column and, within a column, by byte, so that equal high bytes compress."""
    return b"".join(np.ascontiguousarray(entries[k]).view(np.uint8).reshape(len(entries), -1).T.tobytes()
                    for k in _ENTRY.names)


def _unpacked(blob: bytes) -> np.ndarray:
    entries, at = np.empty(len(blob) // _ENTRY.itemsize, _ENTRY), 0
    for k in _ENTRY.names:
        size = _ENTRY[k].itemsize * len(entries)
        planes = np.frombuffer(blob, np.uint8, size, at).reshape(-1, len(entries))
        entries[k], at = np.ascontiguousarray(planes.T).view(_ENTRY[k]).ravel(), at + size
    return entries


def _dealt_entries(width, levels, needed, bins):
    """Packed rows of each chunk of documents: its leads by hash range, its other entries in pieces under negative bins."""
    def run(parts):
        for entries, leads in _prefix_entries(parts, width, levels, needed):
            others, entries = entries[~leads], entries[leads]
            at = bin_of(entries["h"], bins)
            cuts = np.flatnonzero(np.diff(at)) + 1
            pieces = [(int(at[some[0]]), entries[some[0]:some[-1] + 1]) for some in np.split(np.arange(len(at)), cuts)]
            for k in range(0, len(others), PIECE):
                piece = others[k:k + PIECE]
                place = int(mix64(piece["h"][:1] ^ piece["cls"][:1].view(np.uint64))[0] % np.uint64(bins))
                pieces.append((-1 - place, piece))
            for place, piece in pieces:
                yield pa.RecordBatch.from_arrays([pa.array([place], pa.int64()), pa.array([_packed(piece)], pa.binary())],
                                                 schema=_BLOBS)
    return run


def _entry_table(entries: np.ndarray) -> pa.Table:
    return pa.Table.from_arrays(
        [pa.array(entries["h"].view(np.int64)), pa.array(entries["cls"]), pa.array(entries["n"].astype(np.int64)),
         pa.array(entries["i"].astype(np.int64))], schema=_ENTRIES)


def _shared(table: pa.Table) -> pa.Table:
    """Entries of one hash range whose n-gram another set has too; a chunk's other entries all have one."""
    entries = np.concatenate([_unpacked(b) for b in table.column("payload").to_pylist()])
    if table.column("bin")[0].as_py() < 0:
        return _entry_table(entries)
    entries = entries[np.lexsort((entries["cls"], entries["h"]))]
    fresh = np.concatenate([[True], entries["h"][1:] != entries["h"][:-1]])
    group = np.cumsum(fresh) - 1
    new = fresh | np.concatenate([[True], entries["cls"][1:] != entries["cls"][:-1]])
    shared = (np.bincount(group, weights=new) > 1) | (np.bincount(group, weights=entries["more"]) > 0)
    return _entry_table(entries[new & shared[group]])


def _cell_pairs(percent: int, quota: int):
    """Of the entries of one bin the pairs that pass all filters, lie in different components and were not
    rejected: those that would connect the components, and up to ``quota`` of each entry.

    Rows without ``b`` are the entries (h, a) that have such a pair; no other entry can have one later.
    """
    def run(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("cell").to_numpy(), kind="stable")
        table = table.take(pa.array(order)).combine_chunks()
        cell, cls, n, i, h = (table.column(k).to_numpy() for k in ("cell", "cls", "n", "i", "h"))
        alive = np.zeros(len(cls), bool)
        names, root = np.unique(table.column("root").to_numpy(), return_inverse=True)
        parity = table.column("parity").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(-1, PARITY_WORDS)
        known, index = np.unique(cls, return_inverse=True)
        lists = table.column("rejected").combine_chunks()
        partner = np.searchsorted(known, lists.flatten().to_numpy(zero_copy_only=False))
        sizes = np.diff(lists.offsets.to_numpy()) if len(lists) else np.empty(0, np.int64)
        wrong = np.repeat(index, sizes), np.minimum(partner, len(known) - 1)
        same = known[wrong[1]] == lists.flatten().to_numpy(zero_copy_only=False)
        rejected = np.unique(wrong[0][same] * len(known) + wrong[1][same])
        forest, out = Forest(len(names)), []
        edges = np.append(np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]])), len(cell))
        for start, end in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if end - start < 2:
                continue
            for k in range(start, end, STRIP):
                rows = np.arange(k, min(k + STRIP, end))
                x, y = rows[:, None], np.arange(k, end)[None]
                total = n[x] + n[y]
                need = -(-percent * total // (100 + percent))
                fits = (x < y) & (root[x] != root[y]) & (np.minimum(n[x] - i[x], n[y] - i[y]) >= need) & (
                    100 * np.minimum(n[x], n[y]) >= percent * np.maximum(n[x], n[y]))
                a, b = np.nonzero(fits)
                if not len(a):
                    continue
                differ = np.zeros(len(a), np.int64)
                for w in range(PARITY_WORDS):
                    differ += np.bitwise_count(parity[a + k, w] ^ parity[b + k, w])
                lo, hi = index[a + k], index[b + k]
                code = np.minimum(lo, hi) * len(known) + np.maximum(lo, hi)
                good = differ <= (total - 2 * need)[a, b]
                if len(rejected):
                    good &= rejected[np.minimum(np.searchsorted(rejected, code), len(rejected) - 1)] != code
                a, b = a[good] + k, b[good] + k
                alive[a] = alive[b] = True
                first = np.searchsorted(a, a)           # a is sorted: the place of each row's first pair
                few = np.arange(len(a)) - first < quota - 1
                out.append((a[few], b[few]))
                while True:
                    p, q = forest.label[root[a]], forest.label[root[b]]
                    a, b = a[p != q], b[p != q]
                    if not len(a):
                        break
                    one = np.concatenate([np.unique(a, return_index=True)[1], np.unique(b, return_index=True)[1]])
                    one = np.unique(one)
                    out.append((a[one], b[one]))
                    forest.unite(root[a[one]], root[b[one]])
        a, b = (np.concatenate(x) if out else np.empty(0, np.int64) for x in (zip(*out) if out else ((), ())))
        swap = cls[a] > cls[b]
        a, b = np.where(swap, b, a), np.where(swap, a, b)
        pairs = pa.Table.from_arrays([*(pa.array(v) for v in (cls[a], cls[b], n[a], n[b])), pa.nulls(len(a), pa.int64())],
                                     schema=_PAIRS)
        live = np.flatnonzero(alive)
        empty = pa.nulls(len(live), pa.int64())
        return pa.concat_tables([pairs, pa.Table.from_arrays([pa.array(cls[live]), empty, empty, empty, pa.array(h[live])],
                                                             schema=_PAIRS)])
    return run


def _whole_sets(width: int):
    def run(parts):
        seen = set()
        for part in parts:
            wanted = part.column(0).to_pylist()
            rows = {"cls": [], "grams": []}
            for cls, grams in zip(wanted, gram_sets(part.column(1), width)):
                if len(grams) and cls not in seen and set_class(grams) == cls:
                    seen.add(cls)
                    rows["cls"].append(cls)
                    rows["grams"].append(grams.tobytes())
            yield from batches(rows, _WHOLE, 500)
    return run


def _verify(percent: int):
    def run(parts):
        for part in parts:
            keep = []
            for x, y in zip(part.column("grams_a").to_pylist(), part.column("grams_b").to_pylist()):
                x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                common = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


class NgramJoin:
    """The join's tables: ``sets`` (id, cls, n) and, after ``run``, ``links`` and ``roots`` between classes.

    ``percent``: sets link when 100 * intersection >= percent * union.
    """

    def __init__(self, docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id",
                 text_col: str = "text", sketch_bits: int = SKETCH_BITS,
                 cell_limit: int = CELL_LIMIT, per_bin: int = PER_BIN):
        id_ = F.col(id_col) if isinstance(docs.schema[id_col].dataType, StructType) else F.col(id_col).cast("long")
        self.docs = docs.select(id_.alias("id"), F.col(text_col).alias("text"))
        self.width, self.percent, self.bits = width, percent, sketch_bits
        self.cell_limit, self.per_bin = cell_limit, per_bin
        self.spark = docs.sparkSession

    def needed(self):
        percent = self.percent
        return lambda n: -(-percent * n // 100)

    def levels(self) -> np.ndarray:
        """Coarse logarithms of the hashed n-gram counts over all documents; 2^bits bytes."""
        counted = (self.docs.select("text").mapInArrow(_sketch(self.width, self.bits), "bucket int, n long")
                   .groupBy("bucket").agg(F.sum("n").alias("n")).toArrow())
        counts = np.zeros(1 << self.bits)
        counts[counted.column("bucket").to_numpy()] = counted.column("n").to_numpy()
        return np.minimum(8 * np.log2(1 + counts), 255).astype(np.uint8)

    def entries(self) -> DataFrame:
        """Prefix entries (h, cls, n, i) whose n-gram is in the prefix of another class too."""
        levels, bins = self.levels(), bins_for(self.spark, self.docs)
        # Leads and others of a chunk belong together: both go through one exchange, for a second scan may be cut elsewhere.
        dealt = self.docs.select("text").mapInArrow(
            _dealt_entries(self.width, levels, self.needed(), bins), "bin long, payload binary")
        met = dealt.groupBy("bin").applyInArrow(_shared, _ENTRY_SQL)
        return staged(met.dropDuplicates(["h", "cls"]), "entries")

    def _need(self):
        """The overlap that sets of these sizes need."""
        return F.ceil(self.percent * (F.col("x.n") + F.col("y.n")) / F.lit(100.0 + self.percent) - F.lit(1e-9))

    def _fits(self):
        """Length and positional filters between the entries x and y of one n-gram."""
        room = F.least(F.col("x.n") - F.col("x.i"), F.col("y.n") - F.col("y.i"))
        small, large = F.least("x.n", "y.n"), F.greatest("x.n", "y.n")
        return (100 * small >= self.percent * large) & (room >= self._need())

    def _pairs(self, joined: DataFrame) -> DataFrame:
        x_first = F.col("x.cls") < F.col("y.cls")
        return joined.where(self._fits()).select(
            F.least("x.cls", "y.cls").alias("a"), F.greatest("x.cls", "y.cls").alias("b"),
            F.when(x_first, F.col("x.n")).otherwise(F.col("y.n")).alias("na"),
            F.when(x_first, F.col("y.n")).otherwise(F.col("x.n")).alias("nb")).distinct()

    def _near(self, pairs: DataFrame) -> DataFrame:
        """Suffix filter: the parity sketches bound the difference of the sets from below."""
        sketch = self.sketch
        pairs = pairs.join(sketch.toDF("a", "x"), "a").join(sketch.toDF("b", "y"), "b")
        bits = [F.bit_count(F.col("x")[k].bitwiseXOR(F.col("y")[k])) for k in range(PARITY_WORDS)]
        total = F.col("na") + F.col("nb")
        need = F.ceil(self.percent * total / F.lit(100.0 + self.percent) - F.lit(1e-9))
        return pairs.where(sum(bits[1:], bits[0]) <= total - 2 * need)

    def verified(self, pairs: DataFrame) -> DataFrame:
        """Those of the candidate pairs (a, b, ...; a written table) that link, each checked once on whole sets."""
        large = self.classes.where(F.col("long").isNotNull()).select("cls", "n", "long")
        unlike = staged(pairs.select("a", "b").join(large.toDF("a", "na", "long_a"), "a")
                        .join(large.toDF("b", "nb", "long_b"), "b")
                        .mapInArrow(_unlike(self.percent), "a long, b long"), "unlike")
        pairs = staged(pairs.select("a", "b").join(unlike, ["a", "b"], "left_anti"), "alike")
        wanted = pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct()
        wanted = staged(wanted.join(self.classes.select("cls", "id"), "cls"), "wanted")
        sets = staged(self.docs.join(broadcast_below(wanted), "id").select("cls", "text")
                      .mapInArrow(_whole_sets(self.width), "cls long, grams binary"), "sets")
        if sets.select("cls").distinct().count() < sets.count():  # repeated rows in several tasks
            repeated, sets = sets, staged(sets.dropDuplicates(["cls"]), "sets")
            release(repeated)
        links = staged(pairs.join(sets.toDF("a", "grams_a"), "a").join(sets.toDF("b", "grams_b"), "b")
                       .mapInArrow(_verify(self.percent), "a long, b long").distinct(), "links")
        release(unlike, pairs, wanted, sets)
        return links

    def run(self) -> NgramJoin:
        kind = self.docs.schema["id"].dataType.simpleString()
        self.sets = staged(self.docs.mapInArrow(_set_rows(self.width), f"id {kind}, cls long, n long, "
                                                "parity array<long>, long binary"),
                           "classes")
        self.classes = (self.sets.where(F.col("cls").isNotNull() & F.col("id").isNotNull()).groupBy("cls")
                        .agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("parity").alias("parity"),
                             F.first("long").alias("long")))
        self.classes = staged(self.classes, "classes")
        self.sketch = self.classes.select("cls", "parity")
        entries = self.entries()
        links, roots, rejected = None, None, None
        for turn in range(STAR_ROUNDS):
            left = self._open(entries, roots)
            # A class is a hash: some of its bits turned give another order, and the class back.
            mask = F.lit(int(mix64(np.array([turn]))[0].view(np.int64)))
            order = F.struct(F.col("cls").bitwiseXOR(mask).alias("turn"), "n", "i", "root")
            hubs = left.groupBy("h").agg(F.min(order).alias("y")).select("h", "y.*").withColumn(
                "cls", F.col("turn").bitwiseXOR(mask))
            pairs = self._pairs(left.alias("x").join(hubs.alias("y"), "h").where("x.root <> y.root"))
            if rejected is not None:
                pairs = pairs.join(rejected, ["a", "b"], "left_anti")
            pairs = staged(self._near(pairs).select("a", "b"), "candidates")
            roots, links, rejected = self._grow(pairs, roots, links, rejected)
            release(pairs)
        quota = 4
        while True:
            met = self._cell_round(self._open(entries, roots), rejected, quota)
            pairs = staged(met.where("b is not null").drop("h").distinct(), "candidates")
            if pairs.isEmpty():
                release(entries, met, pairs)
                break
            roots, links, rejected = self._grow(pairs, roots, links, rejected)
            alive = met.where("b is null").select("h", F.col("a").alias("cls")).distinct()
            before, entries = entries, staged(entries.join(alive, ["h", "cls"], "left_semi"), "entries")
            release(before, met, pairs)
            quota *= 4
        self.roots, self.links = roots, links
        return self

    def _cell_round(self, left: DataFrame, rejected: DataFrame, quota: int) -> DataFrame:
        """Pairs of open entries that would connect different components, and the entries that have pairs."""
        both = rejected.union(rejected.select("b", "a"))
        partners = both.groupBy(F.col("a").alias("cls")).agg(F.collect_list("b").alias("rejected"))
        left = staged(left.join(self.sketch, "cls").join(partners, "cls", "left").withColumn(
            "rejected", F.coalesce("rejected", F.array().cast("array<long>"))), "open")
        met = cells(left.withColumn("key", F.col("h")), left.count(), "cls", self.cell_limit, self.per_bin)
        met = staged(met.groupBy("bin").applyInArrow(
            _cell_pairs(self.percent, quota), "a long, b long, na long, nb long, h long"), "met")
        release(left)
        return met

    def _open(self, entries: DataFrame, roots: DataFrame | None) -> DataFrame:
        """Entries with their component's root, of n-grams that several components share."""
        if roots is None:
            return entries.withColumn("root", F.col("cls"))
        rooted = entries.join(roots.toDF("cls", "root"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
        shared = rooted.groupBy("h").agg(F.min("root").alias("p"), F.max("root").alias("q")).where("p <> q")
        return rooted.join(shared.select("h"), "h", "left_semi")

    def _grow(self, pairs: DataFrame, roots, links, rejected):
        """Verify candidate pairs (a written table); components, links and rejected pairs with them."""
        found = self.verified(pairs).toDF("u", "v")
        missed = pairs.select("a", "b").join(found.toDF("a", "b"), ["a", "b"], "left_anti")
        rejected = staged(missed if rejected is None else rejected.union(missed), "rejected")
        if roots is None:
            return components(found), found, rejected
        return components(roots.union(found)), links.union(found), rejected

    def groups(self) -> DataFrame:
        """One row per input row: id, n_shingles, component_id (smallest id reachable by links)."""
        named = self.classes.select("cls", "id").join(self.roots.toDF("cls", "root"), "cls", "left").withColumn(
            "root", F.coalesce("root", "cls"))
        least = named.groupBy("root").agg(F.min("id").alias("component_id"))
        named = named.join(least, "root").select("cls", "component_id")
        return self.sets.join(named, "cls", "left").select(
            "id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per document: id, n_shingles, component_id.

    Null texts and texts without words have no n-gram and link with nothing.
    A row with a null id forms no link and has a null component_id unless it
    equals the set of a row with an id.  The id can be a struct; one that is
    never null lets every row link.  Repeated rows stay, in one component.
    An empty table gives no rows; other columns are not carried.
    """
    return NgramJoin(docs, width, percent, id_col, text_col).run().groups().withColumnRenamed("id", id_col)
