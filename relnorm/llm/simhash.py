"""SimHash near-duplicates by a byte-position inverted index with count filtering.

A fingerprint is eight positional bytes.  Two that differ in at most ``bits``
bits share at least ``8 - bits`` of them, so, with the bytes of each ordered
rare first, their prefixes of ``bits + depth`` bytes share at least ``depth``.
The index lists fingerprints under every ``depth`` bytes of their prefix;
``depth`` follows the number of fingerprints, and lists that are still long
are indexed again at the full depth.  Within a list the shared positional
bytes of each pair are tallied, pairs that reach ``8 - bits`` are verified on
their bits, and only a spanning forest of the links leaves the task.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relnorm.llm.arrays import LOWER, batches, byte_columns
from relnorm.llm.components import components
from relnorm.llm.dealing import cells, join_class, spread
from relnorm.llm.shared import staged

BYTES = 8
SEED = 42
PIECE_BYTES = 1 << 20
FULL_DEPTH = 5
LIST_LIMIT = 4096
PER_BIN = 200_000
SMALL_CELL = 16
STRIP = 256

_LOWER = LOWER.tobytes()
_SPACE = b" \t\n\r\x0b\x0c"
_ENTRY = pa.schema([("key", pa.int64()), ("fingerprint", pa.int64())])
_LINK = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def _pieces(text: bytes):
    """``text`` in pieces of about a megabyte that end at white space."""
    at = 0
    while len(text) - at > PIECE_BYTES:
        cut = at + PIECE_BYTES
        while cut < len(text) and text[cut] not in _SPACE:
            cut += 1
        yield text[at:cut]
        at = cut
    yield text[at:]


def shingle_hashes(text: bytes, width: int):
    """Arrays of the XXH64 of all ``width``-word shingles of a text, repeats included, piece by piece."""
    digest, held, whole = xxhash.xxh64_intdigest, [], True
    for piece in _pieces(text):
        words = held + piece.translate(_LOWER).split()
        if len(words) >= width:
            joined = b" ".join(words)
            ends = np.cumsum([len(w) + 1 for w in words])
            starts = np.concatenate([[0], ends[:len(words) - width]]).tolist()
            ends = (ends[width - 1:] - 1).tolist()
            yield np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends)], np.uint64)
            words, whole = words[len(words) - width + 1:] if width > 1 else [], False
        held = words
    if whole and held:
        yield np.array([digest(b" ".join(held), SEED)], np.uint64)


def fingerprint(text: bytes, width: int = 3) -> int:
    """The 64-bit SimHash: a bit is 1 if more than half of the shingles' hashes have it; 0 without words."""
    ones, n = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(text, width):
        for k in range(0, len(hashes), 1 << 15):
            some = hashes[k:k + (1 << 15)].astype(">u8")
            ones += np.unpackbits(some.view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
        n += len(hashes)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big") if n else 0


def _fingerprints(width: int):
    def run(parts):
        for part in parts:
            data, offsets = byte_columns(part.column(1))
            data, out = data.tobytes(), []
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                out.append(fingerprint(data[a:b], width))
            values = np.array(out, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), pa.array(values)],
                                             names=["id", "fingerprint"])
    return run


def tokens(values: np.ndarray) -> np.ndarray:
    """The eight positional bytes of each fingerprint as numbers ``256 * position + byte``."""
    return values.astype("<u8").view(np.uint8).reshape(-1, BYTES).astype(np.int64) + 256 * np.arange(BYTES)


def _token_counts(parts):
    counts = np.zeros(256 * BYTES, np.int64)
    for part in parts:
        counts += np.bincount(tokens(part.column(0).to_numpy()).ravel(), minlength=256 * BYTES)
    yield from batches({"token": np.flatnonzero(counts), "n": counts[counts > 0]},
                       pa.schema([("token", pa.int64()), ("n", pa.int64())]))


def _entries(rank: np.ndarray, depth: int, bits: int):
    """Index entries: a key for every ``depth`` tokens among the ``bits + depth`` rarest of a fingerprint."""
    def run(parts):
        for part in parts:
            for k in range(0, part.num_rows, 20_000):
                values = part.column(0).slice(k, 20_000).to_numpy()
                rare = np.sort(rank[tokens(values)], axis=1)[:, :bits + depth]
                # Ranks take 11 bits, so that up to five name the key exactly.
                for chosen in combinations(range(bits + depth), depth):
                    key = np.zeros(len(values), np.int64)
                    for c in chosen:
                        key = (key << 11) | rare[:, c]
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(values)], schema=_ENTRY)
    return run


def near_pairs(x: np.ndarray, y: np.ndarray, bits: int) -> np.ndarray:
    """Count filter and check for aligned fingerprints: enough shared positional bytes, then at most ``bits`` bits."""
    differ = np.ascontiguousarray(x ^ y)
    shared = (differ.view(np.uint8).reshape(*differ.shape, BYTES) == 0).sum(-1, dtype=np.int8)
    out = shared >= BYTES - bits
    out[out] = np.bitwise_count(differ[out]) <= bits
    return out


class Forest:
    """Connected sets of 0..n-1; ``label`` holds each one's root."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def unite(self, a: np.ndarray, b: np.ndarray) -> None:
        """Add links, all at once: roots hook to smaller roots until nothing changes."""
        label = self.label
        while True:
            x, y = label[a], label[b]
            open_ = x != y
            if not open_.any():
                return
            a, b, x, y = a[open_], b[open_], x[open_], y[open_]
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            while True:
                jumped = label[label]
                if np.array_equal(jumped, label):
                    break
                label[:] = jumped


def _cell_links(values: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is linked in one large cell; tallied strip by strip, never all pairs at once."""
    forest = Forest(len(values))
    for k in range(0, len(values), STRIP):
        rows = np.arange(k, min(k + STRIP, len(values)))
        near = near_pairs(values[rows][:, None], values[None, k:], bits)
        while True:
            left = near & (forest.label[rows][:, None] != forest.label[None, k:])
            hit_rows, hit_columns = left.any(1), left.any(0)
            if not hit_rows.any():
                break
            # One link per row and per column halves the parts that are still apart.
            forest.unite(np.concatenate([rows[hit_rows], rows[left.argmax(0)[hit_columns]]]),
                         np.concatenate([left.argmax(1)[hit_rows] + k, np.flatnonzero(hit_columns) + k]))
    apart = np.flatnonzero(forest.label != np.arange(len(values)))
    return apart, forest.label[apart]


def _bin_links(bits: int):
    def run(table: pa.Table) -> pa.Table:
        cell, values = table.column("cell").to_numpy(), table.column("fingerprint").to_numpy().view(np.uint64)
        names, index = np.unique(values, return_inverse=True)
        order = np.lexsort((values, cell))
        cell, values, index = cell[order], values[order], index[order]
        starts = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
        sizes = np.diff(np.append(starts, len(cell)))
        small = np.repeat(sizes <= SMALL_CELL, sizes)
        a, b = [], []
        for step in range(1, min(SMALL_CELL, int(sizes.max(initial=1)))):
            at = np.flatnonzero(small[:-step] & (cell[step:] == cell[:-step]))
            if not len(at):
                break
            at = at[near_pairs(values[at], values[at + step], bits)]
            a.append(index[at])
            b.append(index[at + step])
        for start, size in zip(starts[sizes > SMALL_CELL].tolist(), sizes[sizes > SMALL_CELL].tolist()):
            here = slice(start, start + size)
            x, y = _cell_links(values[here], bits)
            a.append(index[here][x])
            b.append(index[here][y])
        forest = Forest(len(names))
        if a:
            forest.unite(np.concatenate(a), np.concatenate(b))
        apart = np.flatnonzero(forest.label != np.arange(len(names)))
        names = names.view(np.int64)
        return pa.Table.from_arrays([pa.array(names[apart]), pa.array(names[forest.label[apart]])], schema=_LINK)
    return run


def fingerprint_links(fingerprints: DataFrame, bits: int = 3, limit: int = LIST_LIMIT,
                      per_bin: int = PER_BIN) -> DataFrame:
    """(u, v): links that connect all fingerprints (a written table of one distinct long each) within ``bits`` bits.

    Every two fingerprints at that distance are in one component of the
    result, and no others are.
    """
    if not 0 <= bits <= 3:
        raise ValueError("bits must be from 0 to 3")
    total = fingerprints.count()
    counted = (fingerprints.mapInArrow(_token_counts, "token long, n long").groupBy("token")
               .agg(F.sum("n").alias("n")).toArrow())  # at most 2048 rows
    counts = np.zeros(256 * BYTES, np.int64)
    counts[counted.column("token").to_numpy()] = counted.column("n").to_numpy()
    rank = np.empty(256 * BYTES, np.int64)
    rank[np.argsort(counts, kind="stable")] = np.arange(256 * BYTES)
    depth = min(FULL_DEPTH, max(2, -(-max(total, 1).bit_length() // 8)))

    def index(members: DataFrame, at: int) -> DataFrame:
        return members.mapInArrow(_entries(rank, at, bits), "key long, fingerprint long")

    entries = index(fingerprints, depth)
    counts = entries.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    long_ = staged(counts.where(F.col("n") > limit).select("key"), "long")
    n_long = long_.count()
    long_ = F.broadcast(long_) if n_long <= 100_000 else long_
    bins = spread(fingerprints, total * comb(bits + depth, depth), per_bin)
    met = entries.join(long_, "key", "left_anti").select(
        F.pmod(F.xxhash64("key"), F.lit(bins)).alias("bin"), F.col("key").alias("cell"), "fingerprint")
    if n_long:
        # Members of long lists are told apart by more of their bytes, and what is still long is cut into blocks.
        members = staged(entries.join(long_, "key", "left_semi").select("fingerprint").distinct(), "members")
        met = met.union(cells(index(members, FULL_DEPTH), members.count() * comb(bits + FULL_DEPTH, FULL_DEPTH),
                              "fingerprint", limit, per_bin))
    return staged(met.groupBy("bin").applyInArrow(_bin_links(bits), "u long, v long").distinct(), "links")


def simhash_groups(docs: DataFrame, width: int = 3, bits: int = 3, id_col: str = "doc_id", text_col: str = "text",
                   limit: int = LIST_LIMIT, per_bin: int = PER_BIN) -> DataFrame:
    """One row per input row: id, fingerprint (16 lowercase hex digits), component_id.

    ``component_id`` is the smallest id reachable over fingerprints that differ
    in at most ``bits`` bits, the row's own included.  A null text, an empty
    one and one without words have fingerprint zero and link like any other.
    A null id never names a component: it is null only where no row of the
    component has an id.  Repeated rows stay, each with its row.  An empty
    table gives no rows.  Further columns of the input are not carried.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = staged(rows.mapInArrow(_fingerprints(width), "id long, fingerprint long"), "fingerprints")
    classes = staged(rows.groupBy("fingerprint").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n_rows")),
                     "classes")
    links = fingerprint_links(classes.select("fingerprint"), bits, limit, per_bin)
    roots = components(links).toDF("fingerprint", "root")
    named = classes.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = staged(named.join(least, "root").select("fingerprint", "component_id", "n_rows"), "named")
    return join_class(rows, named, "fingerprint").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")
