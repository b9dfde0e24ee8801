"""Removal of byte strings that an earlier document has, by suffix arrays.

Every window of ``length`` bytes belongs to its smallest hashed k-gram, so
equal windows of any documents belong to the same one.  Consecutive windows of
one k-gram travel together as one short string; equal strings of a pack of
documents travel once.  The strings are dealt by the k-gram's hash range.  A
range drops strings that can't share a window, sorts the suffixes of the rest
(two-stage sorting), compares neighbours and finds for each window the
smallest document that has it.  What comes back is a bit per window, per pack.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relnorm.llm.arrays import bin_of, byte_columns, mix64, powers, prefix_sums, slices, span_hash
from relnorm.llm.hash_arrays import read_columns, write_columns
from relnorm.llm.shared import bins_for, folder, staged
from relnorm.llm.suffix_array import adjacent_prefixes, suffix_array, words_at

PACK_BYTES = 3 << 20
SORT_BYTES = 1 << 20
GRAM = 12
NO_ID = np.iinfo(np.int64).max

_PACKS = pa.schema([("pack", pa.int64()), ("ids", pa.binary()), ("lens", pa.binary()), ("text", pa.binary())])
_STRINGS = pa.schema([("bin", pa.int64()), ("pack", pa.int64()), ("payload", pa.binary())])
_DONE = pa.schema([("pack", pa.int64()), ("n", pa.int64())])
_KEPT = pa.schema([("id", pa.int64()), ("n_bytes", pa.int64()),
                   ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("kept", pa.binary())])


def _pack_rows(parts):
    """Rows of about ``PACK_BYTES`` of text, the documents of each ordered by id, compressed."""
    task, number = TaskContext.get().partitionId(), 0
    squeeze = zstandard.ZstdCompressor(level=3)
    held, size = [], 0

    def row():
        nonlocal number
        held.sort()
        number += 1
        return pa.RecordBatch.from_arrays([
            pa.array([(task << 32) + number]), pa.array([np.array([h[0] for h in held], "<i8").tobytes()], pa.binary()),
            pa.array([np.array([len(h[1]) for h in held], "<i8").tobytes()], pa.binary()),
            pa.array([squeeze.compress(b"".join(h[1] for h in held))], pa.binary())], schema=_PACKS)

    for part in parts:
        ids = part.column(0).fill_null(NO_ID).to_pylist()
        for first, last, data, offsets in slices(*byte_columns(part.column(1))):
            for k in range(last - first):
                held.append((ids[first + k], data[offsets[k]:offsets[k + 1]].tobytes()))
                size += len(held[-1][1])
                if size >= PACK_BYTES:
                    yield row()
                    held, size = [], 0
    if held:
        yield row()


class Pack:
    """The strings of one pack: consecutive windows of a smallest k-gram, in a fixed order."""

    def __init__(self, ids: bytes, lens: bytes, text: bytes, length: int, bins: int):
        self.ids = np.frombuffer(ids, "<i8")
        self.offsets = np.concatenate([[0], np.cumsum(np.frombuffer(lens, "<i8"))])
        self.text = np.frombuffer(zstandard.ZstdDecompressor().decompress(text), np.uint8)
        self.start = self.count = self.doc = self.first = np.empty(0, np.int64)
        self.lead = self.bin = np.empty(0, np.int64)
        n, span = len(self.text), length - GRAM + 1
        if n < length:
            return
        sums = prefix_sums(self.text)
        grams = mix64((sums[GRAM:] - sums[:-GRAM]) * powers(n + 1)[1][:n - GRAM + 1])
        # High half: the hash; low half: the place, so that the leftmost smallest wins.
        least = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
        width = 1
        while width * 2 <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < span:
            least = np.minimum(least[:len(least) - (span - width)], least[span - width:])
        place = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
        # Windows within one document only.
        usable = np.maximum(np.diff(self.offsets) - length + 1, 0)
        windows = np.repeat(self.offsets[:-1] - np.concatenate([[0], np.cumsum(usable)[:-1]]), usable) + np.arange(usable.sum())
        if not len(windows):
            return
        place = place[windows]
        heads = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (windows[1:] != windows[:-1] + 1)]))
        self.start, self.count = windows[heads], np.diff(np.append(heads, len(windows)))
        self.doc = np.searchsorted(self.offsets, self.start, side="right") - 1
        self.lead = place[heads] - self.start
        names = span_hash(sums, self.start, self.start + self.count + length - 1)
        self.bin = bin_of(mix64(grams[place[heads]]), bins)
        # Equal strings of the pack are one: the first, which has the smallest id.
        order = np.argsort(names, kind="stable")
        fresh = np.concatenate([[True], names[order][1:] != names[order][:-1]])
        first = order[np.flatnonzero(fresh)][np.cumsum(fresh) - 1]
        self.first = np.empty(len(order), np.int64)
        self.first[order] = first
        sent = np.flatnonzero(self.first == np.arange(len(order)))
        self.sent = sent[np.argsort(self.bin[sent], kind="stable")]
        self.bounds = np.searchsorted(self.bin[self.sent], np.arange(bins + 1))


def _ranges(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """All indices of the ranges ``start..start+len-1``, one after the other."""
    return np.repeat(starts - np.concatenate([[0], np.cumsum(lens)[:-1]]), lens) + np.arange(lens.sum())


def _planes(x: np.ndarray) -> bytes:
    """64-bit integers byte plane by byte plane, which compresses small ones well."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8).T).tobytes()


def _send(length: int, bins: int):
    def run(parts):
        squeeze = zstandard.ZstdCompressor(level=5)
        for part in parts:
            for number, *columns in zip(*(c.to_pylist() for c in part.columns)):
                pack = Pack(*columns, length, bins)
                if not len(pack.start):
                    continue
                used, payloads = [], []
                for b in np.flatnonzero(np.diff(pack.bounds)):
                    lo, hi = pack.bounds[b], pack.bounds[b + 1]
                    some = pack.sent[lo:hi]
                    text = pack.text[_ranges(pack.start[some], pack.count[some] + length - 1)]
                    payloads.append(np.int64(hi - lo).tobytes() + squeeze.compress(
                        pack.count[some].astype(np.uint8).tobytes() + pack.lead[some].astype(np.uint8).tobytes()
                        + _planes(np.diff(pack.ids[pack.doc[some]].view("<u8"), prepend=np.uint64(0))) + text.tobytes()))
                    used.append(int(b))
                for k in range(0, len(used), 64):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(used[k:k + 64], pa.int64()), pa.array([number] * len(used[k:k + 64]), pa.int64()),
                         pa.array(payloads[k:k + 64], pa.binary())], schema=_STRINGS)
    return run


def _unpack(payload: bytes):
    n = int(np.frombuffer(payload, "<i8", 1)[0])
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(payload[8:]), np.uint8)
    steps = np.ascontiguousarray(raw[2 * n:10 * n].reshape(8, n).T).view("<u8").ravel()
    return raw[:n].astype(np.int64), raw[n:2 * n].astype(np.int64), np.cumsum(steps, dtype=np.uint64).view("<i8"), raw[10 * n:]


def _window_names(words: np.ndarray, windows: np.ndarray, length: int) -> np.ndarray:
    """Hashes of the ``length`` bytes at each place, from the eight bytes at every place."""
    out = np.full(len(windows), length, np.uint64)
    for skip in [*range(0, length - 7, 8), length - 8]:
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + words[windows + skip])
    return out


def _repeated(keys: np.ndarray, owner: np.ndarray | None = None) -> np.ndarray:
    """Whether each key occurs more than once, with different owners if these are given."""
    order = np.argsort(keys, kind="stable")
    fresh = np.concatenate([[True], keys[order][1:] != keys[order][:-1]])
    heads = np.flatnonzero(fresh)
    if owner is None:
        many = np.diff(np.append(heads, len(keys))) > 1
    else:
        owner = owner[order]
        many = np.minimum.reduceat(owner, heads) != np.maximum.reduceat(owner, heads)
    out = np.empty(len(keys), bool)
    out[order] = many[np.cumsum(fresh) - 1]
    return out


def covered_windows(text: np.ndarray, starts: np.ndarray, counts: np.ndarray, ids: np.ndarray, length: int) -> np.ndarray:
    """A bit per window of each string: whether a string of a smaller id has the window too.

    String ``k`` is ``text[starts[k]:]`` with ``counts[k]`` windows (64 at most
    and no more than ``length + 1``, so that its first and last one are all of it).
    """
    lens = counts + length - 1
    words = words_at(text)
    names = _window_names(words, starts, length) * np.uint64(3) + _window_names(words, starts + counts - 1, length)
    _, alone, whose = np.unique(names + counts.astype(np.uint64), return_index=True, return_inverse=True)
    least = np.full(len(alone), NO_ID)
    np.minimum.at(least, whose, ids)
    chars = text[_ranges(starts[alone], lens[alone])]
    begins = np.concatenate([[0], np.cumsum(lens[alone])])[:-1]
    string = np.repeat(np.arange(len(alone)), counts[alone])
    windows = _ranges(begins, counts[alone])
    words = words_at(chars)
    order = suffix_array(chars, length, words)
    at_window = np.full(len(chars), -1, np.int64)
    at_window[windows] = np.arange(len(windows))
    order = order[at_window[order] >= 0]
    heads = np.flatnonzero(adjacent_prefixes(words, order, length) < length)
    smallest = np.minimum.reduceat(least[string[at_window[order]]], heads)
    found = np.empty(len(windows), np.int64)
    found[at_window[order]] = np.repeat(smallest, np.diff(np.append(heads, len(order))))
    first = np.concatenate([[0], np.cumsum(counts[alone])])[:-1]
    each = _ranges(first[whose], counts)
    owner = np.repeat(np.arange(len(starts)), counts)
    within = _ranges(np.zeros(len(starts), np.int64), counts)
    bits = (found[each] < ids[owner]).astype(np.uint64) << within.astype(np.uint64)
    return np.bitwise_or.reduceat(bits, np.concatenate([[0], np.cumsum(counts)])[:-1])


def _judge(text: np.ndarray, starts: np.ndarray, counts: np.ndarray, ids: np.ndarray, length: int) -> np.ndarray:
    """``covered_windows``, sorting only the strings that share a window with another one."""
    lens = counts + length - 1
    chars = text[_ranges(starts, lens)]
    begins = np.concatenate([[0], np.cumsum(lens)])[:-1]
    owner = np.repeat(np.arange(len(starts)), counts)
    shared = _repeated(_window_names(words_at(chars), _ranges(begins, counts), length), owner)
    keep = np.flatnonzero(np.bincount(owner, shared, len(starts)) > 0)
    masks = np.zeros(len(starts), np.uint64)
    if len(keep):
        masks[keep] = covered_windows(chars, begins[keep], counts[keep], ids[keep], length)
    return masks


def _compare(length: int):
    """One k-gram range: which windows of which pack's strings a smaller document has."""
    def run(table: pa.Table) -> pa.Table:
        at = table.column("bin")[0].as_py()
        packs = table.column("pack").to_numpy()
        counts, leads, ids, texts = zip(*map(_unpack, table.column("payload").to_pylist()))
        sizes = np.array([len(c) for c in counts])
        counts, leads, ids, text = (np.concatenate(c) for c in (counts, leads, ids, texts))
        lens = counts + length - 1
        starts = np.concatenate([[0], np.cumsum(lens)])[:-1]
        row = np.repeat(np.arange(len(packs)), sizes)
        place = np.arange(len(counts)) - np.repeat(np.concatenate([[0], np.cumsum(sizes)])[:-1], sizes)
        names = np.zeros(len(counts), np.uint64)
        for k in range(GRAM):
            names = names * np.uint64(0x100000001B3) + text[starts + leads + k]
        names = mix64(names)
        may = np.flatnonzero(_repeated(names))
        masks = np.zeros(len(counts), np.uint64)
        # Strings of one k-gram stay together; several rounds keep the sorted text small.
        rounds = int(lens[may].sum()) // SORT_BYTES + 1
        turn = (names[may] % np.uint64(rounds)).astype(np.int64)
        may = may[np.argsort(turn, kind="stable")]
        for some in np.split(may, np.cumsum(np.bincount(turn, minlength=rounds))[:-1]):
            if len(some):
                masks[some] = _judge(text, starts[some], counts[some], ids[some], length)
        hit = np.flatnonzero(masks)
        bounds = np.searchsorted(row[hit], np.arange(len(packs) + 1))
        rows = [(at, int(packs[k]), np.ascontiguousarray(place[hit[lo:hi]].astype("<u4")).tobytes()
                 + masks[hit[lo:hi]].tobytes())
                for k, (lo, hi) in enumerate(zip(bounds[:-1], bounds[1:])) if hi > lo]
        return pa.Table.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(_STRINGS)], schema=_STRINGS)
    return run


def _store_masks(path: str):
    """One pack's masks as a file: range, place within it, mask."""
    def run(table: pa.Table) -> pa.Table:
        pack = table.column("pack")[0].as_py()
        bins, places, masks = [], [], []
        for b, payload in zip(table.column("bin").to_pylist(), table.column("payload").to_pylist()):
            n = len(payload) // 12
            bins.append(np.full(n, b, "<i8"))
            places.append(np.frombuffer(payload, "<u4", n).astype("<i8"))
            masks.append(np.frombuffer(payload, "<u8", n, 4 * n))
        write_columns(f"{path}/{pack}", [np.concatenate(c) for c in (bins, places, masks)])
        return pa.Table.from_pydict({"pack": [pack], "n": [sum(map(len, bins))]}, schema=_DONE)
    return run


def _clean(path: str, length: int, bins: int):
    def run(parts):
        for part in parts:
            for number, *columns in zip(*(c.to_pylist() for c in part.columns)):
                pack = Pack(*columns, length, bins)
                removed = np.zeros(len(pack.text) + 1, np.int32)
                if len(pack.start):
                    ranges, places, found = read_columns(f"{path}/{number}", 3)
                    masks = np.zeros(len(pack.start), np.uint64)
                    masks[pack.sent[pack.bounds[ranges.astype(np.int64)] + places.astype(np.int64)]] = found
                    masks = masks[pack.first]
                    masks[pack.ids[pack.doc] > pack.ids[pack.doc[pack.first]]] = np.uint64(0xFFFFFFFFFFFFFFFF)
                    hit = np.flatnonzero(masks)
                    within = _ranges(np.zeros(len(hit), np.int64), pack.count[hit])
                    window = np.repeat(pack.start[hit], pack.count[hit]) + within
                    bit = (np.repeat(masks[hit], pack.count[hit]) >> within.astype(np.uint64)) & np.uint64(1)
                    window = window[bit.astype(bool)]
                    removed += np.bincount(window, minlength=len(removed)).astype(np.int32)
                    removed -= np.bincount(window + length, minlength=len(removed)).astype(np.int32)
                gone = np.cumsum(removed[:-1]) > 0
                before = np.concatenate([[False], gone[:-1]])
                before[pack.offsets[:-1][pack.offsets[:-1] < len(gone)]] = False
                after = np.concatenate([gone[1:], [False]])
                last = pack.offsets[1:][np.diff(pack.offsets) > 0] - 1
                after[last] = False
                begin, end = np.flatnonzero(gone & ~before), np.flatnonzero(gone & ~after) + 1
                doc = np.searchsorted(pack.offsets, begin, side="right") - 1
                spans = pa.StructArray.from_arrays(
                    [pa.array((begin - pack.offsets[doc]).astype(np.int32)), pa.array((end - pack.offsets[doc]).astype(np.int32))],
                    fields=list(_KEPT.field("spans").type.value_type))
                bounds = np.searchsorted(doc, np.arange(len(pack.ids) + 1)).astype(np.int32)
                kept = pack.text[~gone].tobytes()
                left = np.concatenate([[0], np.cumsum(~gone)])[pack.offsets]
                for lo in range(0, len(pack.ids), 2000):
                    hi = min(lo + 2000, len(pack.ids))
                    ids = pack.ids[lo:hi]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids, mask=ids == NO_ID), pa.array(np.diff(pack.offsets)[lo:hi]),
                         pa.ListArray.from_arrays(pa.array(bounds[lo:hi + 1]), spans).cast(_KEPT.field("spans").type),
                         pa.array([kept[a:b] for a, b in zip(left[lo:hi], left[lo + 1:hi + 1])], pa.binary())], schema=_KEPT)
    return run


def remove_repeats(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_bytes, spans (removed byte ranges), kept (remaining bytes).

    A byte goes if a string of ``length`` bytes around it also starts in a
    document with a smaller id; all strings are judged on the input.  A null
    text is empty, a text shorter than ``length`` keeps all.  Repeated rows of
    one id don't clean each other.  A null id counts as larger than any other.
    An empty table gives no rows; other columns are not carried.
    """
    if not GRAM + 7 < length <= GRAM + 63:
        raise ValueError(f"length must lie between {GRAM + 8} and {GRAM + 63}")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    bins = bins_for(docs.sparkSession, rows, 8 << 20)
    packs = staged(rows.mapInArrow(_pack_rows, "pack long, ids binary, lens binary, text binary"), "packs")
    strings = packs.mapInArrow(_send(length, bins), "bin long, pack long, payload binary")
    masks = strings.groupBy("bin").applyInArrow(_compare(length), "bin long, pack long, payload binary")
    path = folder(docs.sparkSession, "masks")
    # Every pack has a row, so that each has a file, an empty one too.
    every = packs.select(F.lit(0).cast("long").alias("bin"), "pack", F.lit(b"").alias("payload"))
    masks.union(every).groupBy("pack").applyInArrow(_store_masks(path), "pack long, n long").agg(F.sum("n")).collect()
    return packs.mapInArrow(_clean(path, length, bins), "id long, n_bytes long, "
                            "spans array<struct<start:int,end:int>>, kept binary").withColumnRenamed("id", id_col)
