"""Array helpers for tasks that work on Arrow batches of whole texts.

Texts stay UTF-8 byte buffers: words are found and hashed for a whole slice of
documents at once with numpy, never character by character in Python.  A null
text counts as empty everywhere.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

_MULT = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_MULT, -1, 1 << 64)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (the splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_VALUE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the hash multiplier and of its inverse mod 2^64."""
    if len(_powers[0]) < n:
        size = (n >> 20) + 1 << 20
        for k, base in enumerate((_MULT, _INVERSE)):
            steps = np.full(size, np.uint64(base), np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of words ``[^\x20\x09-\x0D]+``.
NON_SPACE = np.ones(256, bool)
NON_SPACE[[9, 10, 11, 12, 13, 32]] = False


def byte_columns(column) -> tuple[np.ndarray, np.ndarray]:
    """(data, offsets) of a string or binary Arrow column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(data: np.ndarray, offsets: np.ndarray, most: int = SLICE_BYTES):
    """Yield ``(first row, last row + 1, bytes, offsets)``: whole rows, about ``most`` bytes each."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + most, side="right")) - 1
        end = min(max(end, row + 1), rows)
        yield row, end, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Polynomial prefix sums: ``span_hash`` of any byte span follows from two of them."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUE[data] * powers(len(data) + 1)[0][:-1], out=out[1:])
    return out


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans ``[start, end)``; equal bytes hash equally anywhere."""
    back = powers(len(sums))[1]
    return mix64((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def token_spans(data: np.ndarray, offsets: np.ndarray, in_word: np.ndarray):
    """Starts, ends and row numbers of the maximal runs of word bytes; none crosses a row."""
    inside = in_word[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside
    after = np.zeros(len(data) + 1, bool)
    after[:-1] = inside
    before[offsets] = False      # a row starts afresh
    after_here = after[1:].copy()
    ends_at = offsets[1:][offsets[1:] > offsets[:-1]] - 1
    after_here[ends_at] = False  # and ends with its last byte
    starts = np.flatnonzero(inside & ~before[:-1])
    ends = np.flatnonzero(inside & ~after_here) + 1
    rows = np.searchsorted(offsets, starts, side="right") - 1
    return starts, ends, rows


def word_hashes(data: np.ndarray, offsets: np.ndarray, in_word: np.ndarray = NON_SPACE):
    """Hashes of the words after A-Z is lower-cased, and the words' bounds per row."""
    data = LOWER[data]
    starts, ends, rows = token_spans(data, offsets, in_word)
    hashes = span_hash(prefix_sums(data), starts, ends)
    bounds = np.searchsorted(rows, np.arange(len(offsets)))
    return hashes, bounds


def chain_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of ``n`` consecutive items; position ``i`` covers items ``i..i+n-1``."""
    size = len(hashes) - n + 1
    if size <= 0:
        return np.empty(0, np.uint64)
    out = mix64(hashes[:size] + np.uint64(n))
    for k in range(1, n):
        out = mix64(out * np.uint64(_MULT) + hashes[k:k + size])
    return out


def bin_of(hashes: np.ndarray, bins: int) -> np.ndarray:
    """Which of ``bins`` equal ranges of the hash space each hash is in (monotone)."""
    return (((hashes >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)).astype(np.int64)


def batches(rows: dict, schema: pa.Schema, most: int = 200_000):
    """Record batches of at most ``most`` rows from equally long columns."""
    n = len(next(iter(rows.values())))
    for k in range(0, n, most):
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows[f.name][k:k + most], type=f.type) for f in schema], schema=schema)
