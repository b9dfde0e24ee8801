"""Suffix arrays by two-stage sorting, to a bounded depth, with numpy.

Stage one sorts only the suffixes that are smaller than their successors.
Stage two scans the buckets of first bytes in order and induces all others:
scanning a bucket yields, in their final order, the suffixes that one larger
byte precedes.
"""

from __future__ import annotations

import numpy as np


def words_at(text: np.ndarray) -> np.ndarray:
    """For every position the next eight bytes as a big-endian integer (zeros beyond the end)."""
    padded = np.zeros(len(text) + 8, np.uint8)
    padded[:len(text)] = text
    out = np.zeros(len(text) + 1, np.uint64)
    for k in range(8):
        out = (out << np.uint64(8)) | padded[k:k + len(out)]
    return out


def smaller_than_successor(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one after it; the empty suffix is smallest."""
    if not len(text):
        return np.zeros(0, bool)
    ends = np.append(np.flatnonzero(text[1:] != text[:-1]), len(text) - 1)  # last of each run of equal bytes
    rises = np.zeros(len(ends), bool)
    rises[:-1] = text[ends[:-1]] < text[ends[:-1] + 1]
    return np.repeat(rises, np.diff(np.append(-1, ends)))


def _sorted_directly(at: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """``at`` in the order of the suffixes' first ``depth`` bytes, eight at a time; only ties are read on."""
    last = len(words) - 1
    keys = words[at]
    order = np.argsort(keys, kind="stable")
    at, keys = at[order], keys[order]
    group = np.concatenate([[0], np.cumsum(keys[1:] != keys[:-1])]) if len(at) else np.empty(0, np.int64)
    for skip in range(8, depth, 8):
        size = np.bincount(group) if len(at) else np.empty(0, np.int64)
        tied = np.flatnonzero(size[group] > 1) if len(at) else np.empty(0, np.int64)
        if not len(tied):
            break
        keys = words[np.minimum(at[tied] + skip, last)]
        order = np.lexsort((keys, group[tied]))
        at[tied], keys = at[tied][order], keys[order]
        split = np.zeros(len(at), bool)
        own = group[tied]
        split[tied[1:]] = (own[1:] == own[:-1]) & (keys[1:] != keys[:-1])
        group = group + np.cumsum(split)
    return at


def suffix_array(text: np.ndarray, depth: int, words: np.ndarray | None = None) -> np.ndarray:
    """Positions of all suffixes of ``text`` in the order of at least their first ``depth`` bytes."""
    n = len(text)
    if not n:
        return np.empty(0, np.int64)
    words = words_at(text) if words is None else words
    direct = _sorted_directly(np.flatnonzero(smaller_than_successor(text)), words, depth)
    sizes = np.bincount(text, minlength=256)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    bounds = np.searchsorted(text[direct], np.arange(257))
    out = np.empty(n, np.int64)
    filled = starts[:-1].copy()

    def induce(scanned: np.ndarray, byte: int) -> None:
        """Place what a byte larger than ``byte`` precedes, in the scanned order."""
        before = scanned[scanned > 0] - 1
        first = text[before]
        larger = first > byte
        before, first = before[larger], first[larger]
        order = np.argsort(first, kind="stable")
        before, counts = before[order], np.bincount(first, minlength=256)
        at = 0
        for b in np.flatnonzero(counts):
            out[filled[b]:filled[b] + counts[b]] = before[at:at + counts[b]]
            filled[b] += counts[b]
            at += counts[b]

    induce(np.array([n]), -1)
    for byte in np.flatnonzero(sizes):
        run = out[starts[byte]:filled[byte]]
        while len(run):  # the bucket's own runs of one byte, a step longer each time
            run = run[run > 0] - 1
            run = run[text[run] == byte]
            out[filled[byte]:filled[byte] + len(run)] = run
            filled[byte] += len(run)
        own = direct[bounds[byte]:bounds[byte + 1]]
        out[filled[byte]:filled[byte] + len(own)] = own
        induce(out[starts[byte]:starts[byte + 1]], byte)
    return out


def adjacent_prefixes(words: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Length of the common prefix of each suffix and the one before it in ``order``, at most ``depth``."""
    out = np.zeros(len(order), np.int64)
    last = len(words) - 1
    going = np.arange(1, len(order))
    for skip in range(0, depth, 8):
        if not len(going):
            break
        differ = words[np.minimum(order[going] + skip, last)] ^ words[np.minimum(order[going - 1] + skip, last)]
        same = np.full(len(going), 8, np.int64)
        some = differ != 0
        # whole equal bytes before the highest differing bit
        high = np.zeros(len(going), np.int64)
        for bits in (32, 16, 8):
            larger = (differ >> np.uint64(bits)) != 0
            high[larger] += bits
            differ = np.where(larger, differ >> np.uint64(bits), differ)
        same[some] = 7 - high[some] // 8
        out[going] += same
        going = going[~some]
    return np.minimum(out, depth)
