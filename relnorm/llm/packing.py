"""Packing documents into sequences by shortest-pack-first over the length histogram.

A document of ``n`` ids fills ``n // size`` whole sequences; what is left of
it joins a histogram of at most ``size - 1`` lengths.  The histogram alone is
packed: lengths longest first, each into the open packs with the most room,
as counts of packing patterns.  Documents find their place by their rank among
those of the same length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from relnorm.llm.shared import staged

RANK_GROUPS = 64

_IDS = pa.schema([("row_id", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("ids", pa.binary())])
_PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                     ("ids", pa.binary()), ("doc_tokens", pa.int64()),
                     ("sequence_id", pa.int64()), ("offset", pa.int64())])


#: Texts of these characters only take the short way: ASCII without odd controls, and Latin-1 letters.
_PLAIN = re.compile(r"[\x00-\x1b\x20-\x7f\xc0-\xd6\xd8-\xf6\xf8-\xff]*")
# The tokenizer's own split, and the same written for lower-cased plain texts.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^ \t\n\r\x0b\x0ca-z0-9\xdf-\xf6\xf8-\xff]+")


def encoder(path: str, end_id: int, cached_bytes: int = 100 << 20):
    """``text -> bytes`` of little-endian 32-bit ids, the end id last.

    The tokenizer never joins what its first split separates.  Plain texts are
    split the same way here and every distinct piece is encoded once: unknown
    pieces in one call, cut where the vocabulary marks the end of a word.
    Other texts are encoded by their runs between ASCII white space.  What is
    remembered is forgotten when it takes about ``cached_bytes``.
    """
    import json
    from tokenizers import Tokenizer, normalizers, pre_tokenizers
    with open(path, encoding="utf-8") as f:
        told = json.load(f)
    first = ((told.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
    if told["model"].get("end_of_word_suffix") != "</w>" or (first.get("pattern") or {}).get("Regex") != _SPLIT:
        raise ValueError(f"{path}: only a vocabulary with word ends and the split that is written out here can be used")
    tokenizer, plain = Tokenizer.from_file(path), Tokenizer.from_file(path)
    # Pieces are normalised and split already: the model alone is needed for them.
    plain.normalizer = normalizers.Sequence([])
    plain.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    vocabulary = tokenizer.get_vocab()
    last = np.zeros(max(vocabulary.values()) + 1, bool)
    last[[number for token, number in vocabulary.items() if token.endswith("</w>")]] = True
    pieces_known: dict[str, bytes] = {}
    runs_known: dict[str, bytes] = {}
    held = {id(pieces_known): 0, id(runs_known): 0}
    end = int(end_id).to_bytes(4, "little")
    spaces = str.maketrans("\t\n\r", "   ")

    def learn_pieces(new: list[str]) -> None:
        ids = np.array(plain.encode(" ".join(new), add_special_tokens=False).ids, "<u4")
        cuts = np.flatnonzero(last[ids]) + 1
        if len(cuts) == len(new) and (not len(ids) or cuts[-1] == len(ids)):
            blob, at = ids.tobytes(), 0
            for piece, cut in zip(new, cuts.tolist()):
                pieces_known[piece] = blob[4 * at:4 * cut]
                at = cut
        else:
            learn_runs(new, pieces_known)

    def learn_runs(new: list[str], known: dict[str, bytes]) -> None:
        for run, got in zip(new, tokenizer.encode_batch(new, add_special_tokens=False)):
            known[run] = np.asarray(got.ids, "<u4").tobytes()

    def encode(text: str | None) -> bytes:
        if not text:
            return end
        if "<|" not in text and _PLAIN.fullmatch(text):
            parts, known, learn = _PIECE.findall(text.lower()), pieces_known, learn_pieces
        else:
            parts, known, learn = text.translate(spaces).split(" "), runs_known, lambda new: learn_runs(new, runs_known)
        new = list(set(parts).difference(known))
        if new:
            cost = 200 * len(new) + 4 * sum(map(len, new))
            if held[id(known)] + cost > cached_bytes:
                known.clear()
                new = list(set(parts))
                held[id(known)], cost = 0, 200 * len(new) + 4 * sum(map(len, new))
            held[id(known)] += cost
            learn(new)
        return b"".join(map(known.__getitem__, parts)) + end
    return encode


def _encode_rows(path: str, end_id: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tokenizers
        # One encoder, with what it remembers, serves all tasks of a Python worker.
        kept = vars(tokenizers).setdefault("_encoders_of_this_worker", {})
        encode = kept.get((path, end_id)) or kept.setdefault((path, end_id), encoder(path, end_id))
        for part in parts:
            for k in range(0, part.num_rows, 256):
                some = part.slice(k, 256)
                ids = [encode(t) for t in some.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(1), pa.array([len(b) // 4 for b in ids], pa.int64()),
                     pa.array(ids, pa.binary())], schema=_IDS)
    return run


def pack_histogram(histogram: dict[int, int], size: int) -> list[tuple[int, tuple[int, ...]]]:
    """Packing patterns ``(count, lengths)`` for ``{length: count}``; shortest pack first."""
    room: dict[int, list[list]] = {}
    top: list[int] = []  # rooms in use, ascending

    def put(space: int, count: int, lengths: tuple[int, ...]) -> None:
        if space not in room:
            room[space] = []
            top.insert(int(np.searchsorted(top, space)) if top else 0, space)
        room[space].append([count, lengths])

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        placed = []  # this length's own packs open only to shorter ones until it is used up
        while left:
            if top and top[-1] >= length:
                space = top[-1]
                pack = room[space][-1]
                used = min(left, pack[0])
                placed.append((space - length, used, pack[1] + (length,)))
                pack[0] -= used
                left -= used
                if not pack[0]:
                    room[space].pop()
                    if not room[space]:
                        del room[space]
                        top.pop()
                if top and top[-1] >= length:
                    continue
                for p in placed:
                    put(*p)
                placed = []
            elif placed:
                for p in placed:
                    put(*p)
                placed = []
            else:
                fresh = -(-left // max(1, size // length))
                used = min(left, fresh)
                put(size - length, used, (length,))
                left -= used
        for p in placed:
            put(*p)
    return [(count, lengths) for packs in room.values() for count, lengths in packs]


def _places(patterns: list[tuple[int, tuple[int, ...]]]) -> dict[str, np.ndarray]:
    """Rank ranges of each length: where the rank-th document of a length lies."""
    taken: dict[int, int] = {}
    rows, base = [], 0
    for count, lengths in patterns:
        at = 0
        for length in lengths:
            rank = taken.get(length, 0)
            rows.append((length, rank, base, at))
            taken[length] = rank + count
            at += length
        base += count
    rows.sort()
    cols = np.array(rows, np.int64).reshape(-1, 4)
    return {"length": cols[:, 0], "rank": cols[:, 1], "base": cols[:, 2], "at": cols[:, 3], "packs": base}


def _histogram(groups: pa.Table) -> dict[int, int]:
    """Documents of each length but 0, of sorted groups (tail, part, rows, full)."""
    lengths, at = np.unique(groups.column("tail").to_numpy(), return_inverse=True)
    counts = np.bincount(at, groups.column("rows").to_numpy(), len(lengths)).astype(np.int64)
    return {k: n for k, n in zip(lengths.tolist(), counts.tolist()) if k}


def _offsets(groups: pa.Table) -> pa.Table:
    """Of sorted groups (tail, part, rows, full): the rows before in the same tail, the whole sequences before in all."""
    tail, rows, full = (groups.column(k).to_numpy() for k in ("tail", "rows", "full"))
    before = np.cumsum(rows) - rows
    rank0 = before - before[np.searchsorted(tail, tail)]
    return pa.table({"tail": groups.column("tail"), "part": groups.column("part"), "rank0": pa.array(rank0, pa.int64()),
                     "full0": pa.array(np.cumsum(full) - full, pa.int64())})


def _emit(places: dict, size: int):
    lengths, ranks, bases, ats, packs = (places[k] for k in ("length", "rank", "base", "at", "packs"))
    bounds = np.searchsorted(lengths, np.arange(size + 1))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p.slice(k, 512) for p in parts for k in range(0, p.num_rows, 512)):
            doc, n, ids, rank, whole = (part.column(k).to_pylist() for k in range(5))
            out: list[tuple] = []
            for d, total, blob, r, w in zip(doc, n, ids, rank, whole):
                for k in range(total // size):
                    out.append((d, size * k, size, blob[4 * size * k:4 * size * (k + 1)], total, packs + w + k, 0))
                tail = total % size
                if tail:
                    lo, hi = bounds[tail], bounds[tail + 1]
                    j = lo + int(np.searchsorted(ranks[lo:hi], r, side="right")) - 1
                    out.append((d, total - tail, tail, blob[4 * (total - tail):], total,
                                int(bases[j] + r - ranks[j]), int(ats[j])))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*out), _PIECES)], schema=_PIECES)
    return run


def pack(docs: DataFrame, tokenizer_path: str, size: int = 2048, end_id: int = 1,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of every document, each with its ids (little-endian, 32 bits) and its place in a sequence.

    Columns: doc_id, start, length, ids, doc_tokens, sequence_id, offset; a
    sequence has at most ``size`` ids.

    A null or empty text has the end id alone.  Repeated rows and null ids are
    documents of their own.  An empty table gives no rows; other columns are
    not carried.  The histogram (at most ``size - 1`` lengths), its patterns
    and the counts of ``size x RANK_GROUPS`` rank groups are all that reaches
    the driver.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row_id"), F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).alias("text"))
    ids = staged(rows.mapInArrow(_encode_rows(tokenizer_path, end_id),
                                 "row_id long, doc_id long, n long, ids binary"), "ids")
    lens = (ids.select("row_id", (F.col("n") % size).alias("tail"),
                       F.floor(F.col("n") / size).cast("long").alias("full"),
                       F.pmod(F.xxhash64("row_id"), F.lit(RANK_GROUPS)).cast("int").alias("part")))
    groups = (lens.groupBy("tail", "part").agg(F.count(F.lit(1)).alias("rows"), F.sum("full").alias("full"))
              .toArrow().sort_by([("tail", "ascending"), ("part", "ascending")]))
    places = _places(pack_histogram(_histogram(groups), size))
    first = docs.sparkSession.createDataFrame(_offsets(groups), "tail long, part int, rank0 long, full0 long")
    order = Window.partitionBy("tail", "part").orderBy("row_id")
    ranked = (lens.withColumn("rank", F.row_number().over(order) - 1)
              .withColumn("before", F.sum("full").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("full"))
              .join(F.broadcast(first), ["tail", "part"])
              .select("row_id", (F.col("rank") + F.col("rank0")).alias("rank"),
                      (F.col("before") + F.col("full0")).alias("whole")))
    return (ids.join(ranked, "row_id").select("doc_id", "n", "ids", "rank", "whole")
            .mapInArrow(_emit(places, size), "doc_id long, start long, length long, ids binary, "
                        "doc_tokens long, sequence_id long, offset long"))
