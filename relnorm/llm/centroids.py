"""Clustering of integer vectors around centroids, the nearest one found by the threshold algorithm.

Per dimension the centroids lie in a sorted list.  From a vector's value each
list is walked outward, one centroid a step in every dimension; a centroid
seen for the first time gets its exact distance.  The squared distances of the
frontiers sum to a lower bound for every centroid not seen yet, and the walk
stops when that bound strictly exceeds the best exact distance, so that ties
are still settled by the smaller number.  All arithmetic is in integers.

A round is one pass over the written vectors: tasks send one row of sums per
centroid, which Spark adds up; the new centroids are small and travel with the
next round's tasks.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relnorm.llm.shared import staged

CHUNK = 8192
#: Below this, squared distances of up to 4096 components fit 64-bit integers; larger ones use Python integers.
NARROW = 1 << 24
LIMB = 1 << 24
_LONGEST = (1 << 63) - 1


def scaled(vectors: list, size: int, scale: int) -> list[list[int]]:
    """``floor(scale * x)`` of every component, exact for any finite double."""
    out = []
    for v in vectors:
        x = np.array(v, np.float64) * scale  # a power of two: exact unless it overflows
        if np.isfinite(x).all() and np.abs(x).max(initial=0) < NARROW:
            out.append(np.floor(x).astype(np.int64).tolist())
        else:
            out.append([int(c * scale // 1) if abs(c) < 2**52 else int(c) * scale for c in v])
    return out


def integers(rows: list, size: int) -> np.ndarray:
    """Rows of integers as a 64-bit array, or one of Python integers if a component is too large for it."""
    wide = any(abs(c) >= NARROW for row in rows for c in row)
    return np.array(rows, object if wide else np.int64).reshape(len(rows), size)


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each vector the number of its nearest centroid (ties: the smaller) and the squared distance."""
    if object in (vectors.dtype, centroids.dtype):
        vectors, centroids = vectors.astype(object), centroids.astype(object)
    kind, (n, size), k = vectors.dtype, vectors.shape, len(centroids)
    order = np.argsort(centroids, axis=0, kind="stable")           # per dimension: centroid numbers by value
    lists = np.take_along_axis(centroids, order, 0)
    far = max(abs(int(x.min() if s else x.max())) for x in (vectors, centroids) for s in (0, 1)) * 2 + 1
    padded = np.concatenate([lists, np.zeros((1, size), kind)])    # row k: past the end
    best, number = np.zeros(n, kind), np.full(n, -1)
    seen = np.zeros((n, k), bool)
    active = np.arange(n)
    dims = np.arange(size)
    right = np.stack([np.searchsorted(lists[:, d], vectors[:, d]) for d in range(size)], axis=1)
    left = right - 1
    while len(active):
        x, lo, hi = vectors[active], left[active], right[active]
        down = np.where(lo >= 0, x - padded[np.maximum(lo, 0), dims], far)
        up = np.where(hi < k, padded[np.minimum(hi, k), dims] - x, far)
        lower = down <= up
        frontier = np.where(lower, down, up)
        found = order[np.where(lower, np.maximum(lo, 0), np.minimum(hi, k - 1)), dims]
        left[active], right[active] = np.where(lower, lo - 1, lo), np.where(lower, hi, hi + 1)
        for c in range(k):
            new = (found == c).any(1) & ~seen[active, c]
            at = active[new]
            if not len(at):
                continue
            seen[at, c] = True
            distance = ((vectors[at] - centroids[c]) ** 2).sum(1)
            closer = (number[at] < 0) | (distance < best[at]) | ((distance == best[at]) & (c < number[at]))
            best[at[closer]], number[at[closer]] = distance[closer], c
        bound = (frontier * frontier).sum(1)
        active = active[(bound <= best[active]) & ~seen[active].all(1)]
    return number, best


def _read(column, size: int):
    """Chunks of a column of integer lists; lists of decimal strings hold what a long can't."""
    for k in range(0, len(column), CHUNK):
        some = column.slice(k, CHUNK)
        flat = some.flatten()
        if pa.types.is_string(flat.type):
            yield k, integers([[int(c) for c in row] for row in some.to_pylist()], size)
        else:
            yield k, flat.to_numpy().reshape(len(some), size)


def _scale_rows(size: int, scale: int):
    def run(parts):
        for part in parts:
            for k in range(0, part.num_rows, CHUNK):
                some = part.slice(k, CHUNK)
                rows = scaled(some.column(1).to_pylist(), size, scale)
                wide = [any(abs(c) >= NARROW for c in row) for row in rows]
                yield pa.RecordBatch.from_arrays([
                    some.column(0).cast(pa.int64()),
                    pa.array([None if w else row for w, row in zip(wide, rows)], pa.list_(pa.int64())),
                    pa.array([[str(c) for c in row] if w else None for w, row in zip(wide, rows)],
                             pa.list_(pa.string()))], names=["id", "v", "wide"])
    return run


def _batches(part, size: int):
    """(row numbers, vectors) of a batch's ordinary and of its very large vectors."""
    for name in ("v", "wide"):
        column = part.column(name)
        rows = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False))
        for k, vectors in _read(column.take(pa.array(rows)), size):
            yield rows[k:k + len(vectors)], vectors


def _limbs(total: int) -> list[int]:
    """Signed digits of base 2^24, lowest first, so that any number of tasks' sums add up in longs."""
    out, sign, rest = [], -1 if total < 0 else 1, abs(total)
    while rest:
        out.append(sign * (rest % LIMB))
        rest //= LIMB
    return out


def _sums(centroids: np.ndarray):
    size = centroids.shape[1]

    def run(parts):
        counts, sums = [0] * len(centroids), [[0] * size for _ in centroids]
        for part in parts:
            for _, vectors in _batches(part, size):
                number, _ = nearest(vectors, centroids)
                for c in np.unique(number).tolist():
                    mine = vectors[number == c]
                    counts[c] += len(mine)
                    sums[c] = [a + int(b) for a, b in zip(sums[c], mine.sum(0))]
        rows = [(c, -1, 0, counts[c]) for c in range(len(centroids)) if counts[c]]
        rows += [(c, d, e, x) for c in range(len(centroids)) for d in range(size)
                 for e, x in enumerate(_limbs(sums[c][d]))]
        columns = list(zip(*rows)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns],
                                         names=["cluster", "dimension", "limb", "total"])
    return run


def _assigned(centroids: np.ndarray):
    def run(parts):
        for part in parts:
            for rows, vectors in _batches(part, centroids.shape[1]):
                number, distance = nearest(vectors, centroids)
                yield pa.RecordBatch.from_arrays([
                    part.column("id").take(pa.array(rows)), pa.array(number, pa.int32()),
                    pa.array([d if d <= _LONGEST else None for d in distance.tolist()], pa.int64())],
                    names=["id", "cluster", "distance"])
    return run


class CentroidClustering:
    """Scaled vectors in a written table, and the rounds over it.

    Vectors of another length than ``size``, or with a null, NaN or infinite
    component, are left out.  Rows without an id are clustered but never start
    a centroid.  Repeated rows count each; of equal hashes the smaller vector
    starts first.  With fewer than ``k`` vectors there are fewer centroids.
    """

    def __init__(self, vectors: DataFrame, k: int = 8, size: int = 64, scale: int = 1024, seed: str = "3",
                 id_col: str = "vec_id", vector_col: str = "embedding"):
        self.k, self.size = k, size
        v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
        finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
        rows = vectors.where((F.size(vector_col) == size) & finite).select(F.col(id_col).cast("long").alias("id"),
                                                                          v.alias("x"))
        self.vectors = staged(rows.mapInArrow(_scale_rows(size, scale), "id long, v array<long>, wide array<string>"),
                              "vectors")
        self.seed = seed

    def start(self) -> np.ndarray:
        """The first centroids: ``k`` rows at most reach the driver."""
        name = F.sha2(F.concat(F.lit(f"{self.seed}:"), F.col("id").cast("string")), 256)
        first = (self.vectors.where(F.col("id").isNotNull()).orderBy(name, "v", "wide").limit(self.k)
                 .select("v", "wide").collect())
        return integers([[int(c) for c in r.v or r.wide] for r in first], self.size)

    def moved(self, centroids: np.ndarray) -> np.ndarray:
        """The centroids after one round: at most ``k * (size + 1)`` sums of a few limbs reach the driver."""
        summed = (self.vectors.mapInArrow(_sums(centroids), "cluster long, dimension long, limb long, total long")
                  .groupBy("cluster", "dimension", "limb").agg(F.sum("total").alias("total")).collect())
        counts, out = {}, [list(map(int, c)) for c in centroids]
        totals = {(c, d): 0 for c in range(len(out)) for d in range(self.size)}
        for c, d, limb, total in summed:
            if d < 0:
                counts[c] = total
            else:
                totals[c, d] += total * LIMB ** limb
        for (c, d), total in totals.items():
            if counts.get(c):
                out[c][d] = total // counts[c]
        return integers(out, self.size)

    def fit(self, rounds: int = 10) -> np.ndarray:
        centroids = self.start()
        for _ in range(rounds if len(centroids) else 0):
            centroids = self.moved(centroids)
        return centroids

    def assign(self, centroids: np.ndarray) -> DataFrame:
        """(id, cluster, distance) of every kept vector."""
        if not len(centroids):  # no row can start a centroid
            return self.vectors.select("id", F.lit(None).cast("int").alias("cluster"),
                                       F.lit(None).cast("long").alias("distance"))
        return self.vectors.mapInArrow(_assigned(centroids), "id long, cluster int, distance long")


def centroid_clusters(vectors: DataFrame, k: int = 8, size: int = 64, rounds: int = 10, scale: int = 1024,
                      seed: str = "3", id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per kept vector: id, cluster, distance, cluster_inertia, inertia, centroid (its components).

    See ``CentroidClustering`` for what is kept.  Distances and inertias are
    exact, and null where a 64-bit integer can't hold them.  An empty table
    gives no rows; if no row has an id, cluster, distances and centroid are
    null.  Further columns of the input are not carried.
    """
    job = CentroidClustering(vectors, k, size, scale, seed, id_col, vector_col)
    centroids = job.fit(rounds)
    rows = staged(job.assign(centroids), "assigned")
    wide = F.sum(F.col("distance").cast("decimal(38,0)"))
    whole = F.count("distance") == F.count(F.lit(1))
    per_cluster = rows.groupBy("cluster").agg(F.when(whole, wide).alias("inertia"))     # at most k rows
    sums = {r.cluster: r.inertia for r in per_cluster.collect()}

    def fit_long(x):
        return None if x is None or x > _LONGEST else int(x)

    total = None if None in sums.values() else sum(map(int, sums.values()))
    facts = rows.sparkSession.createDataFrame(
        [(c, fit_long(sums.get(c)), fit_long(total), [str(x) for x in row])
         for c, row in enumerate(centroids.tolist())],
        "cluster int, cluster_inertia long, inertia long, centroid array<string>")
    return rows.join(F.broadcast(facts), "cluster", "left").withColumnRenamed("id", id_col).select(
        id_col, "cluster", "distance", "cluster_inertia", "inertia", "centroid")


def centroid_digest(centroid: list) -> str:
    """Lowercase hex sha256 of the components as decimal integers joined by commas."""
    return hashlib.sha256(",".join(str(x) for x in centroid).encode()).hexdigest()
