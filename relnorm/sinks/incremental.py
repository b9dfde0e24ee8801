"""Cross-run keyed store: insert-if-absent (an existing record is never
overwritten) and append without exact duplicates.

A store is a folder of commits.  Rows are hashed by key into buckets:
``commit=<name>/bucket=<k>/``.  A commit never changes; it has a key range per
bucket (``_ranges``) and a Bloom filter per bucket (``_filters``, two bits a key
as 4 kB bitmaps), and it counts only once the newest file of ``_manifest``
lists it.  That file appears by one rename, after everything it names was
written, so a run that dies before leaves the store as it was.

A new batch is held against ranges and filters first; only buckets where a
key may be stored are read, and of those only the keys.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from relnorm.operators.dedupe import keep_first
from relnorm.operators.keys import dense_key
from relnorm.session import measured, stage, staging

BUCKETS = 64
_BITMAP_BITS = 32768
_FILTER_BITS = 1 << 25
_HASHES = 2


@dataclass
class Manifest:
    """What a store consists of."""

    keys: list
    buckets: int
    pk: str | None
    max_pk: int = 0
    version: int = 0
    commits: list = field(default_factory=list)


class _Folder:
    """Files of a store through Hadoop, as Spark's own readers see them."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        self._new = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self._new(self.path).getFileSystem(spark._jsc.hadoopConfiguration())
        self._io = spark._jvm.org.apache.commons.io.IOUtils

    def names(self, sub: str) -> list[str]:
        folder = self._new(f"{self.path}/{sub}" if sub else self.path)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(folder)) if self.fs.exists(folder) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self._new(f"{self.path}/{name}"))
        try:
            return self._io.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, name: str, text: str) -> None:
        """A whole new file by one rename; an error if there is one already."""
        draft, target = self._new(f"{self.path}/{name}.{uuid.uuid4().hex}"), self._new(f"{self.path}/{name}")
        stream = self.fs.create(draft, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        if self.fs.exists(target) or not self.fs.rename(draft, target):
            self.fs.delete(draft, False)
            raise RuntimeError(f"{target} was written by another run")

    def delete(self, name: str) -> None:
        self.fs.delete(self._new(f"{self.path}/{name}"), True)


def _manifest(folder: _Folder) -> Manifest | None:
    versions = [n for n in folder.names("_manifest") if n.endswith(".json")]
    return Manifest(**json.loads(folder.read(f"_manifest/{versions[-1]}"))) if versions else None


def _tables(spark: SparkSession, path: str, kind: str, commits: list, schema=None) -> DataFrame:
    base = f"{path.rstrip('/')}/{kind}" if kind else path.rstrip("/")
    reader = spark.read.option("basePath", base)
    return (reader.schema(schema) if schema else reader).parquet(*[f"{base}/commit={c}" for c in commits])


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a store, with the columns they were stored with."""
    m = _manifest(_Folder(spark, path))
    if m is None:
        raise FileNotFoundError(f"no store at {path}")
    return _tables(spark, path, "", m.commits).drop("commit", "bucket", "_digest")


def _bucket(keys, buckets: int):
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _places(keys):
    """The bits of a key in its bucket's filter, one row each."""
    return F.explode(F.array(*[F.pmod(F.xxhash64(F.lit(k + 1), *keys), F.lit(_FILTER_BITS)) for k in range(_HASHES)]))


def _write_commit(spark: SparkSession, folder: _Folder, m: Manifest, rows: DataFrame) -> Manifest | None:
    """Write ``rows`` with their ranges and filters; the manifest that would list them, None without rows."""
    name = f"{m.version + 1:09d}-{uuid.uuid4().hex[:8]}"
    seen = Observation()
    high = F.col(m.pk).cast("bigint") if m.pk else F.lit(0).cast("bigint")
    (rows.observe(seen, F.count(F.lit(1)).alias("n"), F.max(high).alias("high"))
     .withColumn("bucket", _bucket(m.keys, m.buckets)).repartition("bucket").write.partitionBy("bucket")
     .parquet(f"{folder.path}/commit={name}"))
    counted = measured(seen)
    if not counted.get("n"):
        folder.delete(f"commit={name}")
        return None
    written = _tables(spark, folder.path, "", [name], _with_places(rows)).select(*m.keys, "bucket")
    key = F.struct(*m.keys)
    written.groupBy("bucket").agg(F.min(key).alias("low"), F.max(key).alias("high")).coalesce(1).write.parquet(
        f"{folder.path}/_ranges/commit={name}")
    (written.select("bucket", _places(m.keys).alias("place"))
     .groupBy("bucket", F.expr(f"cast(place div {_BITMAP_BITS} as int)").alias("slot"))
     .agg(F.bitmap_construct_agg(F.expr(f"place % {_BITMAP_BITS}")).alias("bits"))
     .sortWithinPartitions("bucket", "slot").write.parquet(f"{folder.path}/_filters/commit={name}"))
    return Manifest(m.keys, m.buckets, m.pk, max(m.max_pk, counted["high"] or 0), m.version + 1, [*m.commits, name])


def _with_places(rows: DataFrame):
    from pyspark.sql.types import IntegerType, StringType, StructField, StructType
    return StructType([*rows.schema.fields, StructField("commit", StringType()), StructField("bucket", IntegerType())])


def possibly_stored(spark: SparkSession, path: str, fresh: DataFrame, keys, buckets: int, commits: list) -> DataFrame:
    """``keys…, bucket`` of the rows of ``fresh`` that the ranges and filters of the commits don't rule out."""
    key = F.struct(*keys)
    probes = fresh.select(*keys, _bucket(keys, buckets).alias("bucket"))
    ranges = _tables(spark, path, "_ranges", commits)  # at most buckets x commits rows
    probes = probes.join(ranges, "bucket").filter((key >= F.col("low")) & (key <= F.col("high"))).select(
        *keys, "bucket", "commit")
    filters = _tables(spark, path, "_filters", commits)
    bits = probes.select("*", _places(keys).alias("place")).withColumn(
        "slot", F.expr(f"cast(place div {_BITMAP_BITS} as int)"))
    bit = F.expr(f"getbit(cast(conv(hex(substring(bits, cast((place % {_BITMAP_BITS}) div 8 + 1 as int), 1)), 16, 10) as int), "
                 "cast(place % 8 as int))")
    hit = bits.join(filters, ["bucket", "slot", "commit"]).filter(bit == 1)
    return (hit.groupBy(*keys, "bucket", "commit").agg(F.count(F.lit(1)).alias("hits"))
            .filter(F.col("hits") == _HASHES).select(*keys, "bucket").distinct())


def absent_rows(spark: SparkSession, path: str, m: Manifest, fresh: DataFrame) -> DataFrame:
    """Rows of ``fresh`` (staged, one per key) whose key is not stored; NULLs compare equal."""
    maybe = stage(possibly_stored(spark, path, fresh, m.keys, m.buckets, m.commits))
    touched = [r[0] for r in maybe.select("bucket").distinct().collect()]  # at most m.buckets
    if not touched:
        return fresh
    stored = _tables(spark, path, "", m.commits).filter(F.col("bucket").isin(touched)).select(
        *[F.col(k).alias(f"_s{i}") for i, k in enumerate(m.keys)], "bucket")
    same = reduce(lambda a, b: a & b, [maybe[k].eqNullSafe(stored[f"_s{i}"]) for i, k in enumerate(m.keys)])
    known = maybe.join(stored, same & (maybe["bucket"] == stored["bucket"]), "left_semi").select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(m.keys)])
    same = reduce(lambda a, b: a & b, [fresh[k].eqNullSafe(known[f"_k{i}"]) for i, k in enumerate(m.keys)])
    return fresh.join(known, same, "left_anti")


def insert_if_absent(spark: SparkSession, new: DataFrame, path: str, keys, order_by=None,
                     pk: str | None = None, buckets: int = BUCKETS) -> int:
    """Append rows of ``new`` whose key is not stored yet (first per key in
    ``order_by`` when ``new`` repeats a key; NULL is a key like any other).
    With ``pk``, new rows get keys continuing after the stored maximum.
    Returns the max pk that was stored before, or 0.

    ``buckets`` is fixed by the first run.  One run may write at a time.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    order_by = list(order_by or keys)
    folder = _Folder(spark, path)
    m = _manifest(folder) or Manifest(keys, buckets, pk)
    if m.keys != keys or m.pk != pk:
        raise ValueError(f"the store has keys {m.keys} and pk {m.pk}")
    with staging(spark):
        fresh = stage(keep_first(new, keys, order_by))
        if m.commits:
            fresh = absent_rows(spark, path, m, fresh)
        if pk:
            fresh = dense_key(fresh, order_by, pk=pk, start=m.max_pk + 1,
                              tiebreak=[c for c in fresh.columns if c not in order_by])
        after = _write_commit(spark, folder, m, fresh)
        if after is not None:
            folder.put(f"_manifest/{after.version:012d}.json", json.dumps(asdict(after)))
    return m.max_pk


def append_distinct(spark: SparkSession, new: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Append only rows not already stored (exact duplicates over all columns,
    NULLs compared equal): a store keyed by a 128-bit digest of the row."""
    digest = F.md5(F.to_json(F.struct(*new.columns)))
    insert_if_absent(spark, new.withColumn("_digest", digest), path, ["_digest"], buckets=buckets)


def compact(spark: SparkSession, path: str) -> None:
    """Put all commits of a store into one, so that fewer files and filters are probed."""
    folder = _Folder(spark, path)
    m = _manifest(folder)
    if m is None or len(m.commits) < 2:
        return
    rows = _tables(spark, path, "", m.commits).drop("commit", "bucket")
    after = _write_commit(spark, folder, Manifest(m.keys, m.buckets, m.pk, m.max_pk, m.version), rows)
    folder.put(f"_manifest/{after.version:012d}.json", json.dumps(asdict(after)))


def vacuum(spark: SparkSession, path: str) -> list[str]:
    """Remove commits that the manifest doesn't list; only while no run writes and none reads an older state."""
    folder = _Folder(spark, path)
    m = _manifest(folder)
    listed = {f"commit={c}" for c in m.commits} if m else set()
    gone = []
    for sub in ("", "_ranges/", "_filters/"):
        for name in folder.names(sub.rstrip("/")):
            if name.startswith("commit=") and name not in listed:
                folder.delete(f"{sub}{name}")
                gone.append(f"{sub}{name}")
    return gone
