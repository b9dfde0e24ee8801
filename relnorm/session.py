"""Session helpers.

The session is configured for scale: AQE on (runtime coalescing, skew-join
splitting and runtime broadcast conversion), UTC session time, Arrow for
pandas exchange.  Library code never sets a checkpoint directory on a
cluster session: it reads ``spark.checkpoint.dir`` and only falls back to a
private scratch folder when nothing is configured (tests, local runs).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

_staged: list[str] = []
_paths: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()

_DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "relnorm", extra: dict | None = None) -> SparkSession:
    """Return (or create) a session with the library's defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only when the session names none (tests, a laptop) is a private folder
    created and registered.  On a cluster the setting must point at shared
    storage; it is never overridden here.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="relnorm-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return path


def stage(df: DataFrame, partition_by: str | None = None) -> DataFrame:
    """Cut lineage: write ``df`` as a Parquet table in the shared checkpoint folder and read it back.

    Used where a plan would otherwise evaluate an expensive input twice.
    Later reads take only the columns they need and survive executor loss.
    ``staging``, ``unstage`` or ``release`` removes the files.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"stage-{uuid.uuid4().hex}")
    _staged.append(path)
    (df.write.partitionBy(partition_by) if partition_by else df.write).parquet(path)
    out = spark.read.schema(df.schema).parquet(path).select(*df.columns)
    _paths[out] = path
    return out


def unstage(*tables: DataFrame) -> None:
    """Remove single staged tables before their scope ends, once all that is read from them is written."""
    for table in tables:
        path = _paths.pop(table, None)
        if path in _staged:
            _staged.remove(path)
            _delete(table.sparkSession, path)


def built_on(df: DataFrame, table: DataFrame) -> DataFrame:
    """``df``, for which ``unstage`` removes the staged ``table`` that it reads."""
    if table in _paths:
        _paths[df] = _paths[table]
    return df


def _delete(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def release(spark: SparkSession, since: int = 0) -> None:
    """Remove the tables staged by this driver (from the ``since``-th on); nothing may read them afterwards."""
    while len(_staged) > since:
        _delete(spark, _staged.pop())


@contextmanager
def staging(spark: SparkSession):
    """Scope of a job: what it staged is removed at its end, however it ends."""
    since = len(_staged)
    try:
        yield
    finally:
        release(spark, since)


@contextmanager
def brief_shuffles(spark: SparkSession):
    """Scope in which the shuffle files of a query go when it ends; otherwise they stay until the driver collects
    its garbage.  A DataFrame that is run twice in it shuffles twice."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def measured(observation) -> dict:
    """The metrics of a finished observation; empty if the optimiser found that its input has no rows."""
    found = observation._jo.getAsJava()
    return {k: found[k] for k in found}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark)
    return os.path.join(base, name)
