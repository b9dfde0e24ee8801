"""Tables and folders in the shared folder that ``spark.checkpoint.dir`` names.

Jobs cut lineage by writing a table there and reading it again, so that a lost
executor costs only its running tasks.  ``clear`` removes what a session wrote,
once its results are stored; ``release`` removes a table that is no longer needed
before that.
"""

from __future__ import annotations

import uuid
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relnorm.session import checkpoint_dir

_written: list[str] = []
_paths: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()

#: A planned size from here on is no estimate but the absence of one.
UNKNOWN_BYTES = 1 << 50


def folder(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared folder."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex[:12]}"
    # With its scheme: tasks must not take a path on the default file system for a local one.
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    path = store.makeQualified(where).toString()
    _written.append(path)
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back."""
    spark = df.sparkSession
    path = folder(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _paths[out] = path
    return out


def release(*tables: DataFrame) -> None:
    """Remove staged tables once all that is read from them is written; none may be read again."""
    for table in tables:
        path = _paths.pop(table)
        where = table.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(where, True)
        _written.remove(path)


def clear(spark: SparkSession) -> None:
    """Remove every staged table of this driver; call it after the results are stored."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    while _written:
        path = jvm.org.apache.hadoop.fs.Path(_written.pop())
        path.getFileSystem(conf).delete(path, True)


def bins_for(spark: SparkSession, df: DataFrame, bytes_per_bin: int = 4 << 20) -> int:
    """How many hash ranges to deal work into: follows the input and the shuffle setting."""
    rows = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size >= UNKNOWN_BYTES:  # the planner has no figure: count the texts
        texts = [F.octet_length(f.name) for f in df.schema if f.dataType.typeName() in ("string", "binary")]
        size = df.agg(F.sum(sum(texts, F.lit(0)))).first()[0] or 0
    return max(rows, size // bytes_per_bin, 1)
