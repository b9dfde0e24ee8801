"""Registry of catalogued queries: name → (spark builder, SQL text or None)."""

from __future__ import annotations

import os
from dataclasses import dataclass
from typing import Callable, Optional

from pyspark.sql import DataFrame, SparkSession


@dataclass
class Entry:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: Optional[str]
    covers: tuple


REGISTRY: dict[str, Entry] = {}


def query(name: str, sql: Optional[str] = None, covers: tuple = ()):
    """Register ``fn(spark, sf_dir) -> DataFrame`` with its SQL equivalent."""
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Entry(name, fn, sql, tuple(covers))
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def load_all():
    """Import the catalog modules (they register on import)."""
    from relnorm.plans import catalog_columns, catalog_relational, catalog_io, catalog_jobs  # noqa: F401
    return REGISTRY
