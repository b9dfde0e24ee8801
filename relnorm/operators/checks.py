"""Counts and data-quality checks measured in the jobs that write the tables.

Each check is an ``observe`` on the rows that flow to a sink, so counting
records, unresolved keys or rejects costs no second run of the plan.  Sinks
that publish in a second step call ``verify`` in between: a strict check then
fails after the rows are written and before anybody can read them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from relnorm.operators.audit import UnresolvedError
from relnorm.session import measured


class Checks:
    """The checks of one job.  Read results only after the watched rows were written.

    Watch rows above a range partitioning (``dense_key``), not below it: its
    sample runs what is below a second time.
    """

    def __init__(self):
        self._tables: dict[str, Observation] = {}
        self._watched: list[tuple[str, Observation, bool]] = []
        self._parts: dict[str, Checks] = {}

    def part(self, table: str) -> Checks:
        """The checks of one table, whose results are known once it is written; also part of this job's."""
        return self._parts.setdefault(table, Checks())

    def _all(self):
        return self._watched + [w for part in self._parts.values() for w in part._all()]

    def count(self, df: DataFrame, table: str) -> DataFrame:
        """``df``, with its rows counted as records of ``table``."""
        self._tables[table] = Observation()
        return df.observe(self._tables[table], F.count(F.lit(1)).alias("n"))

    def watch(self, df: DataFrame, name: str, bad: Column, sample, strict: bool = False) -> DataFrame:
        """``df``, with the rows where ``bad`` holds counted under ``name``; ``sample`` columns show one of them."""
        seen = Observation()
        self._watched.append((name, seen, strict))
        return df.observe(seen, F.count_if(bad).alias("n"),
                          F.min(F.when(bad, F.to_json(F.struct(*sample)))).alias("sample"))

    def counts(self) -> dict[str, int]:
        """Records per table."""
        return {t: measured(seen).get("n", 0) for t, seen in self._tables.items()}

    def found(self) -> list[tuple[str, int, str | None]]:
        """``(name, rows, one of them as JSON)`` of every watched condition."""
        return [(name, *_result(seen)) for name, seen, _ in self._all()]

    def table(self, spark: SparkSession) -> DataFrame:
        """``found`` as a table ``(check, n_rows, sample)``; one row per check."""
        return spark.createDataFrame(self.found(), "check string, n_rows bigint, sample string")

    def verify(self) -> None:
        """Raise if a strict condition was met."""
        bad = [(name, *_result(seen)) for name, seen, strict in self._all() if strict]
        if any(n for _, n, _ in bad):
            raise UnresolvedError("; ".join(f"{name}: {n} row(s), e.g. {sample}" for name, n, sample in bad if n))


def _result(seen: Observation) -> tuple[int, str | None]:
    found = measured(seen)
    return found.get("n", 0), found.get("sample")
