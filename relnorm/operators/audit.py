"""Data-quality outputs: unmatched keys, multi-matches, blank keys, errors."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relnorm.functions.predicates import not_blank


class UnresolvedError(RuntimeError):
    pass


def unmatched_keys(df: DataFrame, dim: DataFrame, left_on, right_on=None) -> DataFrame:
    """Each non-blank key of ``df`` missing from ``dim``, once."""
    left_on = [left_on] if isinstance(left_on, str) else list(left_on)
    right_on = left_on if right_on is None else ([right_on] if isinstance(right_on, str) else list(right_on))
    keys = df.select(*left_on).filter(not_blank(*left_on)).distinct()
    d = dim.select(*[F.col(r).alias(f"_um{i}") for i, r in enumerate(right_on)])
    cond = reduce(lambda a, b: a & b, [keys[l] == d[f"_um{i}"] for i, l in enumerate(left_on)])
    return keys.join(d, cond, "left_anti")


def multi_match_keys(dim: DataFrame, keys, count_name: str = "n_matches") -> DataFrame:
    """Keys with more than one candidate row, with their count."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return (dim.groupBy(*keys).agg(F.count(F.lit(1)).cast("bigint").alias(count_name))
            .filter(F.col(count_name) > 1))


def blank_key_rows(df: DataFrame, fields) -> DataFrame:
    """Records whose uniqueness fields are NULL or blank."""
    return df.filter(~not_blank(*fields))


def split_by_error(df: DataFrame, error_col: str = "error"):
    """``(good, quarantined)`` on an error column."""
    return df.filter(F.col(error_col).isNull()), df.filter(F.col(error_col).isNotNull())


def fail_if_any(bad: DataFrame, message: str, sample: int = 5) -> None:
    """Strict mode: raise with a bounded sample when ``bad`` has rows."""
    rows = bad.limit(sample).collect()
    if rows:
        n = bad.count()
        raise UnresolvedError(f"{message}: {n} row(s), e.g. {[tuple(r) for r in rows]}")
