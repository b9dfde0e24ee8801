"""Row predicates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from relnorm.functions._util import as_col


def any_field_equals(fields, value) -> Column:
    """True when any of ``fields`` equals ``value`` (null-safe when value is None)."""
    cols = [as_col(f) for f in fields]
    if value is None:
        preds = [c.isNull() for c in cols]
    else:
        preds = [c.eqNullSafe(F.lit(value)) for c in cols]
    return reduce(lambda a, b: a | b, preds)


def not_blank(*cols) -> Column:
    """All given columns are non-null and not blank."""
    preds = [as_col(c).isNotNull() & (F.trim(as_col(c).cast("string")) != "") for c in cols]
    return reduce(lambda a, b: a & b, preds)


def path_kind(path, kinds=("issues", "ingest", "digitisation", "data-provider"),
              default: str = "newspaper") -> Column:
    """Classify a record by the directory names in its path."""
    parts = F.split(as_col(path), "/")
    expr = None
    for k in kinds:
        cond = F.array_contains(F.slice(parts, 1, F.size(parts) - 1), k)
        expr = F.when(cond, F.lit(k)) if expr is None else expr.when(cond, F.lit(k))
    return expr.otherwise(F.lit(default))


def within_size(length, max_bytes: float) -> Column:
    return as_col(length) <= F.lit(max_bytes)


def has_extension(path, extensions) -> Column:
    """Ends with any of the given extensions (``.zip``), case-sensitive."""
    p = as_col(path)
    return reduce(lambda a, b: a | b, [p.endswith(e) for e in extensions])


def name_in(name, include=None, exclude=None) -> Column:
    n = as_col(name)
    cond = F.lit(True)
    if include:
        cond = cond & n.isin(list(include))
    if exclude:
        cond = cond & ~n.isin(list(exclude))
    return cond


def is_hidden(path) -> Column:
    """Any path component starting with ``.``."""
    return as_col(path).rlike(r"(^|/)\.[^/]")
