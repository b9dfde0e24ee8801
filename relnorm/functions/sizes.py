"""Human-readable sizes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from relnorm.functions._util import as_col


def _tenths(b: Column, unit: int) -> Column:
    # round(b / unit, 1) half-up, in whole tenths, without float formatting
    return F.floor((b + F.lit(unit // 20)) / F.lit(unit // 10)).cast("bigint")


def _fmt(t: Column, suffix: str) -> Column:
    return F.concat(F.floor(t / 10).cast("bigint").cast("string"), F.lit("."),
                    (t % 10).cast("string"), F.lit(suffix))


def human_size(n_bytes) -> Column:
    """Decimal units: below 0.5 GB (rounded to 0.1) → ``x.xMB``, else ``x.xGB``."""
    b = as_col(n_bytes).cast("bigint")
    gb = _tenths(b, 1_000_000_000)
    mb = _tenths(b, 1_000_000)
    return F.when(gb < 5, _fmt(mb, "MB")).otherwise(_fmt(gb, "GB"))
