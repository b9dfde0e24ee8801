from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    """A column name or Column → Column."""
    return c if isinstance(c, Column) else F.col(c)
