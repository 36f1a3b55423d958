"""Ratios of counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rate(part: Column | str, whole: Column | str) -> Column:
    """``part / whole`` as DOUBLE; 0 for a zero denominator, NULL for a NULL one."""
    part, whole = (F.col(c) if isinstance(c, str) else c for c in (part, whole))
    return F.when(whole == 0, F.lit(0.0)).otherwise(part.cast("double") / whole)
