"""Age-based rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from letterlake.functions.clock import duration, instant


def apply_retention(df: DataFrame, ts: str, keep: str, now: str) -> DataFrame:
    """Rows not older than ``keep`` (such as 7d); a row without a time is kept.

    The bound is a constant, so it reaches the scan as a pushed filter.
    """
    oldest = instant(now) - F.lit(duration(keep))
    return df.where(F.col(ts).isNull() | (F.col(ts) >= oldest))


# Days a row stays in each storage tier before it moves to the next.
HOT_DAYS = 7
WARM_DAYS = 30


def with_tier(df: DataFrame, ts: str, now: str) -> DataFrame:
    """Adds ``tier``: hot, warm or cold by age."""
    age = F.unix_seconds(instant(now).cast("timestamp")) - F.unix_seconds(F.col(ts).cast("timestamp"))
    return df.withColumn(
        "tier",
        F.when(age <= HOT_DAYS * 86400, F.lit("hot"))
        .when(age <= WARM_DAYS * 86400, F.lit("warm"))
        .when(age.isNotNull(), F.lit("cold")),
    )
