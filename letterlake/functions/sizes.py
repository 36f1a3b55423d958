"""Broadcasts of measured size."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A broadcast side is held whole by every executor and by the driver.
BROADCAST_BYTES = 64 * 1024 * 1024
_ROW_OVERHEAD = 32


def broadcast_if_small(keys: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``keys`` with a broadcast hint when their measured size allows, else unchanged.

    Unchanged means a shuffled join, which takes any size. For data that is kept (persisted or
    stored), as measuring reads it once; the measurement is one row.
    """
    width = [F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0)) for name in keys.columns]
    size = F.sum(reduce(add, width) + _ROW_OVERHEAD)
    measured = keys.agg(size).first()[0] or 0
    return F.broadcast(keys) if measured <= limit else keys
