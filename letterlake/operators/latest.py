"""One row per key: the latest, the first, the preferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "_rank"


def first_by(df: DataFrame, keys: tuple[str, ...], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order.

    Spark limits each key to one row inside the map tasks as well (WindowGroupLimit), so a key
    holding a large part of all rows costs one row per task in the shuffle.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)


def latest_per_message(lifecycle: DataFrame) -> DataFrame:
    """Latest known state per message; rows of unknown time never win, ties fall to the event id."""
    order = [
        F.col("event_time").desc_nulls_last(),
        F.col("ingested_at").desc_nulls_last(),
        F.col("event_id").desc_nulls_last(),
    ]
    return first_by(lifecycle, ("message_id",), order).select(
        "message_id",
        "tenant_id",
        "correlation_id",
        F.col("event_type").alias("latest_event_type"),
        F.col("event_time").alias("latest_event_time"),
        "latest_status",
        "failure_code",
    )


def dedup_events(events: DataFrame, order: list[Column] | None = None) -> DataFrame:
    """One row per event id: the first ingested, whatever the read order."""
    order = order or [
        F.col("ingested_ts").asc_nulls_last(),
        F.col("event_ts").asc_nulls_last(),
        F.xxhash64(*events.columns).asc(),
    ]
    return first_by(events, ("event_id",), order)
