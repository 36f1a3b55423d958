"""Aggregations behind the operational and dead-letter dashboards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bucket widths in seconds that an automatic histogram chooses from.
_WIDTHS = (1, 5, 10, 30, 60, 300, 600, 1800, 3600, 10800, 43200, 86400, 604800, 2592000, 31536000)
MAX_BUCKETS = 100


def automatic_interval(df: DataFrame, ts: str) -> str:
    """The smallest width that needs at most ``MAX_BUCKETS`` buckets for the whole time range."""
    seconds = F.unix_seconds(F.col(ts).cast("timestamp"))
    low, high = df.agg(F.min(seconds), F.max(seconds)).first()
    span = 0 if low is None else high - low
    width = next((w for w in _WIDTHS if span <= w * MAX_BUCKETS), _WIDTHS[-1])
    return f"{width} seconds"


def volume_over_time(df: DataFrame, ts: str, interval: str | None = None) -> DataFrame:
    """Rows per time bucket; empty buckets are absent, rows without a time are not counted."""
    interval = interval or automatic_interval(df, ts)
    bucket = F.window(F.col(ts), interval)
    return (
        df.where(F.col(ts).isNotNull())
        .groupBy(bucket.alias("bucket"))
        .agg(F.count("*").alias("events"))
        .select(F.col("bucket.start").alias("bucket_start"), "events")
    )


def top_terms(df: DataFrame, column: str, size: int) -> DataFrame:
    """The most frequent values; missing values are no term, ties fall to the smaller value."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("events"))
        .orderBy(F.col("events").desc(), F.col(column).asc())
        .limit(size)
    )


def most_recent(df: DataFrame, ts: str, columns: list[str], tie_break: list[Column], size: int) -> DataFrame:
    """The newest rows: a bounded top-k, never a full sort."""
    return (
        df.orderBy(F.col(ts).desc_nulls_last(), *tie_break).limit(size).select(*columns)
    )


def document_counts(relations: dict[str, DataFrame]) -> DataFrame:
    """Number of rows per named relation."""
    counts = [
        df.agg(F.count("*").alias("documents")).select(F.lit(name).alias("relation"), "documents")
        for name, df in relations.items()
    ]
    total = counts[0]
    for count in counts[1:]:
        total = total.unionByName(count)
    return total


# Columns of the two "recent" tables.
RECENT_EVENT_COLUMNS = [
    "@timestamp",
    "event_type",
    "tenant_id",
    "message_id",
    "status",
    "provider",
    "processing_stage",
]
RECENT_DEAD_LETTER_COLUMNS = ["kafka_timestamp", "kafka_topic", "kafka_partition", "kafka_offset"]
