"""Counts and first/last times of events, by any key.

Every measure here (count, minimum, maximum) can be computed from partial results. The functions
therefore accept events or an ``activity_rollup`` of them: at scale the landing table is read and
its payloads parsed once, into a rollup, and all dimensions, facts and marts come from that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from letterlake.functions.rates import rate

# The counted event types and their measure names.
EVENT_MEASURES = {
    "requested_count": "mail.requested",
    "dispatched_count": "mail.dispatched",
    "delivered_count": "mail.delivered",
    "opened_count": "mail.opened",
    "clicked_count": "mail.clicked",
}

ROLLUP_KEYS = (
    "tenant_id",
    "event_type",
    "event_date",
    "campaign_id",
    "campaign_name",
    "template_id",
    "template_name",
    "template_channel",
    "provider",
)


def measured(events: DataFrame) -> DataFrame:
    """Events as one-event rollup rows; a rollup is returned as it is."""
    if "event_count" in events.columns:
        return events
    return events.withColumns(
        {"event_count": F.lit(1).cast("bigint"), "first_at": F.col("event_ts"), "last_at": F.col("event_ts")}
    )


def activity_rollup(events: DataFrame, keys: tuple[str, ...] = ROLLUP_KEYS) -> DataFrame:
    return (
        measured(events)
        .groupBy(*keys)
        .agg(
            F.sum("event_count").alias("event_count"),
            F.min("first_at").alias("first_at"),
            F.max("last_at").alias("last_at"),
        )
    )


def _all_present(columns: tuple[str, ...]) -> Column:
    present = F.lit(True)
    for name in columns:
        present = present & F.col(name).isNotNull()
    return present


def event_counts(events: DataFrame, keys: tuple[str, ...], required: tuple[str, ...]) -> DataFrame:
    """The five event counts per key, over rows whose ``required`` columns are present."""
    counts = [
        F.sum(F.when(F.col("event_type") == kind, F.col("event_count")).otherwise(0)).alias(name)
        for name, kind in EVENT_MEASURES.items()
    ]
    return measured(events).where(_all_present(required)).groupBy(*keys).agg(*counts)


def seen(events: DataFrame, keys: tuple[str, ...], required: tuple[str, ...]) -> DataFrame:
    """First and last time and number of events per key."""
    return (
        measured(events)
        .where(_all_present(required))
        .groupBy(*keys)
        .agg(
            F.min("first_at").alias("first_seen_at"),
            F.max("last_at").alias("last_seen_at"),
            F.sum("event_count").alias("total_events"),
        )
    )


def tenant_dimension(events: DataFrame) -> DataFrame:
    return seen(events, ("tenant_id",), ("tenant_id",))


def event_type_dimension(events: DataFrame) -> DataFrame:
    return seen(events, ("event_type",), ("event_type",))


def daily_delivery_fact(events: DataFrame) -> DataFrame:
    keys = ("tenant_id", "event_date")
    return event_counts(events, keys, keys)


def with_engagement_rates(counts: DataFrame) -> DataFrame:
    """Rates count events, not messages: a message opened twice can lift a rate above 1."""
    return counts.withColumns(
        {
            "open_rate": rate("opened_count", "delivered_count"),
            "click_through_rate": rate("clicked_count", "delivered_count"),
        }
    )


def campaign_daily_metrics(staged: DataFrame) -> DataFrame:
    keys = ("tenant_id", "campaign_id", "event_date")
    return with_engagement_rates(event_counts(staged, keys, ("campaign_id",)))


def template_daily_metrics(staged: DataFrame) -> DataFrame:
    keys = ("tenant_id", "template_id", "event_date")
    return with_engagement_rates(event_counts(staged, keys, ("template_id",)))


def campaign_dimension(staged: DataFrame) -> DataFrame:
    """One row per combination of descriptive attributes; the label defaults after grouping."""
    keys = ("tenant_id", "campaign_id", "campaign_name", "provider")
    return seen(staged, keys, ("campaign_id",)).withColumn(
        "campaign_name", F.coalesce("campaign_name", "campaign_id")
    )


def template_dimension(staged: DataFrame) -> DataFrame:
    keys = ("tenant_id", "template_id", "template_name", "template_channel", "provider")
    return seen(staged, keys, ("template_id",)).withColumn(
        "template_name", F.coalesce("template_name", "template_id")
    )
