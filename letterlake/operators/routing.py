"""Routing of lifecycle events to the customer, internal and health streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from letterlake.functions.clock import event_timestamp, instant, iso_text, ntz
from letterlake.functions.text import CORRUPT, is_blank
from letterlake.schemas import ENVELOPE_FIELDS

# Event types shown to customers, and the identity of health events.
CUSTOMER_EVENT_TYPES = (
    "mail.requested",
    "mail.dispatched",
    "mail.delivered",
    "mail.opened",
    "mail.clicked",
)
HEALTH_EVENT_TYPE = "pipeline.job_failed"
HEALTH_EVENT_VERSION = "1.0.0"
ROUTER_SOURCE = "flink.mail_lifecycle_router"
ROUTER_JOB_NAME = "mail-lifecycle-router-java"
ROUTER_JOB_TYPE = "flink"
MISSING_MESSAGE = "missing_message_id"


def source_id(prefix: str) -> Column:
    """An identifier that is the same for every delivery of the same source record."""
    place = F.concat_ws("|", "topic", F.col("partition").cast("string"), F.col("offset").cast("string"))
    return F.concat(F.lit(prefix), F.sha2(place, 256))


def identified() -> Column:
    return (
        F.col("event_id").isNotNull()
        & F.col("message_id").isNotNull()
        & F.col("correlation_id").isNotNull()
    )


def normalize_lifecycle(envelopes: DataFrame) -> DataFrame:
    """Lower-case event type, typed times; keeps rows that have all three identifiers."""
    return envelopes.where(identified()).select(*ENVELOPE_FIELDS).withColumns(
        {
            "event_type": F.lower("event_type"),
            "event_time": ntz(event_timestamp(F.col("event_time"))),
            "ingested_at": ntz(event_timestamp(F.col("ingested_at"))),
        }
    )


def customer_projection(normalized: DataFrame) -> DataFrame:
    return normalized.where(
        F.col("tenant_id").isNotNull() & F.col("event_type").isin(*CUSTOMER_EVENT_TYPES)
    ).select("tenant_id", "message_id", "event_type", "event_time", "payload")


def internal_projection(normalized: DataFrame) -> DataFrame:
    return normalized.select(
        "tenant_id", "message_id", "correlation_id", "event_type", "event_time", "payload"
    )


def with_routes(parsed: DataFrame) -> DataFrame:
    """Adds ``routes``: where each well-formed record goes (types compare case-sensitively).

    A record without a message goes to ``health`` alone; any other goes to ``internal`` and, when
    its type is customer-facing and it has a tenant, to ``customer`` as well.
    """
    no_message = is_blank(F.col("message_id"))
    for_customer = (
        ~no_message
        & F.col("event_type").isin(*CUSTOMER_EVENT_TYPES)
        & ~is_blank(F.col("tenant_id"))
    )
    routes = F.array_compact(
        F.array(
            F.when(no_message, F.lit("health")),
            F.when(~no_message, F.lit("internal")),
            F.when(for_customer, F.lit("customer")),
        )
    )
    return parsed.where(F.col(CORRUPT).isNull()).withColumn("routes", routes)


def route(routed: DataFrame, name: str) -> DataFrame:
    return routed.where(F.array_contains("routes", name))


def health_events(routed: DataFrame, processing_time: str) -> DataFrame:
    """A failure event in the full envelope for every record without a message."""
    now = iso_text(instant(processing_time))
    event_id = source_id("health-")
    payload = F.to_json(
        F.struct(
            F.lit(MISSING_MESSAGE).alias("failure_reason"),
            F.lit(ROUTER_JOB_NAME).alias("job_name"),
            F.lit(ROUTER_JOB_TYPE).alias("job_type"),
            now.alias("failed_at"),
            F.col("value").alias("source_payload"),
        )
    )
    return route(routed, "health").select(
        event_id.alias("event_id"),
        F.lit(HEALTH_EVENT_TYPE).alias("event_type"),
        F.lit(HEALTH_EVENT_VERSION).alias("event_version"),
        now.alias("event_time"),
        now.alias("ingested_at"),
        F.lit(ROUTER_SOURCE).alias("source_system"),
        "tenant_id",
        F.lit("unknown").alias("message_id"),
        F.coalesce("correlation_id", event_id).alias("correlation_id"),
        "trace_id",
        F.lit("system").alias("actor_type"),
        payload.alias("payload"),
    )


def union_internal(lifecycle: DataFrame, operational: DataFrame) -> DataFrame:
    """The internal tracking stream: both producers' records, missing columns NULL."""
    return lifecycle.unionByName(operational, allowMissingColumns=True)
