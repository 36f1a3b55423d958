"""Staging relations of the semantic layer."""

from __future__ import annotations

from pyspark.sql import DataFrame

from letterlake.functions.text import parse_variant, variant_text
from letterlake.schemas import DIM_CUSTOMER_EVENT_TYPE, DIM_CUSTOMER_TENANT, FCT_DAILY_DELIVERY

STAGED_COLUMNS = (
    "event_id",
    "tenant_id",
    "message_id",
    "correlation_id",
    "event_type",
    "source_system",
    "actor_type",
    "event_ts",
    "ingested_ts",
    "event_date",
    "payload",
)

# Payload paths of each reporting attribute, flat spelling first.
ATTRIBUTE_PATHS = {
    "campaign_id": ("campaign_id", "campaign.id"),
    "campaign_name": ("campaign_name", "campaign.name"),
    "template_id": ("template_id", "template.id"),
    "template_name": ("template_name", "template.name"),
    "template_channel": ("template_channel", "template.channel"),
    "provider": ("provider", "delivery.provider"),
    "delivery_status": ("status", "delivery.status"),
}


def stage_events(landing: DataFrame) -> DataFrame:
    """Landing rows with the seven reporting attributes; an unreadable payload has none."""
    parsed = parse_variant(landing.select(*STAGED_COLUMNS), landing["payload"], "details")
    attributes = [variant_text("details", *paths).alias(name) for name, paths in ATTRIBUTE_PATHS.items()]
    return parsed.select(*STAGED_COLUMNS, *attributes)


def stage_tenants(dimension: DataFrame) -> DataFrame:
    return dimension.select(*DIM_CUSTOMER_TENANT.fieldNames())


def stage_event_types(dimension: DataFrame) -> DataFrame:
    return dimension.select(*DIM_CUSTOMER_EVENT_TYPE.fieldNames())


def stage_daily_delivery(fact: DataFrame) -> DataFrame:
    return fact.select(*FCT_DAILY_DELIVERY.fieldNames())
