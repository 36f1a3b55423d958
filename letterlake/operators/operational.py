"""Operational status records: enrichment and dashboard documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from letterlake.functions.clock import epoch_millis, event_timestamp, instant, iso_text, ntz
from letterlake.functions.text import CORRUPT, is_blank, parse_object, parse_variant, variant_text
from letterlake.operators.decode import COORDINATES, dead_letters
from letterlake.operators.dynamodb import OPERATIONAL_EVENT_TYPE, OPERATIONAL_SOURCE
from letterlake.schemas import OPERATIONAL_FIELDS, strings

DASHBOARD_SOURCE = "internal_mail_tracking"

_WIRE = strings(
    "event_id",
    "event_type",
    "event_version",
    "event_time",
    "source_system",
    "tenant_id",
    "message_id",
    "correlation_id",
    "status",
    "mailbox_id",
    "processing_stage",
    "provider",
    "error_code",
    "error_message",
    "payload_json",
    "payload",
)


def parse_operational(topic: DataFrame) -> DataFrame:
    """Coordinates, raw value, root fields, and the payload (object or JSON text) as a variant."""
    records = topic.where(F.col("value").isNotNull())
    parsed = parse_object(records, "value", _WIRE, [*COORDINATES, "value"])
    text = F.coalesce("payload_json", F.col("payload"))
    return parse_variant(
        parsed.withColumn("payload_json", text).drop("payload"), F.col("payload_json"), "details"
    )


def rejection() -> Column:
    """Why a record cannot be enriched; one without a message is dropped, whatever its payload."""
    unreadable = (
        ~is_blank(F.col("message_id")) & ~is_blank(F.col("payload_json")) & F.col("details").isNull()
    )
    return F.when(F.col(CORRUPT).isNotNull(), F.lit("not_json_object")).when(
        unreadable, F.lit("malformed_payload")
    )


def enrich(parsed: DataFrame, processing_time: str) -> DataFrame:
    """The 15 operational fields: root value, else payload value, else the default.

    Records without a message are dropped. A field that is present but empty keeps its empty text.
    """
    now = instant(processing_time)

    def root_or_payload(name: str, default: str | None = None) -> Column:
        values = [F.col(name), variant_text("details", name)]
        return F.coalesce(*values, *([F.lit(default)] if default else []))

    millis = F.unix_millis(event_timestamp(F.col("event_time")))
    fields = {
        "event_id": F.col("event_id"),
        "event_type": F.coalesce("event_type", F.lit(OPERATIONAL_EVENT_TYPE)),
        "event_version": F.coalesce("event_version", F.lit("1.0.0")),
        "source_system": F.coalesce("source_system", F.lit(OPERATIONAL_SOURCE)),
        "tenant_id": F.col("tenant_id"),
        "message_id": F.col("message_id"),
        "correlation_id": F.coalesce("correlation_id", "message_id"),
        "status": root_or_payload("status", "unknown"),
        "mailbox_id": root_or_payload("mailbox_id", "unknown"),
        "processing_stage": root_or_payload("processing_stage", "unknown"),
        "provider": root_or_payload("provider"),
        "error_code": root_or_payload("error_code"),
        "error_message": root_or_payload("error_message"),
        "event_time": F.coalesce(millis, epoch_millis(now)),
        "dashboard_ts": iso_text(now),
    }
    return parsed.where(rejection().isNull() & ~is_blank(F.col("message_id"))).select(
        *[fields[name].alias(name) for name in OPERATIONAL_FIELDS]
    )


def ops_enrich(topic: DataFrame, processing_time: str) -> DataFrame:
    return enrich(parse_operational(topic), processing_time)


def operational_dead_letters(topic: DataFrame) -> DataFrame:
    return dead_letters(parse_operational(topic), rejection())


def dashboard_documents(enriched: DataFrame) -> DataFrame:
    """Typed search documents: event time and indexing time as dates, plus the source label."""
    shown = event_timestamp(F.col("dashboard_ts"))
    return enriched.withColumns(
        {
            "event_time": ntz(F.timestamp_millis("event_time")),
            "dashboard_ts": ntz(shown),
            "dashboard_source": F.lit(DASHBOARD_SOURCE),
            "@timestamp": ntz(shown),
        }
    )
