"""Explicit schemas: no job infers one."""

from __future__ import annotations

from pyspark.sql import types as T


def strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


# Field names of the wire formats and tables.
ENVELOPE_FIELDS = (
    "event_id",
    "event_type",
    "event_version",
    "event_time",
    "ingested_at",
    "source_system",
    "tenant_id",
    "message_id",
    "correlation_id",
    "trace_id",
    "actor_type",
    "payload",
)

ENVELOPE = strings(*ENVELOPE_FIELDS)

OPERATIONAL_FIELDS = (
    "event_id",
    "event_type",
    "event_version",
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
    "event_time",
    "dashboard_ts",
)

# Columns every topic relation has, whatever it is read from.
TOPIC = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

LANDING = T.StructType(
    ENVELOPE.fields
    + [
        T.StructField("event_ts", T.TimestampNTZType()),
        T.StructField("ingested_ts", T.TimestampNTZType()),
        T.StructField("event_date", T.DateType()),
    ]
)

DEAD_LETTER = T.StructType(
    [
        T.StructField("raw_payload", T.StringType()),
        T.StructField("kafka_topic", T.StringType()),
        T.StructField("kafka_partition", T.IntegerType()),
        T.StructField("kafka_offset", T.LongType()),
        T.StructField("kafka_timestamp", T.TimestampNTZType()),
        T.StructField("reason", T.StringType()),
    ]
)

CDC_CHANGE = T.StructType(
    [
        T.StructField(
            "payload",
            T.StructType(
                [
                    T.StructField("op", T.StringType()),
                    T.StructField("ts_ms", T.StringType()),
                    T.StructField("source", strings("db", "schema", "table", "txId")),
                    T.StructField("before", T.StringType()),
                    T.StructField("after", T.StringType()),
                ]
            ),
        )
    ]
)

CDC_ROW = strings("message_id", "tenant_id", "trace_id")


def _activity_dimension(key: str) -> T.StructType:
    return T.StructType(
        [
            T.StructField(key, T.StringType()),
            T.StructField("first_seen_at", T.TimestampNTZType()),
            T.StructField("last_seen_at", T.TimestampNTZType()),
            T.StructField("total_events", T.LongType()),
        ]
    )


DIM_CUSTOMER_TENANT = _activity_dimension("tenant_id")
DIM_CUSTOMER_EVENT_TYPE = _activity_dimension("event_type")

FCT_DAILY_DELIVERY = T.StructType(
    [
        T.StructField("tenant_id", T.StringType()),
        T.StructField("event_date", T.DateType()),
        T.StructField("requested_count", T.LongType()),
        T.StructField("dispatched_count", T.LongType()),
        T.StructField("delivered_count", T.LongType()),
        T.StructField("opened_count", T.LongType()),
        T.StructField("clicked_count", T.LongType()),
    ]
)

# Conformed relations that are contracts first: typed and, before a load, empty.
DIM_TENANT = T.StructType(
    strings("tenant_id", "tenant_name", "tenant_tier").fields
    + [T.StructField("tenant_created_at", T.TimestampNTZType())]
)

DIM_PROVIDER = strings("provider_id", "provider_name", "provider_type", "provider_region")

FCT_MAIL_LIFECYCLE = T.StructType(
    strings(
        "event_id", "event_type", "tenant_id", "message_id", "correlation_id", "provider_id"
    ).fields
    + [
        T.StructField("event_time", T.TimestampNTZType()),
        T.StructField("ingested_at", T.TimestampNTZType()),
        T.StructField("latest_status", T.StringType()),
        T.StructField("failure_code", T.StringType()),
    ]
)
