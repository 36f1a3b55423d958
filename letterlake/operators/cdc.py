"""Database change records as canonical events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from letterlake.functions.clock import epoch_millis, instant
from letterlake.functions.text import CORRUPT, blank_to_null, parse_object
from letterlake.operators.decode import COORDINATES
from letterlake.operators.routing import source_id
from letterlake.schemas import CDC_CHANGE, CDC_ROW, ENVELOPE_FIELDS

# Event type per change operation and the defaults of missing source fields.
OPERATION_EVENTS = {
    "c": "mail.requested",
    "r": "mail.requested",
    "u": "mail.updated",
    "d": "mail.deleted",
}
UNKNOWN_EVENT = "mail.unknown"
DEFAULT_OPERATION = "u"
DEFAULT_DATABASE = "postgres"
DEFAULT_TABLE = "unknown"


def parse_changes(topic: DataFrame) -> DataFrame:
    """Coordinates, raw value and the parts of the change; records without a value are skipped."""
    records = topic.where(F.col("value").isNotNull())
    return parse_object(records, "value", CDC_CHANGE, [*COORDINATES, "value"])


def _image() -> Column:
    return F.coalesce("payload.after", "payload.before")


def rejection() -> Column:
    """Why a record yields no event; NULL for one that does."""
    return F.when(F.col(CORRUPT).isNotNull(), F.lit("not_json_object")).when(
        _image().isNull(), F.lit("no_row_image")
    )


def cdc_to_canonical(topic: DataFrame, processing_time: str) -> DataFrame:
    return canonical_events(parse_changes(topic), processing_time)


def canonical_events(parsed: DataFrame, processing_time: str) -> DataFrame:
    """One canonical event per change that carries a row image; other records are skipped.

    The row is the ``after`` image, or ``before`` where there is none (deletes). Identifiers the
    source lacks derive from the record's place in the topic, so a redelivery yields the same event.
    """
    changes = parsed.where(F.col(CORRUPT).isNull()).select(
        *COORDINATES,
        F.coalesce("payload.op", F.lit(DEFAULT_OPERATION)).alias("op"),
        F.col("payload.ts_ms").try_cast("bigint").alias("ts_ms"),
        F.col("payload.source").alias("source"),
        _image().alias("image"),
    )
    rows = parse_object(
        changes.where(F.col("image").isNotNull()),
        "image",
        CDC_ROW,
        [*COORDINATES, "op", "ts_ms", "source", "image"],
    )
    event_type = F.lit(UNKNOWN_EVENT)
    for operation, name in OPERATION_EVENTS.items():
        event_type = F.when(F.col("op") == operation, F.lit(name)).otherwise(event_type)
    now = epoch_millis(instant(processing_time))
    message_id = F.coalesce(blank_to_null(F.col("message_id")), source_id("gen-"))
    events = {
        "event_id": source_id("cdc-"),
        "event_type": event_type,
        "event_version": F.lit("1.0.0"),
        "event_time": F.coalesce("ts_ms", now).cast("string"),
        "ingested_at": now.cast("string"),
        "source_system": F.concat_ws(
            ".",
            F.coalesce("source.db", F.lit(DEFAULT_DATABASE)),
            F.coalesce("source.table", F.lit(DEFAULT_TABLE)),
        ),
        "tenant_id": blank_to_null(F.col("tenant_id")),
        "message_id": message_id,
        "correlation_id": F.coalesce("source.txId", message_id),
        "trace_id": blank_to_null(F.col("trace_id")),
        "actor_type": F.lit("service"),
        "payload": F.col("image"),
    }
    return rows.select(*[events[name].alias(name) for name in ENVELOPE_FIELDS])
