"""The streams between topics, and streaming counterparts of dedup and volume.

Each batch is parsed once and kept while its outputs are written. Without a fixed ``processing_time``
a batch takes the time it starts. What a stream cannot use goes to ``dead_letters`` with the reason.
Several streams may share a root; their records add up.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from letterlake.functions.text import CORRUPT
from letterlake.operators import cdc, dynamodb, operational, routing
from letterlake.operators.decode import (
    dead_letters,
    keyed,
    parse_envelopes,
    rejection,
    utc_wall_clock,
)
from letterlake.operators.lifecycle import LOG, gap_events, offset_ranges
from letterlake.operators.ranges import merge_ranges
from letterlake.sinks.merge import MergeTable
from letterlake.sinks.tables import write_batch
from letterlake.sinks.topics import publish
from letterlake.sources.topics import (
    CUSTOMER,
    DASHBOARD,
    HEALTH,
    INTERNAL,
    NORMALIZED,
    OPERATIONAL,
    RAW,
    Topic,
)
from letterlake.streaming.batches import start_batches

Outputs = list[tuple[Topic, DataFrame]]


def utc_now() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")


def as_json() -> Column:
    return F.to_json(F.struct("*"))


def _write_rejected(parsed: DataFrame, reason: Column, root: str, batch_id: int, writer: str) -> None:
    rejected = utc_wall_clock(dead_letters(parsed, reason))
    write_batch(rejected, f"{root}/dead_letters", batch_id, writer=writer)


def _start_publishing(
    topic: DataFrame,
    parse: Callable[[DataFrame], DataFrame],
    outputs: Callable[[DataFrame, str], Outputs],
    reason: Column,
    root: str,
    checkpoint: str,
    processing_time: str | None,
    servers: str | None,
    once: bool,
) -> StreamingQuery:
    """Publishes ``outputs(parsed, now)`` of each batch, and its dead letters."""

    def process(batch: DataFrame, batch_id: int, writer: str) -> None:
        now = processing_time or utc_now()
        parsed = parse(batch).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for target, pairs in outputs(parsed, now):
                publish(pairs, target, batch_id, writer=writer, servers=servers, root=root)
            _write_rejected(parsed, reason, root, batch_id, writer)
        finally:
            parsed.unpersist()

    return start_batches(topic, process, checkpoint, once)


def start_lifecycle_router(
    topic: DataFrame,
    root: str,
    checkpoint: str,
    processing_time: str | None = None,
    *,
    servers: str | None = None,
    once: bool = False,
) -> StreamingQuery:
    """Routes raw lifecycle records to the internal, customer and health topics."""

    def outputs(parsed: DataFrame, now: str) -> Outputs:
        routed = routing.with_routes(parsed)
        # The contract wants the payload as an object.
        health = routing.health_events(routed, now).withColumn("payload", F.parse_json("payload"))
        return [
            (INTERNAL, keyed(routing.route(routed, "internal"), "message_id")),
            (CUSTOMER, keyed(routing.route(routed, "customer"), "tenant_id")),
            (HEALTH, keyed(health, "event_type", as_json())),
        ]

    # A record without an event id is routed all the same.
    malformed = F.when(F.col(CORRUPT).isNotNull(), rejection())
    return _start_publishing(
        topic, parse_envelopes, outputs, malformed, root, checkpoint, processing_time, servers, once
    )


def start_operational_router(
    topic: DataFrame,
    root: str,
    checkpoint: str,
    processing_time: str | None = None,
    *,
    servers: str | None = None,
    once: bool = False,
) -> StreamingQuery:
    """Enriches operational records and publishes them to the tracking and the dashboard topic."""

    def process(batch: DataFrame, batch_id: int, writer: str) -> None:
        now = processing_time or utc_now()
        parsed = operational.parse_operational(batch).persist(StorageLevel.MEMORY_AND_DISK)
        enriched = operational.enrich(parsed, now).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            pairs = keyed(enriched, "message_id", as_json())
            for target in (INTERNAL, DASHBOARD):
                publish(pairs, target, batch_id, writer=writer, servers=servers, root=root)
            documents = operational.dashboard_documents(enriched)
            write_batch(documents, f"{root}/dashboard_documents", batch_id, writer=writer)
            _write_rejected(parsed, operational.rejection(), root, batch_id, writer)
        finally:
            for kept in (enriched, parsed):
                kept.unpersist()

    return start_batches(topic, process, checkpoint, once)


def start_normalizer(
    topic: DataFrame, root: str, checkpoint: str, *, servers: str | None = None, once: bool = False
) -> StreamingQuery:
    """Publishes normalised events, and the narrow customer and internal projections of them."""

    def outputs(parsed: DataFrame, now: str) -> Outputs:
        normalized = routing.normalize_lifecycle(parsed.where(F.col(CORRUPT).isNull()))
        rows = {
            NORMALIZED: normalized,
            CUSTOMER: routing.customer_projection(normalized),
            INTERNAL: routing.internal_projection(normalized),
        }
        return [(target, keyed(part, target.key, as_json())) for target, part in rows.items()]

    reason = F.when(F.col(CORRUPT).isNotNull(), rejection()).when(
        ~routing.identified(), F.lit("missing_identifier")
    )
    return _start_publishing(
        topic, parse_envelopes, outputs, reason, root, checkpoint, None, servers, once
    )


def start_change_producer(
    changes: DataFrame,
    root: str,
    checkpoint: str,
    processing_time: str | None = None,
    *,
    servers: str | None = None,
    once: bool = False,
) -> StreamingQuery:
    """Publishes database changes as canonical events to the raw lifecycle topic."""

    def outputs(parsed: DataFrame, now: str) -> Outputs:
        return [(RAW, keyed(cdc.canonical_events(parsed, now), RAW.key, as_json()))]

    return _start_publishing(
        changes, cdc.parse_changes, outputs, cdc.rejection(), root, checkpoint, processing_time, servers, once
    )


def start_attribute_producer(
    records: DataFrame,
    root: str,
    checkpoint: str,
    processing_time: str | None = None,
    *,
    servers: str | None = None,
    once: bool = False,
) -> StreamingQuery:
    """Publishes key-value store changes as operational events to the operational topic."""

    def outputs(parsed: DataFrame, now: str) -> Outputs:
        events = dynamodb.operational_events(dynamodb.numbered_records(parsed), now)
        return [(OPERATIONAL, keyed(events, OPERATIONAL.key, as_json()))]

    return _start_publishing(
        records,
        dynamodb.parse_records,
        outputs,
        dynamodb.rejection(),
        root,
        checkpoint,
        processing_time,
        servers,
        once,
    )


def dedup_stream(events: DataFrame, delay: str = "1 hour") -> DataFrame:
    """First delivery of each event id; a redelivery within ``delay`` of the first is dropped.

    The watermark follows the time of arrival, which only grows: no event is late, one without an
    event time passes like any other, and the state still expires. Redeliveries after ``delay`` are
    caught at landing.
    """
    arrived = events.withColumn("_arrived_at", F.current_timestamp())
    unique = arrived.withWatermark("_arrived_at", delay).dropDuplicatesWithinWatermark(["event_id"])
    return unique.drop("_arrived_at")


_VOLUME = T.StructType(
    [T.StructField("bucket_start", T.TimestampType()), T.StructField("events", T.LongType())]
)


def volume_table(spark: SparkSession, root: str) -> MergeTable:
    """Number of events per time bucket, batch by batch."""

    def summed(rows: DataFrame) -> DataFrame:
        return rows.groupBy("bucket_start").agg(F.sum("events").alias("events"))

    return MergeTable(spark, root, summed, _VOLUME)


def start_volume(
    events: DataFrame,
    root: str,
    checkpoint: str,
    interval: str = "1 hour",
    *,
    once: bool = False,
    compact_every: int = 50,
) -> StreamingQuery:
    """Keeps the number of events per time bucket in ``volume_table``.

    Each batch adds its own counts, so nothing is held in state and an event may be late by any time.
    As in the batch histogram, events without a time are in no bucket.
    """

    def process(batch: DataFrame, batch_id: int, writer: str) -> None:
        bucket = F.window("event_ts", interval)["start"]
        counted = batch.where(F.col("event_ts").isNotNull()).select(
            bucket.alias("bucket_start"), F.lit(1).cast("bigint").alias("events")
        )
        table = volume_table(batch.sparkSession, root)
        table.add(counted, batch_id, writer)
        if compact_every and batch_id and batch_id % compact_every == 0:
            table.compact(batch_id - 1, writer)

    return start_batches(events, process, checkpoint, once)


_RANGES = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("first", T.LongType()),
        T.StructField("last", T.LongType()),
    ]
)


def offset_table(spark: SparkSession, root: str) -> MergeTable:
    """The offsets seen so far as merged ranges; batches may come in any order, and twice."""
    return MergeTable(spark, root, lambda rows: merge_ranges(rows, LOG), _RANGES)


def start_offset_tracking(
    records: DataFrame, root: str, checkpoint: str, *, once: bool = False, compact_every: int = 50
) -> StreamingQuery:
    """Keeps the offsets of all records in ``offset_table``.

    A late record closes its gap, a redelivered one changes nothing.
    """

    def process(batch: DataFrame, batch_id: int, writer: str) -> None:
        table = offset_table(batch.sparkSession, root)
        table.add(offset_ranges(batch), batch_id, writer)
        if compact_every and batch_id and batch_id % compact_every == 0:
            table.compact(batch_id - 1, writer)

    return start_batches(records, process, checkpoint, once)


def current_gaps(spark: SparkSession, root: str) -> DataFrame:
    """Offsets that lie between seen ones and were not seen."""
    return gap_events(offset_table(spark, root).current())
