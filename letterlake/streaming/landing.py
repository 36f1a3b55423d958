"""Landing a topic: micro-batches into the landing table, and the tables kept up to date from it.

Below the root folder, under one commit log (``sinks.commits``):

``landing``       good events by day, one row per event id, by tenant in the files
``event_ids``     the ids that have landed (``streaming.ledger``)
``activity``      rollups by day: counts and first/last times per key
``dead_letter_tokens``   where which token stands in the dead letters (``sinks.letter_index``)
``dim_customer_*``, ``fct_daily_customer_delivery``   the refreshed dimensions and daily fact

and beside it ``dead_letters/writer=/batch_id=``, what could not land, replaced when a batch
is run again before its commit.

A batch's events, ids and rollup become visible by one commit, which also notes the batch under its
writer: a batch that is run again after a failure finds itself noted and changes nothing, and one that
failed before its commit left nothing to see. Several streams may land under one root at the same moment.
A commit that was beaten by one that recorded ids in the same buckets looks its ids up again, so an
event that both received lands once.

Refreshing reads the rollups, never the events. Each refreshed table (the fact: each day of it) notes
which rollups it was built from; what is not built from the present ones is built anew. A refresh that
another landing outdates before its commit is computed again, so no refresh puts an older state back.
"""

from __future__ import annotations

import hashlib

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from letterlake.operators import activity
from letterlake.operators.decode import (
    COORDINATES,
    dead_letters,
    parse_envelopes,
    rejection,
    utc_wall_clock,
    with_times,
)
from letterlake.operators.latest import first_by
from letterlake.schemas import ENVELOPE_FIELDS, LANDING
from letterlake.sinks import letter_index
from letterlake.sinks.commits import FAN, Change, Snapshot, TableLog
from letterlake.sinks.tables import WRITER, write_batch
from letterlake.sources.lakehouse import SOURCE_TABLES
from letterlake.streaming import ledger
from letterlake.streaming.batches import start_batches

LANDED, ACTIVITY = "landing", "activity"
ACTIVITY_KEYS = ("tenant_id", "event_type", "event_date")

# What is kept up to date: table name to the function of the activity that gives it.
DIMENSIONS = {
    "dim_customer_tenant": activity.tenant_dimension,
    "dim_customer_event_type": activity.event_type_dimension,
}
FACT = "fct_daily_customer_delivery"
REFRESHED = {**DIMENSIONS, FACT: activity.daily_delivery_fact}


def landing_table(spark: SparkSession, root: str) -> DataFrame:
    log = TableLog(spark, root)
    return log.read(log.snapshot(), LANDED, LANDING)


def _first_deliveries(parsed: DataFrame) -> DataFrame:
    """One landing row per event id of the batch: the earliest record."""
    good = parsed.where(rejection().isNull()).select(*COORDINATES, *ENVELOPE_FIELDS)
    order = [F.col(name).asc() for name in ("timestamp", "topic", "partition", "offset")]
    events = with_times(first_by(good, ("event_id",), order).select(*ENVELOPE_FIELDS))
    return utc_wall_clock(events).select(*LANDING.fieldNames())


def _by_tenant(events: DataFrame) -> DataFrame:
    """Few files per day, large days split, rows of a tenant together."""
    return events.hint("rebalance", "event_date").sortWithinPartitions("event_date", "tenant_id")


def _rolled_up(rows: DataFrame) -> DataFrame:
    return activity.activity_rollup(rows, ACTIVITY_KEYS)


def land_batch(
    batch: DataFrame,
    batch_id: int,
    root: str,
    *,
    writer: str = WRITER,
    refresh: bool = True,
    compact_every: int = FAN,
) -> None:
    """Lands one micro-batch of topic records; it may hold no good event, or nothing else.

    Batches of a writer come in the order of their numbers. ``compact_every`` sets of like size are merged.
    """
    spark = batch.sparkSession
    if batch.isEmpty():
        return
    log = TableLog(spark, root)
    note = f"{LANDED}/{writer}"

    def noted(snapshot: Snapshot) -> bool:
        return int(snapshot.notes.get(note, -1)) >= batch_id

    def land(snapshot: Snapshot) -> Change:
        buckets = ledger.buckets_of(first)
        events = first.join(ledger.landed(log, snapshot, first, buckets), "event_id", "left_anti")
        events = events.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            added = [
                log.write(_by_tenant(events), LANDED, "event_date"),
                ledger.record(log, events),
                log.write(_rolled_up(events).hint("rebalance", "event_date"), ACTIVITY, "event_date"),
                letter_index.record(log, rejected, batch_id, writer),
            ]
        finally:
            events.unpersist()
        return Change(add=added, reads={ledger.TABLE: buckets}, notes={note: str(batch_id)})

    # The dead letters of a noted batch were written before its commit, so a replay need not read the records.
    if not noted(log.snapshot()):
        parsed = parse_envelopes(batch).persist(StorageLevel.MEMORY_AND_DISK)
        first = _first_deliveries(parsed).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            rejected = utc_wall_clock(dead_letters(parsed))
            write_batch(rejected, f"{root}/dead_letters", batch_id, writer=writer)
            log.transact(land, unless=noted)
        finally:
            for kept in (first, parsed):
                kept.unpersist()
    if refresh:
        refresh_tables(spark, root)
    if compact_every:
        compact(spark, root, compact_every)


class ActivityTable:
    """Counts and first/last times per key, of all that has landed."""

    def __init__(self, spark: SparkSession, root: str):
        self.log = TableLog(spark, root)
        self.schema = _rolled_up(spark.createDataFrame([], LANDING)).schema

    def at(self, snapshot: Snapshot, days: list[str] | None = None) -> DataFrame:
        return _rolled_up(self.log.read(snapshot, ACTIVITY, self.schema, days))

    def current(self) -> DataFrame:
        return self.at(self.log.snapshot())

    def compact(self, fan: int = FAN) -> Snapshot:
        return self.log.compact(ACTIVITY, self.schema, "event_date", _rolled_up, fan)


def activity_table(spark: SparkSession, root: str) -> ActivityTable:
    return ActivityTable(spark, root)


def compact(spark: SparkSession, root: str, fan: int = FAN) -> None:
    """Merges the sets that batches left, so that files and folders stay few."""
    log = TableLog(spark, root)
    log.compact(LANDED, LANDING, "event_date", _by_tenant, fan)
    ledger.compact(log, fan)
    letter_index.compact(log, fan)
    activity_table(spark, root).compact(fan)


def _inputs(sets) -> str:
    return hashlib.sha256(" ".join(sorted(sets)).encode()).hexdigest()


def _stale(snapshot: Snapshot) -> tuple[list[str], list[str]]:
    """(dimensions, days of the fact) that were not built from the present rollups."""
    whole = _inputs(snapshot.sets(ACTIVITY))
    dimensions = [name for name in DIMENSIONS if snapshot.notes.get(name) != whole]
    days = snapshot.partitions(ACTIVITY)
    return dimensions, [day for day, sets in days.items() if snapshot.notes.get(f"{FACT}/{day}") != _inputs(sets)]


def refresh_tables(spark: SparkSession, root: str) -> None:
    """Brings dimensions and daily fact up to date; equal to recomputing them from all events.

    The dimensions are small and written whole. Of the fact only the days with new rollups are written,
    from the rollups of those days.
    """
    table = activity_table(spark, root)
    log = table.log

    def refresh(snapshot: Snapshot) -> Change | None:
        dimensions, days = _stale(snapshot)
        if not dimensions and not days:
            return None
        change = Change(reads={ACTIVITY: None if dimensions else days})
        rollup = table.at(snapshot).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for name in dimensions:
                change.add.append(log.write(DIMENSIONS[name](rollup), name))
                change.drop[name] = {one: list(sizes) for one, sizes in snapshot.sets(name).items()}
                change.notes[name] = _inputs(snapshot.sets(ACTIVITY))
        finally:
            rollup.unpersist()
        if days:
            fact = activity.daily_delivery_fact(table.at(snapshot, days))
            change.add.append(log.write(fact.hint("rebalance", "event_date"), FACT, "event_date"))
            outdated = {one: [day for day in days if day in sizes] for one, sizes in snapshot.sets(FACT).items()}
            change.drop[FACT] = {one: found for one, found in outdated.items() if found}
            inputs = snapshot.partitions(ACTIVITY)
            change.notes |= {f"{FACT}/{day}": _inputs(inputs[day]) for day in days}
        return change

    log.transact(refresh)


def refreshed_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    log = TableLog(spark, root)
    return log.read(log.snapshot(), name, SOURCE_TABLES[name])


def start_landing(
    topic: DataFrame, root: str, checkpoint: str, *, once: bool = False
) -> StreamingQuery:
    """Starts the landing stream; with ``once`` it ends when the waiting records are done."""

    def process(batch: DataFrame, batch_id: int, writer: str) -> None:
        land_batch(batch, batch_id, root, writer=writer)

    return start_batches(topic, process, checkpoint, once)
