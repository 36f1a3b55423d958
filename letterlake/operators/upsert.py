"""Insert-or-replace by key on plain parquet."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from letterlake.functions.sizes import broadcast_if_small
from letterlake.operators.latest import first_by
from letterlake.schemas import FCT_MAIL_LIFECYCLE
from letterlake.sinks.commits import Change, Snapshot, TableLog, partition_value

ROWS = "rows"


def newest_first() -> list[Column]:
    """The last ingested lifecycle row first; the other columns decide ties, so reruns agree."""
    first = ("ingested_at", "event_time")
    others = [name for name in FCT_MAIL_LIFECYCLE.fieldNames() if name not in first]
    return [F.col(name).desc_nulls_last() for name in (*first, *others)]


def merge_by_key(existing: DataFrame, batch: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """``existing`` with the rows of ``batch`` replacing those of the same key."""
    incoming = first_by(batch, (key,), order)
    return existing.join(incoming.select(key), key, "left_anti").unionByName(incoming)


def stored_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The table that ``upsert_table`` keeps at ``path``, None before the first batch."""
    log = TableLog(spark, path)
    return log.read(log.snapshot(), ROWS)


def upsert_table(
    spark: SparkSession, path: str, batch: DataFrame, key: str, partition: str, order: list[Column]
) -> None:
    """Merges ``batch`` into a partitioned table, rewriting only the partitions it touches.

    Touched are the partitions of incoming rows and those holding the rows they replace; the latter
    are found by a scan of the key and partition columns alone. All of them change by one commit, also
    those whose every row moved elsewhere: a driver lost before it leaves the table as it was. A batch
    that another writer's commit outdates is merged anew. Running the same batch again gives the same table.
    """
    log = TableLog(spark, path)
    incoming = first_by(batch, (key,), order).persist(StorageLevel.MEMORY_AND_DISK)

    def values(rows: DataFrame) -> set[str | None]:
        # One value per touched partition: bounded by the number of partitions of the table.
        return {row[0] for row in rows.select(F.col(partition).cast("string")).distinct().collect()}

    def merge(snapshot: Snapshot) -> Change:
        keys = broadcast_if_small(incoming.select(key))
        existing = log.read(snapshot, ROWS)
        touched: list[str] = []
        merged = incoming
        if existing is not None:
            changed = values(incoming) | values(existing.select(key, partition).join(keys, key, "left_semi"))
            touched = [folder for folder in snapshot.partitions(ROWS) if partition_value(folder) in changed]
            held = log.read(snapshot, ROWS, existing.schema, touched)
            merged = held.join(keys, key, "left_anti").unionByName(incoming)
        written = log.write(merged.hint("rebalance", partition), ROWS, partition)
        dropped = {one: [folder for folder in touched if folder in sizes] for one, sizes in snapshot.sets(ROWS).items()}
        # Another writer may have put a row of ours into any partition.
        return Change([written], {ROWS: {one: found for one, found in dropped.items() if found}}, {ROWS: None})

    try:
        log.transact(merge)
    finally:
        incoming.unpersist()
