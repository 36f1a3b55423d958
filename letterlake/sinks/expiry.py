"""Expiry and storage tiers of tables that a commit log keeps by day.

Whole days go by metadata, without reading a row. Only the day that the limit falls into is rewritten, and
only if it holds an expired row. Rows without a day stay. Files go with ``TableLog.vacuum`` later, so that
readers of an earlier version are not disturbed.
"""

from __future__ import annotations

import datetime as dt
from collections import defaultdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from letterlake.functions.clock import duration
from letterlake.operators.retention import HOT_DAYS, WARM_DAYS, apply_retention
from letterlake.sinks.commits import Change, FileSet, Snapshot, TableLog, partition_value

# What is read less often is packed tighter.
TIERS = (("warm", HOT_DAYS, {"compression": "zstd"}), ("cold", WARM_DAYS, {"compression": "zstd", "parquet.compression.codec.zstd.level": "12"}))


def _day(partition: str) -> dt.date | None:
    value = partition_value(partition)
    return None if value is None else dt.date.fromisoformat(value)


def _dropped(snapshot: Snapshot, table: str, partitions: list[str]) -> dict[str, list[str]]:
    gone: dict[str, list[str]] = defaultdict(list)
    for partition in partitions:
        for name in snapshot.partitions(table)[partition]:
            gone[name].append(partition)
    return dict(gone)


def _ordered(rows: DataFrame, day: str, sort: tuple[str, ...]) -> DataFrame:
    return rows.hint("rebalance", day).sortWithinPartitions(day, *sort)


def expire(
    log: TableLog, table: str, schema: T.StructType, keep: str, now: str, *, day: str = "event_date", ts: str = "event_ts", sort: tuple[str, ...] = ()
) -> Snapshot:
    """Removes the rows that ``apply_retention`` would not keep; ``day`` is the date of ``ts``."""
    limit = dt.datetime.fromisoformat(now) - duration(keep)

    def build(snapshot: Snapshot) -> Change | None:
        days = {partition: _day(partition) for partition in snapshot.partitions(table)}
        past = [partition for partition, date in days.items() if date is not None and date < limit.date()]
        border = [partition for partition, date in days.items() if date == limit.date()]
        added: list[FileSet] = []
        if border:
            rows = log.read(snapshot, table, schema, border)
            if rows.where(F.col(ts) < F.lit(limit)).isEmpty():
                border = []
            else:
                added = [log.write(_ordered(apply_retention(rows, ts, keep, now), day, sort), table, day)]
        if not past and not border:
            return None
        return Change(add=added, drop={table: _dropped(snapshot, table, past + border)}, reads={table: past + border})

    return log.transact(build)


def tier_table(table: str, tier: str) -> str:
    return f"{table}_{tier}"


def move_tiers(log: TableLog, table: str, schema: T.StructType, now: str, *, day: str = "event_date", sort: tuple[str, ...] = ()) -> Snapshot:
    """Moves the days that are wholly past a tier's age into that tier's table, each step in one commit.

    A reader sees a day in exactly one tier.
    """
    moment = dt.datetime.fromisoformat(now)
    source = table
    snapshot = log.snapshot()
    for tier, age, options in TIERS:
        target, limit = tier_table(table, tier), (moment - dt.timedelta(days=age)).date()

        def build(snapshot: Snapshot, source: str = source, target: str = target, limit: dt.date = limit, options: dict = options) -> Change | None:
            past = [p for p in snapshot.partitions(source) if (date := _day(p)) is not None and date < limit]
            if not past:
                return None
            rows = _ordered(log.read(snapshot, source, schema, past), day, sort)
            return Change(add=[log.write(rows, target, day, **options)], drop={source: _dropped(snapshot, source, past)}, reads={source: past})

        snapshot, source = log.transact(build), target
    return snapshot


def read_tiers(log: TableLog, table: str, schema: T.StructType) -> DataFrame:
    """The table over all tiers, at one version, with the ``tier`` a row lies in."""
    snapshot = log.snapshot()
    parts = [("hot", table), *((tier, tier_table(table, tier)) for tier, _, _ in TIERS)]
    read = [log.read(snapshot, name, schema).withColumn("tier", F.lit(tier)) for tier, name in parts]
    return read[0].union(read[1]).union(read[2])
