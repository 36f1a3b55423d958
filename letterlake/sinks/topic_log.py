"""Topics kept in folders, with true offsets: unique, gapless and in key order per partition.

A topic is a table of the commit log below the root, with a folder per topic partition. A batch is numbered
by a prefix sum over what the tasks sorted: it is sorted once by partition and key into staged files, in
which a row knows its task and its place there; the rows of each (partition, task) are counted; the
running total of these few counts gives every task its first offset. No window spans a partition's
records, and a key or partition with very many of them continues in the next task.

The next offset of a partition is a note of the commit that adds the records. Of two writers one commits
first; the other numbers its staged rows again from there. A replayed batch is noted and changes nothing.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from letterlake.functions.clock import duration
from letterlake.functions.sizes import broadcast_if_small
from letterlake.schemas import TOPIC
from letterlake.sinks.commits import FAN, Change, FileSet, Snapshot, TableLog
from letterlake.sinks.tables import WRITER
from letterlake.sources.topics import Topic

STAGED = "staged"
STORED = T.StructType([TOPIC[name] for name in ("key", "value", "partition", "offset", "timestamp")])
# A row number made by monotonically_increasing_id holds the task above these bits.
_TASK_BITS = 33


def partition_of(key: Column, value: Column, partitions: int) -> Column:
    """The topic partition of a record: by its key, without one by its value.

    By MD5, which writers outside Spark can compute as well.
    """
    digest = F.md5(F.coalesce(key, value, F.lit("")).cast("binary"))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), F.lit(partitions)).cast("int")


def _utc(moment: dt.datetime) -> dt.datetime:
    return moment if moment.tzinfo else moment.replace(tzinfo=dt.UTC)


class TopicLog:
    def __init__(self, spark: SparkSession, root: str, topic: Topic):
        self.spark, self.topic, self.log = spark, topic, TableLog(spark, root)

    def _next(self, partition: int) -> str:
        return f"next/{self.topic.name}/{partition}"

    def _time(self, name: str) -> str:
        return f"time/{self.topic.name}/{name}"

    # Writing.

    def _stage(self, pairs: DataFrame, order: tuple[str, ...]) -> FileSet:
        placed = pairs.withColumn("partition", partition_of(F.col("key"), F.col("value"), self.topic.partitions))
        # The value comes last, so that a key without an order, too, can be cut into several tasks.
        columns = list(dict.fromkeys(["partition", "key", *order, "value"]))
        rows = placed.repartitionByRange(*columns).sortWithinPartitions(*columns)
        return self.log.write(rows.select("key", "value", "partition", F.monotonically_increasing_id().alias("row")), STAGED)

    def append(
        self, pairs: DataFrame, batch_id: int, *order: str, writer: str = WRITER, now: dt.datetime | None = None
    ) -> Snapshot:
        """Adds (key, value) pairs in the order of their keys, and of the columns ``order`` within a key.

        Batches of a writer come in the order of their numbers. A null key is a record without a key.
        ``now`` is the records' time, UTC unless it says otherwise.
        """
        now = _utc(now or dt.datetime.now(dt.UTC))
        note = f"published/{self.topic.name}/{writer}"

        def noted(snapshot: Snapshot) -> bool:
            return int(snapshot.notes.get(note, -1)) >= batch_id

        if noted(before := self.log.snapshot()):
            return before
        staged = self._stage(pairs, order)
        rows = self.log.read_set(staged).withColumn("task", F.shiftright("row", _TASK_BITS))
        counts = rows.groupBy("partition", "task").agg(F.count("*").alias("records"), F.min("row").alias("first_row"))
        # One row per task and topic partition it holds, a few more than there are tasks.
        earlier = Window.partitionBy("partition").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
        total = F.coalesce(F.sum("records").over(earlier), F.lit(0))
        starts = counts.select("partition", "task", "records", (total - F.col("first_row")).alias("shift")).persist()

        def number(snapshot: Snapshot) -> Change:
            sizes = {row.partition: row.records for row in starts.groupBy("partition").agg(F.sum("records").alias("records")).collect()}
            ends = {partition: int(snapshot.notes.get(self._next(partition), 0)) for partition in sizes}
            base = F.create_map(*[F.lit(x) for pair in ends.items() for x in pair]) if ends else F.lit(None)
            placed = rows.join(broadcast_if_small(starts.drop("records")), ["partition", "task"])
            offset = (F.col("row") + F.col("shift") + base[F.col("partition")]).cast("bigint") if ends else F.lit(0).cast("bigint")
            records = placed.select("key", "value", "partition", offset.alias("offset"), F.lit(now).alias("timestamp"))
            added = self.log.write(records.sortWithinPartitions("partition", "offset"), self.topic.name, "partition")
            notes = {note: str(batch_id)} | {self._next(p): str(end + sizes[p]) for p, end in ends.items()}
            if sizes:
                notes[self._time(added.name)] = now.isoformat()
            return Change(add=[added], notes=notes, notes_read=[self._next(p) for p in ends])

        try:
            return self.log.transact(number, unless=noted)
        finally:
            starts.unpersist()
            self.log.discard(staged)

    # Reading.

    def ends(self) -> dict[int, int]:
        """The next offset of each partition that ever had a record."""
        notes = self.log.snapshot().notes
        found = ((partition, notes.get(self._next(partition))) for partition in range(self.topic.partitions))
        return {partition: int(end) for partition, end in found if end is not None}

    def read(self, since: Mapping[int, int] | None = None) -> DataFrame:
        """Records with their coordinates, all or those from the given offset on.

        ``since`` is offset by partition; other partitions are left out. Only folders of the partitions
        asked for are visited, and of these the row groups whose offsets are asked for.
        """
        wanted = None if since is None else [f"partition={partition}" for partition in since]
        rows = self.log.read(self.log.snapshot(), self.topic.name, STORED, wanted)
        if since:
            rows = rows.where(reduce(or_, [(F.col("partition") == p) & (F.col("offset") >= first) for p, first in since.items()]))
        return rows.withColumn("topic", F.lit(self.topic.name)).select(*TOPIC.fieldNames())

    # Upkeep.

    def expire(self, now: dt.datetime, keep: str | None = None) -> Snapshot:
        """Drops the sets older than ``keep`` (the topic's retention), by metadata alone; offsets go on.

        A batch's records have one time, and merged batches are of one day, so whole sets expire, with their
        newest record. Their files go with ``vacuum``.
        """
        oldest = _utc(now) - duration(keep or self.topic.retention)

        def drop(snapshot: Snapshot) -> Change | None:
            sets = snapshot.sets(self.topic.name)
            times = {name: snapshot.notes.get(self._time(name)) for name in sets}
            old = [name for name, time in times.items() if time and dt.datetime.fromisoformat(time) < oldest]
            if not old:
                return None
            # Sets that were merged into others leave their notes.
            dead = [note for note in snapshot.notes if note.startswith(self._time("")) and note.removeprefix(self._time("")) not in sets]
            dropped = {name: list(sets[name]) for name in old}
            return Change(drop={self.topic.name: dropped}, notes=dict.fromkeys([*dead, *map(self._time, old)]))

        return self.log.transact(drop)

    def compact(self, fan: int = FAN) -> Snapshot:
        """Merges batches of like size and the same day, so that sets stay few."""

        def time(snapshot: Snapshot, name: str) -> str:
            return snapshot.notes.get(self._time(name), "")

        return self.log.compact(
            self.topic.name,
            STORED,
            "partition",
            lambda rows: rows.hint("rebalance", "partition").sortWithinPartitions("partition", "offset"),
            fan,
            alike=lambda snapshot, name: time(snapshot, name)[:10],
            notes=lambda snapshot, merged, name: {self._time(name): max(time(snapshot, one) for one in merged)},
        )
