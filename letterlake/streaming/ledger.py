"""The ids that have landed: hash buckets of sorted ids with bloom filters.

A bucket is a folder and its files are sorted by id, so looking up a batch visits the buckets its ids
hash to, and of those only row groups whose range and bloom filter admit one of the ids. The landed
events are not read at all.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from letterlake.functions.sizes import broadcast_if_small
from letterlake.sinks.commits import FileSet, Snapshot, TableLog

TABLE = "event_ids"
BUCKETS = 16
SCHEMA = T.StructType([T.StructField("event_id", T.StringType()), T.StructField("bucket", T.IntegerType())])
# So few ids are compared one by one, which reaches the bloom filters; more are joined.
POINT_LOOKUPS = 32
WRITE = {
    "parquet.bloom.filter.enabled#event_id": "true",
    # As long as a row group needs, rather than a megabyte each.
    "parquet.bloom.filter.adaptive.enabled": "true",
    "parquet.bloom.filter.candidates.number": "12",
    "parquet.block.size": str(16 * 1024 * 1024),
}


def bucketed(events: DataFrame) -> DataFrame:
    return events.select("event_id", F.pmod(F.xxhash64("event_id"), F.lit(BUCKETS)).cast("int").alias("bucket"))


def sorted_by_id(ids: DataFrame) -> DataFrame:
    return ids.hint("rebalance", "bucket").sortWithinPartitions("bucket", "event_id")


def record(log: TableLog, events: DataFrame) -> FileSet:
    return log.write(sorted_by_id(bucketed(events)), TABLE, "bucket", **WRITE)


def buckets_of(events: DataFrame) -> list[str]:
    """The folders that the events' ids belong to: ``BUCKETS`` at most."""
    return [f"bucket={row.bucket}" for row in bucketed(events).select("bucket").distinct().collect()]


def landed(log: TableLog, snapshot: Snapshot, events: DataFrame, buckets: list[str]) -> DataFrame:
    """Those ids of ``events``, which must be kept, that were recorded before."""
    known = log.read(snapshot, TABLE, SCHEMA, buckets)
    if not set(buckets).intersection(snapshot.partitions(TABLE)):
        # Nothing was recorded there: a join that the planner sees to be empty costs no look at the events.
        return known.where("false").select("event_id")
    first = [row.event_id for row in events.select("event_id").limit(POINT_LOOKUPS + 1).collect()]
    if not first:
        return known.where("false").select("event_id")
    if len(first) <= POINT_LOOKUPS:
        return known.where(reduce(or_, [F.col("event_id") == one for one in first])).select("event_id")
    # The bucket is part of the key, so that a join by shuffle keeps to the buckets, too.
    return known.join(broadcast_if_small(bucketed(events)), ["bucket", "event_id"], "left_semi").select("event_id")


def compact(log: TableLog, fan: int) -> Snapshot:
    return log.compact(TABLE, SCHEMA, "bucket", sorted_by_id, fan, **WRITE)
