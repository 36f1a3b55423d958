"""Latest message state, kept from a stream of lifecycle rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from letterlake.operators.latest import first_by, latest_per_message
from letterlake.operators.upsert import newest_first
from letterlake.schemas import FCT_MAIL_LIFECYCLE
from letterlake.sinks.merge import MergeTable
from letterlake.streaming.batches import start_batches


def newest(lifecycle: DataFrame) -> DataFrame:
    """The lifecycle fact: the last ingested row per event id.

    A message's state is ranked from the fact, so a correction of an event must replace its row
    before messages are compared.
    """
    return first_by(lifecycle, ("event_id",), newest_first())


def tracking_table(spark: SparkSession, root: str) -> MergeTable:
    return MergeTable(spark, root, newest, FCT_MAIL_LIFECYCLE)


def current_states(spark: SparkSession, root: str) -> DataFrame:
    return latest_per_message(tracking_table(spark, root).current())


def start_tracking(
    lifecycle: DataFrame, root: str, checkpoint: str, *, once: bool = False, compact_every: int = 50
) -> StreamingQuery:
    def process(batch: DataFrame, batch_id: int, writer: str) -> None:
        table = tracking_table(batch.sparkSession, root)
        table.add(batch, batch_id, writer)
        if compact_every and batch_id and batch_id % compact_every == 0:
            table.compact(batch_id - 1, writer)

    return start_batches(lifecycle, process, checkpoint, once)
