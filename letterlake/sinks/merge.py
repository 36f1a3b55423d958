"""Tables that grow by micro-batches and are merged when read."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from letterlake.sinks.tables import (
    WRITER,
    drop_partition,
    drop_versions,
    folders,
    overwrite_version,
    read_batches,
    versions,
    write_batch,
)


class MergeTable:
    """Rows per batch, of which ``merge`` makes the current state.

    Adding a batch costs the size of the batch, whatever the size of the table. ``merge`` must give
    the same state whether it sees all rows at once or merged parts of them (counts, minima, maxima,
    the newest row of a key); ``schema`` is that of merged rows. ``compact`` folds the old batches of
    a writer together, so reading stays cheap.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        merge: Callable[[DataFrame], DataFrame],
        schema: T.StructType,
    ):
        self.spark = spark
        self.batches = f"{root}/batches"
        self.folded = f"{root}/folded"
        self.merge = merge
        self.schema = schema

    def add(self, batch: DataFrame, batch_id: int, writer: str = WRITER) -> None:
        """Stores the batch, merged within itself; a replay replaces the earlier attempt."""
        write_batch(self.merge(batch), self.batches, batch_id, writer=writer)

    def _stored(self) -> DataFrame:
        return read_batches(self.spark, self.batches, self.schema)

    def _state(self, writer: str, version: int) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.folded_by(writer)}/v={version}")

    def folded_by(self, writer: str) -> str:
        """Folded states of one writer; a state's version is the last batch folded into it."""
        return f"{self.folded}/writer={writer}"

    def added(self, batch_id: int, writer: str = WRITER) -> DataFrame:
        return self._stored().where((F.col("writer") == writer) & (F.col("batch_id") == batch_id))

    def current(self) -> DataFrame:
        rows, states = self._stored(), []
        # One entry per stream that ever wrote here and has compacted.
        for writer in folders(self.spark, self.folded, "writer"):
            reached = versions(self.spark, self.folded_by(writer))[-1:]
            for version in reached:
                rows = rows.where((F.col("writer") != writer) | (F.col("batch_id") > version))
                states.append(self._state(writer, version))
        return self.merge(reduce(DataFrame.unionByName, states, rows.drop("writer", "batch_id")))

    def compact(self, up_to: int, writer: str = WRITER) -> None:
        """Folds the writer's batches up to ``up_to`` and drops those folded before.

        Call it for batches that will not run again, that is, below the running one.
        """
        path = self.folded_by(writer)
        before = versions(self.spark, path)
        if not before or before[-1] < up_to:
            rows = self._stored().where((F.col("writer") == writer) & (F.col("batch_id") <= up_to))
            states = []
            for version in before[-1:]:
                rows = rows.where(F.col("batch_id") > version)
                states.append(self._state(writer, version))
            rows = reduce(DataFrame.unionByName, states, rows.drop("writer", "batch_id"))
            overwrite_version(self.merge(rows), path, up_to)
        # Readers that began before this compaction still find the batches it folded.
        for version in versions(self.spark, path)[:-1][-1:]:
            own = f"{self.batches}/writer={writer}"
            for batch_id in folders(self.spark, own, "batch_id"):
                if int(batch_id) <= version:
                    drop_partition(self.spark, own, "batch_id", batch_id)
        drop_versions(self.spark, path)
