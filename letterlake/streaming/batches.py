"""Starting a stream whose batches are written by a function."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import Future

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

Process = Callable[[DataFrame, int, str], None]


def start_batches(rows: DataFrame, process: Process, checkpoint: str, once: bool) -> StreamingQuery:
    """Calls ``process(batch, batch_id, writer)`` for every batch that has rows.

    ``writer`` is the query's id: restarts from the same checkpoint keep it, a new checkpoint gets a
    new one. Batch numbers start at 0 with every checkpoint, so only both together name a batch.
    With ``once`` the stream ends when the waiting records are done.
    """
    started: Future[str] = Future()

    def run(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            process(batch, batch_id, started.result())

    stream = rows.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    query = (stream.trigger(availableNow=True) if once else stream).start()
    started.set_result(query.id)
    return query
