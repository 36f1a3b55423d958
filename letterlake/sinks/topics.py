"""Publishing (key, value) pairs to topics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from letterlake.sinks.tables import WRITER
from letterlake.sinks.topic_log import TopicLog
from letterlake.sources.topics import Topic


def in_key_order(pairs: DataFrame, topic: Topic, *order: str) -> DataFrame:
    """Rows sorted by key and ``order``, for consumers that need a key's records one after another.

    The sort ranges are cut by key and order together: a key with very many records continues in
    the next task instead of filling one. Kafka needs none of this; it places records by their key.
    """
    columns = ["key", *order]
    return pairs.repartitionByRange(topic.partitions, *columns).sortWithinPartitions(*columns)


def publish(
    pairs: DataFrame,
    topic: Topic,
    batch_id: int,
    *,
    writer: str = WRITER,
    servers: str | None = None,
    root: str | None = None,
) -> None:
    """Writes to Kafka (at least once) or to the topic's folder under ``root``.

    In a folder records get offsets in the order of their keys; a replayed batch changes nothing.
    """
    if servers:
        (
            pairs.select("key", "value")
            .write.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("topic", topic.name)
            .save()
        )
        return
    if not root:
        raise ValueError("give Kafka servers or a folder")
    TopicLog(pairs.sparkSession, root, topic).append(pairs, batch_id, writer=writer)


def published(spark: SparkSession, root: str, topic: Topic) -> DataFrame:
    """The records that all writers have published to a topic's folder."""
    return TopicLog(spark, root, topic).read().select("key", "value")
