"""Topics: keyed, partitioned, retained logs of text records.

Every reader returns the columns of ``schemas.TOPIC``, so that the operators do not know whether
records come from Kafka or from files.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Topic:
    name: str
    partitions: int
    retention: str
    key: str | None


# The topics, their partition counts, retention times and record keys.
RAW = Topic("evt.mail.lifecycle.raw", 12, "7d", "message_id")
NORMALIZED = Topic("evt.mail.lifecycle.normalized", 12, "14d", "message_id")
CUSTOMER = Topic("evt.mail.customer.analytics", 6, "30d", "tenant_id")
INTERNAL = Topic("evt.mail.internal.tracking", 12, "30d", "message_id")
DASHBOARD = Topic("evt.mail.internal.tracking.dashboard", 12, "7d", "message_id")
DEAD_LETTERS = Topic("evt.mail.internal.tracking.dashboard.dlq", 6, "14d", None)
OPERATIONAL = Topic("evt.mail.operational.raw", 12, "14d", "message_id")
HEALTH = Topic("evt.platform.health", 3, "14d", "event_type")
CHANGES = Topic("dbz.postgres.mail.public.mail_events", 4, "7d", "message_id")

TOPICS = {
    topic.name: topic
    for topic in (
        RAW,
        NORMALIZED,
        CUSTOMER,
        INTERNAL,
        DASHBOARD,
        DEAD_LETTERS,
        OPERATIONAL,
        HEALTH,
        CHANGES,
    )
}


def _kafka_options(topic: str, servers: str, start: str, group: str | None) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": start,
        # A recreated topic leaves offset gaps; the stream goes on with what is there.
        "failOnDataLoss": "false",
    }
    if group:
        options["kafka.group.id"] = group
    return options


def read_topic(
    spark: SparkSession,
    topic: str,
    *,
    servers: str | None = None,
    path: str | None = None,
    start: str = "earliest",
    group: str | None = None,
    streaming: bool = False,
    max_per_trigger: int | None = None,
) -> DataFrame:
    """Records of ``topic`` from Kafka (``servers``) or from a folder of text lines (``path``).

    ``max_per_trigger`` bounds a micro-batch: offsets for Kafka, files for a folder.
    """
    reader = spark.readStream if streaming else spark.read
    if servers:
        options = _kafka_options(topic, servers, start, group)
        if not streaming:
            options["endingOffsets"] = "latest"
        elif max_per_trigger:
            options["maxOffsetsPerTrigger"] = str(max_per_trigger)
        rows = reader.format("kafka").options(**options).load()
        return rows.select(
            F.col("key").cast("string"),
            F.col("value").cast("string"),
            "topic",
            "partition",
            "offset",
            "timestamp",
        )
    if not path:
        raise ValueError("give Kafka servers or a folder")
    if streaming and max_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_per_trigger)
    lines = reader.format("text").option("ignoreMissingFiles", "true").load(path)
    # A text line has no offset: file name and position in the file stand in for the coordinates.
    return lines.select(
        F.lit(None).cast("string").alias("key"),
        "value",
        F.lit(topic).alias("topic"),
        F.pmod(F.xxhash64("_metadata.file_path"), F.lit(1 << 31)).cast("int").alias("partition"),
        (F.col("_metadata.file_block_start") + F.pmod(F.xxhash64("value"), F.lit(1 << 40))).alias("offset"),
        F.col("_metadata.file_modification_time").alias("timestamp"),
    )


def read_topic_table(
    spark: SparkSession, path: str, *, streaming: bool = False, max_files: int | None = None
) -> DataFrame:
    """A topic kept as a table with its coordinates (an archive to replay from)."""
    from letterlake.schemas import TOPIC

    reader = spark.readStream if streaming else spark.read
    if streaming and max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.schema(TOPIC).parquet(path)


def peek(topic: DataFrame, count: int = 5) -> DataFrame:
    """The first records of a topic by partition and offset."""
    return topic.orderBy("partition", "offset").limit(count)
