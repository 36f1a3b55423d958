"""Parquet tables: batch-partitioned appends, versioned overwrites, partition drops."""

from __future__ import annotations

import time

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from letterlake.schemas import DEAD_LETTER

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"

# A batch is known by the stream that wrote it and its number there.
WRITER = "main"
BATCH_KEY = [T.StructField("writer", T.StringType()), T.StructField("batch_id", T.LongType())]


def _filesystem(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def drop_partition(spark: SparkSession, path: str, column: str, value: object) -> None:
    name = NULL_PARTITION if value is None else value
    files, where = _filesystem(spark, f"{path}/{column}={name}")
    files.delete(where, True)


def write_batch(
    batch: DataFrame,
    path: str,
    batch_id: int,
    *partitions: str,
    writer: str = WRITER,
    sort: tuple[str, ...] = (),
) -> None:
    """Writes a micro-batch under its writer and number; a replay replaces what it wrote before.

    Other writers' batches of the same number stay. ``sort`` orders the rows inside the files.
    """
    if partitions:
        # Few files per folder, and large folders split: sized by what the shuffle measured.
        batch = batch.hint("rebalance", *partitions).sortWithinPartitions(*partitions, *sort)
    (
        batch.withColumns({"writer": F.lit(writer), "batch_id": F.lit(batch_id).cast("bigint")})
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions, "writer", "batch_id")
        .parquet(path)
    )


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What ``write_batch`` wrote, with ``writer`` and ``batch_id``; empty before the first batch."""
    full = T.StructType(schema.fields + BATCH_KEY)
    files, where = _filesystem(spark, path)
    # A batch without rows leaves a folder that does not tell its partition columns.
    if not files.exists(where) or not any(status.isDirectory() for status in files.listStatus(where)):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).parquet(path).select(*full.fieldNames())


def dead_letter_table(spark: SparkSession, root: str) -> DataFrame:
    return read_batches(spark, f"{root}/dead_letters", DEAD_LETTER).drop(*[f.name for f in BATCH_KEY])


def folders(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of the partition folders directly below ``path``."""
    files, where = _filesystem(spark, path)
    if not files.exists(where):
        return []
    names = [status.getPath().getName() for status in files.listStatus(where)]
    return [name.removeprefix(f"{column}=") for name in names if name.startswith(f"{column}=")]


def versions(spark: SparkSession, path: str) -> list[int]:
    """Committed versions of a versioned table, oldest first."""
    files, where = _filesystem(spark, path)
    if not files.exists(where):
        return []
    found = []
    for status in files.listStatus(where):
        name = status.getPath().getName()
        done = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
        if name.startswith("v=") and files.exists(done):
            found.append(int(name[2:]))
    return sorted(found)


def overwrite_version(df: DataFrame, path: str, version: int) -> None:
    """Full refresh: readers go on with the last committed version until this one is complete."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/v={version}")


def next_version(spark: SparkSession, path: str) -> int:
    """A version after all committed ones; the clock keeps two writers from taking the same."""
    return max([time.time_ns() // 1000, *[version + 1 for version in versions(spark, path)[-1:]]])


def read_version(spark: SparkSession, path: str, at_most: int | None = None) -> DataFrame | None:
    """The last committed version, or the last one up to ``at_most``."""
    found = [v for v in versions(spark, path) if at_most is None or v <= at_most]
    return spark.read.parquet(f"{path}/v={found[-1]}") if found else None


def drop_versions(spark: SparkSession, path: str, keep: int = 2) -> None:
    for version in versions(spark, path)[:-keep]:
        files, where = _filesystem(spark, f"{path}/v={version}")
        files.delete(where, True)


def write_events(df: DataFrame, path: str) -> None:
    """The landing layout: a folder per day, rows of a tenant together inside the files.

    Row groups then carry narrow tenant ranges, which prune as a tenant folder would, without a
    folder per tenant and day. The rebalance splits a large day over several tasks.
    """
    (
        df.hint("rebalance", "event_date")
        .sortWithinPartitions("event_date", "tenant_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("event_date")
        .parquet(path)
    )
