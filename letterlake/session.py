"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

RECORD_SETTINGS = {
    # Record text packs to a tenth: a split of the default size would hold a million records to parse.
    "spark.sql.files.maxPartitionBytes": "16m",
    # The JVM only interprets a longer method, as the checks and projections of a record generate; beyond
    # this length Spark evaluates them in several compiled ones.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app_name: str = "letterlake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; a cluster's own settings win where given."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return use_record_settings(use_utc(builder.getOrCreate()))


def use_utc(spark: SparkSession) -> SparkSession:
    """All event times are UTC wall-clock times, so the session zone must be UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def use_record_settings(spark: SparkSession) -> SparkSession:
    """Settings for many long text records; those that the application has set stay."""
    given = spark.sparkContext.getConf()
    for key, value in RECORD_SETTINGS.items():
        if not given.contains(key):
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    On a cluster it is the one named in ``spark.checkpoint.dir``, which must be set. Only on one machine
    a temporary folder is taken instead and remembered for the session.
    """
    key = "spark.checkpoint.dir"
    folder = spark.conf.get(key, None) or spark.sparkContext.getConf().get(key)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{key} must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="letterlake-")
        spark.conf.set(key, folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")
