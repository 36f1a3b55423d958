"""Marts of the semantic layer and the joins that build them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from letterlake.functions.clock import event_timestamp, ntz
from letterlake.functions.rates import rate
from letterlake.functions.text import parse_variant, variant_text
from letterlake.operators.latest import first_by
from letterlake.operators.upsert import newest_first

GRID_SLICES = 32


def delivery_daily_metrics(fact: DataFrame, tenants: DataFrame) -> DataFrame:
    """Daily delivery with rates and the tenant's lifetime events (0 for an unknown tenant).

    No broadcast hint: the tenant dimension grows with the data. Adaptive execution broadcasts it
    when its measured size allows.
    """
    lifetime = tenants.select("tenant_id", F.col("total_events").alias("tenant_lifetime_events"))
    return (
        fact.join(lifetime, "tenant_id", "left")
        .withColumn("tenant_lifetime_events", F.coalesce("tenant_lifetime_events", F.lit(0)))
        .withColumns(
            {
                "open_rate": rate("opened_count", "delivered_count"),
                "click_through_rate": rate("clicked_count", "delivered_count"),
                "delivery_success_rate": rate("delivered_count", "requested_count"),
            }
        )
    )


def customer_delivery_summary(metrics: DataFrame) -> DataFrame:
    return metrics.select(
        "tenant_id",
        "event_date",
        "requested_count",
        "dispatched_count",
        "delivered_count",
        "opened_count",
        "clicked_count",
        "open_rate",
        "click_through_rate",
        "delivery_success_rate",
        "tenant_lifetime_events",
    )


def customer_tenant(tenants: DataFrame) -> DataFrame:
    return tenants.select(
        "tenant_id",
        "first_seen_at",
        "last_seen_at",
        F.col("total_events").alias("tenant_total_events"),
    )


def event_type(event_types: DataFrame) -> DataFrame:
    return event_types.select("event_type", "first_seen_at", "last_seen_at", "total_events")


def _performance(metrics: DataFrame, dimension: DataFrame, entity: str, labels: list[str]) -> DataFrame:
    keys = ["tenant_id", f"{entity}_id"]
    described = dimension.select(
        *keys,
        *labels,
        F.col("total_events").alias(f"{entity}_total_events"),
        F.col("first_seen_at").alias(f"{entity}_first_seen_at"),
        F.col("last_seen_at").alias(f"{entity}_last_seen_at"),
    )
    measures = [name for name in metrics.columns if name not in keys]
    return metrics.join(described, keys, "left").select(
        *keys,
        *labels,
        *measures,
        f"{entity}_total_events",
        f"{entity}_first_seen_at",
        f"{entity}_last_seen_at",
    )


def campaign_performance(metrics: DataFrame, dimension: DataFrame) -> DataFrame:
    """A day's metrics repeat for every attribute combination the dimension has for a campaign."""
    return _performance(metrics, dimension, "campaign", ["campaign_name", "provider"])


def template_performance(metrics: DataFrame, dimension: DataFrame) -> DataFrame:
    return _performance(
        metrics, dimension, "template", ["template_name", "template_channel", "provider"]
    )


def one_description(dimension: DataFrame, entity: str, labels: list[str]) -> DataFrame:
    """One dimension row per entity, the most recently seen, so that the join keeps the key unique."""
    order = [F.col("last_seen_at").desc_nulls_last(), F.col("provider").asc_nulls_last()]
    order += [F.col(name).asc_nulls_last() for name in labels if name != "provider"]
    return first_by(dimension, ("tenant_id", f"{entity}_id"), order)


def reporting_dimensions(tenants: DataFrame, event_types: DataFrame) -> DataFrame:
    """Every tenant with every event type.

    The grid itself is the result, but it needs no nested-loop join: event types repeat once per
    slice and tenants are dealt over the slices, which leaves an equi-join that spreads evenly.
    """
    slices = F.sequence(F.lit(0), F.lit(GRID_SLICES - 1))
    right = event_types.select(
        "event_type",
        F.col("first_seen_at").alias("event_type_first_seen_at"),
        F.col("last_seen_at").alias("event_type_last_seen_at"),
        F.col("total_events").alias("event_type_total_events"),
        F.explode(slices).alias("_slice"),
    )
    left = tenants.select(
        "tenant_id",
        "first_seen_at",
        "last_seen_at",
        F.col("total_events").alias("tenant_total_events"),
        F.pmod(F.xxhash64("tenant_id"), F.lit(GRID_SLICES)).cast("int").alias("_slice"),
    )
    return left.join(right, "_slice").drop("_slice")


def empty_relation(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A typed relation without rows: the contract of a table that is not loaded yet."""
    nulls = [F.lit(None).cast(field.dataType).alias(field.name) for field in schema.fields]
    return spark.range(1).select(*nulls).where(F.lit(False))


def lifecycle_from_events(normalized: DataFrame) -> DataFrame:
    """Normalised lifecycle events as rows of the lifecycle fact."""
    parsed = parse_variant(normalized, normalized["payload"], "details")
    return parsed.select(
        "event_id",
        "event_type",
        "tenant_id",
        "message_id",
        "correlation_id",
        variant_text("details", "provider", "delivery.provider").alias("provider_id"),
        "event_time",
        "ingested_at",
        _latest_status(variant_text("details", "status", "delivery.status")).alias("latest_status"),
        variant_text("details", "error_code").alias("failure_code"),
    )


def _latest_status(status: Column) -> Column:
    return F.coalesce(status, F.split_part(F.col("event_type"), F.lit("."), F.lit(2)))


def lifecycle_from_operational(enriched: DataFrame) -> DataFrame:
    """Operational records with an id as rows of the lifecycle fact."""
    return enriched.where(F.col("event_id").isNotNull()).select(
        "event_id",
        "event_type",
        "tenant_id",
        "message_id",
        "correlation_id",
        F.col("provider").alias("provider_id"),
        ntz(F.timestamp_millis("event_time")).alias("event_time"),
        ntz(event_timestamp(F.col("dashboard_ts"))).alias("ingested_at"),
        _latest_status(F.col("status")).alias("latest_status"),
        F.col("error_code").alias("failure_code"),
    )


def fct_mail_lifecycle(lifecycle: DataFrame, operational: DataFrame) -> DataFrame:
    """The lifecycle fact: both producers, one row per event id (the last ingested)."""
    return first_by(lifecycle.unionByName(operational), ("event_id",), newest_first())


def dim_tenant(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Conformed tenants from account and order tables; created with the first order."""
    created = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.min("o_orderdate").alias("created")
    )
    return customers.join(created, "c_custkey", "left").select(
        F.col("c_custkey").cast("string").alias("tenant_id"),
        F.col("c_name").alias("tenant_name"),
        F.col("c_mktsegment").alias("tenant_tier"),
        F.col("created").cast("timestamp_ntz").alias("tenant_created_at"),
    )


def dim_provider(suppliers: DataFrame, nations: DataFrame, regions: DataFrame, kind: str = "mail") -> DataFrame:
    """Conformed providers with the region they work from."""
    places = nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return suppliers.join(places, F.col("s_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("s_suppkey").cast("string").alias("provider_id"),
        F.col("s_name").alias("provider_name"),
        F.lit(kind).alias("provider_type"),
        F.col("r_name").alias("provider_region"),
    )
