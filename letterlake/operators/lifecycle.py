"""Questions about whole message lifecycles: stages, failures, latency, backlog, cohorts, gaps."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from letterlake.functions.clock import instant
from letterlake.functions.rates import rate
from letterlake.functions.text import is_blank
from letterlake.operators.activity import EVENT_MEASURES
from letterlake.operators.ranges import gaps_between, merge_ranges

# Event types by family, and the numbered lifecycle stages of a message.
EVENT_FAMILIES = {
    "intake": ("mail.requested", "mail.accepted", "mail.rejected", "mail.scheduled"),
    "enrichment": ("mail.normalized", "mail.enriched", "mail.classified", "mail.routed"),
    "dispatch": (
        "mail.dispatched",
        "mail.dispatch_failed",
        "mail.retry_scheduled",
        "mail.retry_exhausted",
    ),
    "delivery_outcome": ("mail.delivered", "mail.bounced", "mail.deferred", "mail.dropped"),
    "engagement": ("mail.opened", "mail.clicked", "mail.unsubscribed", "mail.complained"),
    "platform_health": (
        "pipeline.lag_detected",
        "pipeline.job_failed",
        "pipeline.job_recovered",
        "connector.cdc_gap_detected",
    ),
}
LIFECYCLE_STAGES = {
    1: ("mail.requested",),
    2: ("mail.accepted", "mail.rejected"),
    3: ("mail.normalized", "mail.enriched"),
    4: ("mail.routed",),
    5: ("mail.dispatched",),
    6: ("mail.delivered", "mail.deferred", "mail.bounced", "mail.dropped"),
    7: ("mail.opened", "mail.clicked", "mail.unsubscribed", "mail.complained"),
}
FAILURE_TYPES = ("mail.dispatch_failed", "mail.bounced", "mail.dropped", "mail.rejected")
RETRY_TYPES = ("mail.retry_scheduled",)
EXHAUSTED_TYPES = ("mail.retry_exhausted",)
CLOSED_TYPES = ("mail.delivered", "mail.bounced", "mail.dropped", "mail.rejected")


def _lookup(groups: dict, column: str) -> Column:
    pairs = [(F.lit(kind), F.lit(name)) for name, kinds in groups.items() for kind in kinds]
    return F.try_element_at(F.create_map(*chain.from_iterable(pairs)), F.col(column))


def classify(events: DataFrame) -> DataFrame:
    """Adds ``event_family`` and ``lifecycle_stage`` (1 to 7); NULL for types outside the taxonomy."""
    return events.withColumns(
        {
            "event_family": _lookup(EVENT_FAMILIES, "event_type"),
            "lifecycle_stage": _lookup(LIFECYCLE_STAGES, "event_type"),
        }
    )


def family_counts(events: DataFrame) -> DataFrame:
    return classify(events).groupBy("event_family", "lifecycle_stage").agg(F.count("*").alias("events"))


def audit_history(lifecycle: DataFrame) -> DataFrame:
    """Every recorded event in order of message and time.

    A range sort on message and time: the history of one very busy message spreads over several
    tasks, where a list or a window per message would gather it in one.
    """
    return lifecycle.select(
        "message_id",
        "event_time",
        "event_id",
        "event_type",
        "tenant_id",
        "correlation_id",
        "latest_status",
        "failure_code",
    ).orderBy("message_id", "event_time", "event_id")


def failure_tracking(lifecycle: DataFrame) -> DataFrame:
    """Failures and retries per message, for messages that had any."""
    kind = F.col("event_type")
    failed = kind.isin(*FAILURE_TYPES) | (F.col("latest_status") == "failed")
    retried = kind.isin(*RETRY_TYPES) | (F.col("latest_status") == "retrying")
    return (
        lifecycle.where(~is_blank(F.col("message_id")))
        .groupBy("message_id")
        .agg(
            F.count_if(failed).alias("failures"),
            F.count_if(retried).alias("retries"),
            F.count_if(kind.isin(*EXHAUSTED_TYPES)).alias("exhausted"),
            F.count("failure_code").alias("failure_codes"),
            F.min(F.when(failed, F.col("event_time"))).alias("first_failure_at"),
            F.max(F.when(failed, F.col("event_time"))).alias("last_failure_at"),
        )
        .where((F.col("failures") > 0) | (F.col("retries") > 0) | (F.col("exhausted") > 0))
    )


def delivery_latency(lifecycle: DataFrame) -> DataFrame:
    """Seconds from the first request of a message to its first delivery, with its provider.

    One aggregation: the provider travels with the earliest delivery inside ``min_by``.
    """
    requested = F.col("event_type") == "mail.requested"
    delivered = F.col("event_type") == "mail.delivered"
    place = F.struct("event_time", "event_id")
    return (
        lifecycle.where(~is_blank(F.col("message_id")) & (requested | delivered))
        .groupBy("message_id")
        .agg(
            F.min(F.when(requested, F.col("event_time"))).alias("requested_at"),
            F.min(F.when(delivered, F.col("event_time"))).alias("delivered_at"),
            F.min_by("provider_id", F.when(delivered, place)).alias("provider_id"),
        )
        .where(F.col("requested_at") <= F.col("delivered_at"))
        .withColumn(
            "latency_seconds",
            F.unix_seconds(F.col("delivered_at").cast("timestamp"))
            - F.unix_seconds(F.col("requested_at").cast("timestamp")),
        )
    )


def provider_sla(latencies: DataFrame, target_seconds: int) -> DataFrame:
    """Deliveries, latency and target breaches per provider."""
    late = F.col("latency_seconds") > target_seconds
    return latencies.groupBy("provider_id").agg(
        F.count("*").alias("deliveries"),
        F.min("latency_seconds").alias("fastest_seconds"),
        F.max("latency_seconds").alias("slowest_seconds"),
        (F.sum("latency_seconds").cast("double") / F.count("*")).alias("mean_seconds"),
        F.count_if(late).alias("breaches"),
        (F.count_if(~late).cast("double") / F.count("*")).alias("within_target_rate"),
    )


def provider_percentiles(latencies: DataFrame) -> DataFrame:
    """Exact latency percentiles per provider: the least value that so many per cent do not exceed.

    Equal latencies are counted before anything is sorted, so a provider's window holds one row per
    second that occurs, however many deliveries there are.
    """
    counts = latencies.where(F.col("latency_seconds").isNotNull()).groupBy("provider_id", "latency_seconds").count()
    provider = Window.partitionBy("provider_id")
    running = counts.withColumns(
        {"reached": F.sum("count").over(provider.orderBy("latency_seconds")), "all": F.sum("count").over(provider)}
    )
    points = [
        F.min(F.when(100 * F.col("reached") >= point * F.col("all"), F.col("latency_seconds"))).alias(f"p{point}_seconds")
        for point in (50, 95, 99)
    ]
    return running.groupBy("provider_id").agg(*points)


def backlog(lifecycle: DataFrame, now: str) -> DataFrame:
    """Messages without a closing event, per tenant: how many, and how old the oldest is."""
    closed = F.col("event_type").isin(*CLOSED_TYPES)
    messages = (
        lifecycle.where(~is_blank(F.col("message_id")))
        .groupBy("message_id")
        .agg(
            F.max("tenant_id").alias("tenant_id"),
            F.min("event_time").alias("opened_at"),
            F.bool_or(closed).alias("closed"),
        )
        .where(~F.col("closed"))
    )
    now = F.unix_seconds(instant(now).cast("timestamp"))
    return messages.groupBy("tenant_id").agg(
        F.count("*").alias("open_messages"),
        F.min("opened_at").alias("oldest_opened_at"),
        (now - F.unix_seconds(F.min("opened_at").cast("timestamp"))).alias("oldest_age_seconds"),
    )


def engagement_rollup(daily: DataFrame) -> DataFrame:
    """Campaign counts with subtotals per tenant and in total; ``level`` is 0, 1 and 3."""
    sums = [F.sum(name).alias(name) for name in EVENT_MEASURES]
    rolled = daily.rollup("tenant_id", "campaign_id").agg(F.grouping_id().cast("int").alias("level"), *sums)
    return rolled.withColumns(
        {
            "open_rate": rate("opened_count", "delivered_count"),
            "click_through_rate": rate("clicked_count", "delivered_count"),
        }
    )


def campaign_trend(daily: DataFrame) -> DataFrame:
    """Delivered and opened counts against the campaign's previous active day."""
    days = Window.partitionBy("tenant_id", "campaign_id").orderBy("event_date")
    return daily.select(
        "tenant_id",
        "campaign_id",
        "event_date",
        "delivered_count",
        "opened_count",
        (F.col("delivered_count") - F.lag("delivered_count").over(days)).alias("delivered_change"),
        (F.col("opened_count") - F.lag("opened_count").over(days)).alias("opened_change"),
    )


def tenant_kpis(fact: DataFrame, days: int = 7) -> DataFrame:
    """Daily counts per tenant with the totals and rates of the last ``days`` days."""
    day = F.datediff(F.col("event_date"), F.lit("1970-01-01").cast("date"))
    span = Window.partitionBy("tenant_id").orderBy(day).rangeBetween(-(days - 1), 0)
    rolling = {
        f"rolling_{name}": F.sum(name).over(span)
        for name in ("requested_count", "delivered_count", "opened_count")
    }
    return (
        fact.select("tenant_id", "event_date", *EVENT_MEASURES)
        .withColumns(rolling)
        .withColumns(
            {
                "rolling_open_rate": rate("rolling_opened_count", "rolling_delivered_count"),
                "rolling_success_rate": rate("rolling_delivered_count", "rolling_requested_count"),
            }
        )
    )


def tenant_cohorts(fact: DataFrame) -> DataFrame:
    """Tenants by the week of their first activity: how many are active how many weeks later."""
    week = F.to_date(F.date_trunc("week", F.col("event_date")))
    active = fact.select("tenant_id", week.alias("week")).distinct()
    first = fact.groupBy("tenant_id").agg(F.min(week).alias("cohort_week"))
    return (
        active.join(first, "tenant_id")
        .withColumn("weeks_later", F.expr("cast(datediff(week, cohort_week) div 7 as int)"))
        .groupBy("cohort_week", "weeks_later")
        .agg(F.count("*").alias("active_tenants"))
    )


def date_dimension(events: DataFrame) -> DataFrame:
    """Every calendar day from the first to the last event."""
    span = events.agg(F.min("event_date").alias("low"), F.max("event_date").alias("high"))
    days = span.where(F.col("low").isNotNull()).select(
        F.explode(F.sequence("low", "high")).alias("date_day")
    )
    return days.select(
        "date_day",
        F.year("date_day").alias("year"),
        F.quarter("date_day").alias("quarter"),
        F.month("date_day").alias("month"),
        F.dayofmonth("date_day").alias("day"),
        F.weekday("date_day").alias("weekday"),
        F.weekofyear("date_day").alias("week"),
        (F.weekday("date_day") >= 5).alias("is_weekend"),
    )


def workflow_dimension(events: DataFrame) -> DataFrame:
    """One row per workflow (correlation id): its span and size."""
    return (
        events.where(F.col("correlation_id").isNotNull())
        .groupBy("correlation_id")
        .agg(
            F.min("event_ts").alias("started_at"),
            F.max("event_ts").alias("last_event_at"),
            F.count("*").alias("events"),
            F.count_if(F.col("event_type") == "mail.delivered").alias("deliveries"),
        )
    )


def for_tenant(df: DataFrame, tenant_id: str) -> DataFrame:
    """What one tenant may see."""
    return df.where(F.col("tenant_id") == tenant_id)


def lag_events(parsed: DataFrame, event_ts: Column, threshold_seconds: int) -> DataFrame:
    """Records that reached the topic too long after they happened."""
    lag = F.unix_seconds("timestamp") - F.unix_seconds(event_ts)
    return parsed.withColumn("lag_seconds", lag).where(F.col("lag_seconds") > threshold_seconds).select(
        "topic",
        "partition",
        "offset",
        "event_id",
        F.lit("pipeline.lag_detected").alias("event_type"),
        "lag_seconds",
    )


LOG = ["topic", "partition"]


def offset_ranges(records: DataFrame) -> DataFrame:
    """Each record's place in its log as a range of one offset."""
    return records.select(*LOG, F.col("offset").alias("first"), F.col("offset").alias("last"))


def gap_events(merged: DataFrame) -> DataFrame:
    """Missing offset ranges per partition, of merged ranges."""
    return gaps_between(merged, LOG).withColumn("event_type", F.lit("connector.cdc_gap_detected"))


def offset_gaps(topic: DataFrame) -> DataFrame:
    """Missing offset ranges per partition; the topic is read once."""
    return gap_events(merge_ranges(offset_ranges(topic), LOG))
