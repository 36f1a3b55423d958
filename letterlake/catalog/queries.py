"""Every operator as a query over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from letterlake import schemas
from letterlake.catalog import inputs
from letterlake.catalog.inputs import PROCESSING_TIME, table
from letterlake.functions.clock import event_timestamp
from letterlake.operators import (
    activity,
    cdc,
    contracts,
    dashboards,
    decode,
    dynamodb,
    history,
    latest,
    lifecycle,
    operational,
    quality,
    retention,
    routing,
    staging,
    upsert,
)
from letterlake.plans import graph, marts, semantic
from letterlake.session import scratch_path, use_record_settings, use_utc
from letterlake.sinks import expiry, letter_index, tables
from letterlake.sinks.commits import Change, Snapshot, TableLog
from letterlake.sinks.topic_log import TopicLog
from letterlake.sinks.topics import published
from letterlake.sources import lakehouse, topics
from letterlake.streaming import landing as landing_stream
from letterlake.streaming import routers, tracking

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

FRESHNESS_TIME = "2024-01-31 00:00:00"
SLA_SECONDS = 3600
LAG_SECONDS = 60


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return decode.utc_wall_clock(function(use_record_settings(use_utc(spark)), sf_dir))

    QUERIES[function.__name__] = run
    return function


# Relations several queries start from.


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_events(inputs.landing_events(spark, sf_dir))


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.parse_envelopes(inputs.lifecycle_topic(spark, sf_dir))


def normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    well_formed = parsed(spark, sf_dir).where(F.col("_corrupt").isNull())
    return routing.normalize_lifecycle(well_formed)


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operational.ops_enrich(inputs.operational_topic(spark, sf_dir), PROCESSING_TIME)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operational.dashboard_documents(enriched(spark, sf_dir))


def dead(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.utc_wall_clock(decode.dead_letters(parsed(spark, sf_dir)))


def lifecycle_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.lifecycle_from_events(normalized(spark, sf_dir)).unionByName(
        marts.lifecycle_from_operational(enriched(spark, sf_dir))
    )


def lifecycle_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.fct_mail_lifecycle(
        marts.lifecycle_from_events(normalized(spark, sf_dir)),
        marts.lifecycle_from_operational(enriched(spark, sf_dir)),
    )


def tenants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity.tenant_dimension(inputs.landing_events(spark, sf_dir))


def event_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity.event_type_dimension(inputs.landing_events(spark, sf_dir))


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity.daily_delivery_fact(inputs.landing_events(spark, sf_dir))


def daily_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.delivery_daily_metrics(daily(spark, sf_dir), tenants(spark, sf_dir))


def campaign_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity.campaign_daily_metrics(staged(spark, sf_dir))


def template_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity.template_daily_metrics(staged(spark, sf_dir))


# Sources and sinks.


@query
def src_topic_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "topic")
    lines = inputs.lifecycle_topic(spark, sf_dir).where(F.col("value").isNotNull())
    lines.select("value").write.text(path)
    # Two writers number half of the lines each; what the first one sends again changes nothing.
    pairs = topics.read_topic(spark, topics.RAW.name, path=path).select("key", "value")
    half = F.expr("cast(conv(substring(md5(value), 9, 4), 16, 10) as bigint) % 2")
    log = TopicLog(spark, scratch_path(spark, "numbered"), topics.RAW)
    for writer in (0, 1, 0):
        log.append(pairs.where(half == writer), 0, writer=f"writer-{writer}")
    return log.read().select("topic", "partition", "offset", "value")


@query
def src_lakehouse_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "lakehouse")
    events = inputs.landing_events(spark, sf_dir)
    tables.write_events(events, f"{root}/{lakehouse.LANDING_EVENTS}")
    stored = lakehouse.source_table(spark, lakehouse.LANDING_EVENTS, root=root)
    for name, build in landing_stream.REFRESHED.items():
        build(stored).write.parquet(f"{root}/{name}")
    return dashboards.document_counts(
        {name: lakehouse.source_table(spark, name, root=root) for name in lakehouse.SOURCE_TABLES}
    )


@query
def keyed_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    well_formed = parsed(spark, sf_dir).where(F.col("_corrupt").isNull())
    return decode.keyed(well_formed, topics.RAW.key)


@query
def land_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "land")
    batch = inputs.lifecycle_topic(spark, sf_dir)
    for _ in range(2):  # the second run is a replay and changes nothing
        landing_stream.land_batch(batch, 0, root, refresh=False)
    return landing_stream.landing_table(spark, root)


@query
def dead_letter_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = F.coalesce(decode.rejection(), F.lit("landing")).alias("target")
    return parsed(spark, sf_dir).groupBy(target).agg(F.count("*").alias("records"))


@query
def dead_letter_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dead(spark, sf_dir).drop("reason")


@query
def dead_letter_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "letters")
    landing_stream.land_batch(inputs.lifecycle_topic(spark, sf_dir), 0, root, refresh=False)
    found = letter_index.search(spark, root, "malformed_non_json_101")
    return found.select("raw_payload", "kafka_partition", "kafka_offset")


@query
def dead_letter_redaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    hidden = decode.redact(dead(spark, sf_dir), ("event_id", "tenant_id", "message_id"))
    return hidden.select("kafka_partition", "kafka_offset", "raw_payload")


# Parsing and routing.


@query
def decode_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.decode_envelope(inputs.lifecycle_topic(spark, sf_dir))


@query
def normalize_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalized(spark, sf_dir)


@query
def customer_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.customer_projection(normalized(spark, sf_dir))


@query
def internal_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.internal_projection(normalized(spark, sf_dir))


@query
def route_internal(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = routing.with_routes(parsed(spark, sf_dir))
    return decode.keyed(routing.route(routed, "internal"), topics.INTERNAL.key)


@query
def route_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = routing.with_routes(parsed(spark, sf_dir))
    return decode.keyed(routing.route(routed, "customer"), topics.CUSTOMER.key)


@query
def route_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = routing.with_routes(parsed(spark, sf_dir))
    return routing.route(routed, "health").select("value")


@query
def health_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.health_events(routing.with_routes(parsed(spark, sf_dir)), PROCESSING_TIME)


@query
def cdc_to_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.cdc_to_canonical(inputs.change_topic(spark, sf_dir), PROCESSING_TIME)


@query
def ddb_records_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = dynamodb.stream_records(inputs.attribute_topic(spark, sf_dir))
    name = F.try_variant_get("record", "$.eventName", "string").alias("event_name")
    return records.select("topic", "partition", "offset", "record_no", name)


@query
def ddb_unmarshal(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = T.StructType(
        schemas.strings("message_id", "mail_id", "status").fields
        + [
            T.StructField("attempts", T.IntegerType()),
            T.StructField("flagged", T.BooleanType()),
            T.StructField(
                "details",
                T.StructType(
                    [
                        T.StructField("region", T.StringType()),
                        T.StructField("size", T.LongType()),
                        T.StructField("tags", T.ArrayType(T.StringType())),
                    ]
                ),
            ),
        ]
    )
    images = dynamodb.new_images(dynamodb.stream_records(inputs.attribute_topic(spark, sf_dir)))
    return dynamodb.unmarshal(images, schema).select(
        "offset",
        "partition",
        "message_id",
        "mail_id",
        "status",
        "attempts",
        "flagged",
        "details.region",
        "details.size",
        F.array_join("details.tags", ",").alias("tags"),
    )


@query
def ddb_to_operational(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dynamodb.ddb_to_operational(inputs.attribute_topic(spark, sf_dir), PROCESSING_TIME)


@query
def ops_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enriched(spark, sf_dir)


@query
def dashboard_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir)


@query
def operational_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operational.operational_dead_letters(inputs.operational_topic(spark, sf_dir))


@query
def internal_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = routing.union_internal(
        normalized(spark, sf_dir).drop("event_time"), enriched(spark, sf_dir).drop("event_time")
    )
    return both.select(
        "event_id",
        "event_type",
        "tenant_id",
        "message_id",
        "correlation_id",
        "status",
        "processing_stage",
        "payload",
    )


# Staging, dimensions, facts, marts.


@query
def stg_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged(spark, sf_dir)


@query
def stg_tenant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_tenants(tenants(spark, sf_dir))


@query
def stg_event_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_event_types(event_types(spark, sf_dir))


@query
def stg_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_daily_delivery(daily(spark, sf_dir))


@query
def dim_tenant_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tenants(spark, sf_dir)


@query
def dim_event_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_types(spark, sf_dir)


@query
def fct_daily_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily(spark, sf_dir)


@query
def delivery_daily_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_metrics(spark, sf_dir)


@query
def customer_delivery_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.customer_delivery_summary(daily_metrics(spark, sf_dir))


@query
def mart_customer_tenant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.customer_tenant(tenants(spark, sf_dir))


@query
def mart_event_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.event_type(event_types(spark, sf_dir))


@query
def campaign_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return campaign_days(spark, sf_dir)


@query
def template_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return template_days(spark, sf_dir)


@query
def campaign_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity.campaign_dimension(staged(spark, sf_dir))


@query
def template_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity.template_dimension(staged(spark, sf_dir))


@query
def campaign_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    dimension = activity.campaign_dimension(staged(spark, sf_dir))
    return marts.campaign_performance(campaign_days(spark, sf_dir), dimension)


@query
def campaign_performance_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    dimension = activity.campaign_dimension(staged(spark, sf_dir))
    once = marts.one_description(dimension, "campaign", ["campaign_name"])
    return marts.campaign_performance(campaign_days(spark, sf_dir), once)


@query
def template_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    dimension = activity.template_dimension(staged(spark, sf_dir))
    return marts.template_performance(template_days(spark, sf_dir), dimension)


@query
def template_performance_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    dimension = activity.template_dimension(staged(spark, sf_dir))
    once = marts.one_description(dimension, "template", ["template_name", "template_channel"])
    return marts.template_performance(template_days(spark, sf_dir), once)


def _sources(spark: SparkSession, sf_dir: str) -> dict[str, Callable[[], DataFrame]]:
    return {
        "lifecycle_records": lambda: marts.lifecycle_from_events(normalized(spark, sf_dir)),
        "operational_records": lambda: marts.lifecycle_from_operational(enriched(spark, sf_dir)),
        "accounts": lambda: table(spark, sf_dir, "customer"),
        "orders": lambda: table(spark, sf_dir, "orders"),
        "suppliers": lambda: table(spark, sf_dir, "supplier"),
        "nations": lambda: table(spark, sf_dir, "nation"),
        "regions": lambda: table(spark, sf_dir, "region"),
    }


def _layer(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    root = scratch_path(spark, "layer")
    events = inputs.landing_events(spark, sf_dir)
    return semantic.build_semantic_layer(spark, events, root, more=_sources(spark, sf_dir), only=(name,))[name]


@query
def layer_campaign_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _layer(spark, sf_dir, "campaign_performance")


@query
def layer_template_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _layer(spark, sf_dir, "template_performance")


@query
def layer_delivery_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _layer(spark, sf_dir, "customer_delivery_summary")


@query
def layer_internal_mail_tracking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _layer(spark, sf_dir, "internal_mail_tracking")


@query
def layer_fct_mail_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _layer(spark, sf_dir, "fct_mail_lifecycle")


@query
def layer_dim_tenant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _layer(spark, sf_dir, "dim_tenant")


@query
def layer_dim_provider(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _layer(spark, sf_dir, "dim_provider")


@query
def reporting_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.reporting_dimensions(tenants(spark, sf_dir), event_types(spark, sf_dir))


@query
def fct_mail_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lifecycle_fact(spark, sf_dir)


@query
def internal_mail_tracking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest.latest_per_message(lifecycle_fact(spark, sf_dir))


@query
def dim_tenant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.dim_tenant(table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders"))


@query
def dim_provider(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.dim_provider(
        table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    )


def _kept(spark: SparkSession, rows: DataFrame, name: str) -> DataFrame:
    """Rows that several steps read, as a stored table; their records are parsed once."""
    path = scratch_path(spark, name)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _corrections(fact: DataFrame) -> DataFrame:
    """A later delivery of every bounce, with a corrected status."""
    bounced = fact.where(F.col("event_type") == "mail.bounced")
    return bounced.withColumns(
        {
            "ingested_at": F.col("ingested_at") + F.expr("interval 1 hour"),
            "latest_status": F.lit("corrected"),
        }
    )


@query
def incremental_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _kept(spark, marts.lifecycle_from_events(normalized(spark, sf_dir)), "lifecycle-rows")
    existing = latest.first_by(events, ("event_id",), upsert.newest_first())
    operational_rows = _kept(spark, marts.lifecycle_from_operational(enriched(spark, sf_dir)), "operational-rows")
    batch = events.unionByName(_corrections(events)).unionByName(operational_rows)
    return upsert.merge_by_key(existing, batch, "event_id", upsert.newest_first())


@query
def upsert_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "lifecycle")
    fact = _kept(spark, lifecycle_fact(spark, sf_dir), "fact").withColumn("event_date", F.to_date("event_time"))
    order = upsert.newest_first()
    for batch in (fact, _corrections(fact)):
        upsert.upsert_table(spark, path, batch, "event_id", "event_date", order)
    return upsert.stored_table(spark, path).select(*schemas.FCT_MAIL_LIFECYCLE.fieldNames())


# Dashboards.


@query
def volume_over_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.volume_over_time(documents(spark, sf_dir), "event_time", "1 hour")


@query
def volume_over_time_auto(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.volume_over_time(documents(spark, sf_dir), "event_time")


@query
def events_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.top_terms(documents(spark, sf_dir), "event_type", 10)


@query
def status_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.top_terms(documents(spark, sf_dir), "status", 10)


@query
def top_tenants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.top_terms(documents(spark, sf_dir), "tenant_id", 20)


@query
def dlq_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.volume_over_time(dead(spark, sf_dir), "kafka_timestamp", "1 hour")


@query
def dlq_top_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.top_terms(dead(spark, sf_dir), "kafka_partition", 10)


@query
def recent_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ties = [F.col("event_id").desc_nulls_last(), F.col("message_id").desc(), F.col("event_type").asc()]
    return dashboards.most_recent(
        documents(spark, sf_dir), "event_time", dashboards.RECENT_EVENT_COLUMNS, ties, 50
    )


@query
def recent_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    ties = [F.col("kafka_partition").asc(), F.col("kafka_offset").desc()]
    return dashboards.most_recent(
        dead(spark, sf_dir), "kafka_timestamp", dashboards.RECENT_DEAD_LETTER_COLUMNS, ties, 50
    )


@query
def topic_peek(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topics.peek(inputs.lifecycle_topic(spark, sf_dir)).select("partition", "offset", "value")


@query
def sink_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.document_counts(
        {
            "internal-mail-tracking": documents(spark, sf_dir),
            "internal-mail-tracking-deadletter": dead(spark, sf_dir),
        }
    )


# Retention, deduplication, quality.


@query
def dedup_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest.dedup_events(decode.decode_envelope(inputs.lifecycle_topic(spark, sf_dir)))


@query
def retention_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = retention.apply_retention(
        inputs.landing_events(spark, sf_dir), "event_ts", topics.RAW.retention, PROCESSING_TIME
    )
    return kept.select("event_id", "event_ts")


@query
def retention_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = inputs.landing_events(spark, sf_dir)
    tiers = retention.with_tier(events, "event_ts", PROCESSING_TIME)
    return tiers.groupBy("tier").agg(F.count("*").alias("events"))


def _stored_landing(spark: SparkSession, sf_dir: str) -> TableLog:
    log = TableLog(spark, scratch_path(spark, "expiry"))
    days = inputs.landing_events(spark, sf_dir).hint("rebalance", "event_date").sortWithinPartitions("event_date", "tenant_id")
    added = log.write(days, landing_stream.LANDED, "event_date")
    log.transact(lambda _: Change(add=[added]))
    return log


@query
def stored_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of the stored events after expiry."""
    log = _stored_landing(spark, sf_dir)
    now = expiry.expire(log, landing_stream.LANDED, schemas.LANDING, topics.RAW.retention, PROCESSING_TIME, sort=("tenant_id",))
    return log.read(now, landing_stream.LANDED, schemas.LANDING).select("event_id", "event_ts")


@query
def stored_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by the tier their day has moved to."""
    log = _stored_landing(spark, sf_dir)
    expiry.move_tiers(log, landing_stream.LANDED, schemas.LANDING, PROCESSING_TIME, sort=("tenant_id",))
    tiers = expiry.read_tiers(log, landing_stream.LANDED, schemas.LANDING)
    return tiers.groupBy("tier", "event_date").agg(F.count("*").alias("events"))


# Checks are counted while the layer is written. Its relations are built once per session and input, by the
# first report that needs them; a report builds those that it tells of and what they are made from.

_LAYERS: dict[tuple[str, str], str] = {}


def _checked(spark: SparkSession, sf_dir: str, names: Iterable[str]) -> Snapshot:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LAYERS:
        _LAYERS[key] = scratch_path(spark, "checked-layer")
    events = inputs.landing_events(spark, sf_dir)
    semantic.build_semantic_layer(spark, events, _LAYERS[key], more=_sources(spark, sf_dir), only=semantic.observing(names))
    return TableLog(spark, _LAYERS[key]).snapshot()


def _check(spark: SparkSession, sf_dir: str, check: str) -> DataFrame:
    names = semantic.checked(check)
    return graph.check_report(spark, _checked(spark, sf_dir, names), names, check)


@query
def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _check(spark, sf_dir, "not_null")


@query
def dq_not_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _check(spark, sf_dir, "not_empty")


@query
def dq_non_negative(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _check(spark, sf_dir, "non_negative")


@query
def dq_between_0_1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _check(spark, sf_dir, "between_zero_and_one")


@query
def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _check(spark, sf_dir, "unique")


@query
def dq_unique_combo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _check(spark, sf_dir, "unique_combination")


@query
def dq_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.freshness_report(spark, _checked(spark, sf_dir, quality.FRESHNESS), quality.FRESHNESS, FRESHNESS_TIME)


@query
def contract_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contracts.contract_violations(inputs.contract_topic(spark, sf_dir))


# Lifecycle questions.


@query
def event_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lifecycle.family_counts(normalized(spark, sf_dir))


@query
def audit_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lifecycle.audit_history(lifecycle_fact(spark, sf_dir))


@query
def message_state_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message at noon of each day it has events on, and a day before the first of them."""
    fact = lifecycle_fact(spark, sf_dir)
    dated = fact.where(F.col("message_id").isNotNull() & F.col("event_time").isNotNull())
    noon = F.to_date("event_time").cast("timestamp_ntz") + F.expr("interval 12 hours")
    days = dated.select("message_id", F.explode(F.array(noon, noon - F.expr("interval 1 day"))).alias("as_of"))
    return history.state_as_of(fact, days.distinct())


@query
def stage_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.stage_violations(lifecycle_fact(spark, sf_dir))


@query
def failure_tracking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lifecycle.failure_tracking(lifecycle_fact(spark, sf_dir))


@query
def provider_sla(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lifecycle.provider_sla(lifecycle.delivery_latency(lifecycle_fact(spark, sf_dir)), SLA_SECONDS)


@query
def provider_latency_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lifecycle.provider_percentiles(lifecycle.delivery_latency(lifecycle_fact(spark, sf_dir)))


@query
def backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lifecycle.backlog(lifecycle_fact(spark, sf_dir), PROCESSING_TIME)


@query
def engagement_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lifecycle.engagement_rollup(campaign_days(spark, sf_dir))


@query
def campaign_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lifecycle.campaign_trend(campaign_days(spark, sf_dir))


@query
def tenant_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lifecycle.tenant_kpis(daily(spark, sf_dir))


@query
def tenant_cohorts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lifecycle.tenant_cohorts(daily(spark, sf_dir))


@query
def date_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lifecycle.date_dimension(inputs.landing_events(spark, sf_dir))


@query
def workflow_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lifecycle.workflow_dimension(inputs.landing_events(spark, sf_dir))


@query
def tenant_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lifecycle.for_tenant(daily_metrics(spark, sf_dir), "tenant-7")


@query
def lag_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    well_formed = parsed(spark, sf_dir).where(F.col("_corrupt").isNull())
    return lifecycle.lag_events(well_formed, event_timestamp(F.col("event_time")), LAG_SECONDS)


@query
def offset_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lifecycle.offset_gaps(inputs.change_topic(spark, sf_dir))


# The same results from streams. The topic is kept as a table and read in several micro-batches.


# Records of an archive's file, which one task reads, and files of a micro-batch.
FILE_RECORDS = 50_000
BATCH_FILES = 128


def _streamed(spark: SparkSession, topic: DataFrame) -> DataFrame:
    """The topic as a stream of two batches or more; neither a file nor a batch grows with the topic."""
    path = scratch_path(spark, "archive")
    files = max(4, -(-topic.count() // FILE_RECORDS))
    topic.repartition(files, "partition", "offset").write.parquet(path)
    return topics.read_topic_table(spark, path, streaming=True, max_files=min(-(-files // 2), BATCH_FILES))


def _land_stream(spark: SparkSession, sf_dir: str) -> str:
    root = scratch_path(spark, "lake")
    records = _streamed(spark, inputs.lifecycle_topic(spark, sf_dir))
    landing_stream.start_landing(records, root, scratch_path(spark, "offsets"), once=True).awaitTermination()
    return root


@query
def stream_land_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing_stream.landing_table(spark, _land_stream(spark, sf_dir))


@query
def stream_land_two_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams, each with its own checkpoint, land half of the topic and all of it under one root."""
    root = scratch_path(spark, "lake")
    topic = inputs.lifecycle_topic(spark, sf_dir)
    for part in (F.col("partition") % 2 == 0, F.lit(True)):
        records = _streamed(spark, topic.where(part))
        offsets = scratch_path(spark, "offsets")
        landing_stream.start_landing(records, root, offsets, once=True).awaitTermination()
    return landing_stream.landing_table(spark, root)


@query
def stream_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.dead_letter_table(spark, _land_stream(spark, sf_dir)).drop("reason")


@query
def stream_dim_tenant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing_stream.refreshed_table(spark, _land_stream(spark, sf_dir), "dim_customer_tenant")


@query
def stream_dim_event_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing_stream.refreshed_table(spark, _land_stream(spark, sf_dir), "dim_customer_event_type")


@query
def stream_daily_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing_stream.refreshed_table(spark, _land_stream(spark, sf_dir), "fct_daily_customer_delivery")


def _route_stream(spark: SparkSession, sf_dir: str, topic: topics.Topic) -> DataFrame:
    root = scratch_path(spark, "routes")
    records = _streamed(spark, inputs.lifecycle_topic(spark, sf_dir))
    routers.start_lifecycle_router(
        records, root, scratch_path(spark, "offsets"), PROCESSING_TIME, once=True
    ).awaitTermination()
    return published(spark, root, topic)


@query
def stream_route_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _route_stream(spark, sf_dir, topics.CUSTOMER)


@query
def stream_route_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    health = _route_stream(spark, sf_dir, topics.HEALTH)
    return health.select(F.get_json_object("value", "$.payload.source_payload").alias("value"))


@query
def stream_internal_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both routers publish to the internal topic under one root."""
    root = scratch_path(spark, "routes")
    for start, topic in (
        (routers.start_lifecycle_router, inputs.lifecycle_topic(spark, sf_dir)),
        (routers.start_operational_router, inputs.operational_topic(spark, sf_dir)),
    ):
        offsets = scratch_path(spark, "offsets")
        start(_streamed(spark, topic), root, offsets, PROCESSING_TIME, once=True).awaitTermination()
    message_id = F.get_json_object("value", "$.message_id")
    event_id = F.get_json_object("value", "$.event_id")
    return published(spark, root, topics.INTERNAL).select(
        "key", message_id.alias("message_id"), event_id.alias("event_id")
    )


@query
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "dedup")
    events = decode.decode_envelope(_streamed(spark, inputs.lifecycle_topic(spark, sf_dir)))
    unique = routers.dedup_stream(events).select("event_id", "event_type", "event_ts")
    (
        unique.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", scratch_path(spark, "offsets"))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.parquet(path)


@query
def stream_volume_over_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "volume")
    events = decode.decode_envelope(_streamed(spark, inputs.lifecycle_topic(spark, sf_dir)))
    routers.start_volume(events, root, scratch_path(spark, "offsets"), once=True).awaitTermination()
    return routers.volume_table(spark, root).current()


@query
def stream_offset_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The topic comes in two streams that share a root; half of its offsets arrive late."""
    root = scratch_path(spark, "offset-ranges")
    topic = inputs.change_topic(spark, sf_dir)
    for late in (False, True):
        records = _streamed(spark, topic.where((F.col("offset") % 2 == 1) == late))
        routers.start_offset_tracking(records, root, scratch_path(spark, "offsets"), once=True).awaitTermination()
    return routers.current_gaps(spark, root)


@query
def stream_internal_tracking(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "tracking")
    events = decode.parse_envelopes(_streamed(spark, inputs.lifecycle_topic(spark, sf_dir)))
    records = _streamed(spark, inputs.operational_topic(spark, sf_dir))
    rows = marts.lifecycle_from_events(
        routing.normalize_lifecycle(events.where(F.col("_corrupt").isNull()))
    ).unionByName(marts.lifecycle_from_operational(operational.ops_enrich(records, PROCESSING_TIME)))
    tracking.start_tracking(rows, root, scratch_path(spark, "offsets"), once=True).awaitTermination()
    return tracking.current_states(spark, root)
