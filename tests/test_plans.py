"""What the physical plans must and must not hold."""

import pytest
from pyspark.sql import functions as F

from letterlake.catalog import inputs, queries
from letterlake.operators import activity, decode, dynamodb, latest, retention, staging
from letterlake.plans import marts
from letterlake.sinks.tables import write_events

from .conftest import SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


PLANNED = [
    name
    for name in queries.QUERIES
    if not name.startswith(("stream_", "layer_")) and name not in ("land_events", "upsert_table", "src_topic_text")
]


@pytest.mark.parametrize("name", PLANNED)
def test_no_python_and_no_nested_loop(spark, name):
    text = plan(queries.QUERIES[name](spark, SMALL))
    for operator in ("Python", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in text, operator


def test_each_record_is_parsed_once(spark):
    text = plan(decode.decode_envelope(inputs.lifecycle_topic(spark, SMALL)))
    assert text.count("from_json(") == 1
    staged = staging.stage_events(inputs.landing_events(spark, SMALL)).where("campaign_id is not null")
    assert plan(staged).count("parseJson") == 1


def test_an_image_is_read_in_one_walk(spark):
    images = dynamodb.new_images(dynamodb.stream_records(inputs.attribute_topic(spark, SMALL)))
    before = optimized(images).count("try_variant_get(")
    read = optimized(dynamodb.unmarshal(images, dynamodb.ITEM)).count("try_variant_get(") - before
    # The tags of all attributes, and each one as a whole for unknown tags.
    assert read <= len(dynamodb.ITEM) + 1


def test_latest_row_is_limited_before_the_shuffle(spark):
    text = plan(latest.latest_per_message(queries.lifecycle_rows(spark, SMALL)))
    before_shuffle = text[text.index("Exchange hashpartitioning(message_id") :]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_counts_are_combined_before_the_shuffle(spark):
    text = plan(activity.daily_delivery_fact(inputs.landing_events(spark, SMALL)))
    assert text.index("partial_sum") > text.index("Exchange hashpartitioning")
    assert "ReadSchema: struct<event_type:string,tenant_id:string,event_date:date>" in text


def test_retention_reaches_the_scan(spark):
    kept = retention.apply_retention(inputs.landing_events(spark, SMALL), "event_ts", "7d", inputs.PROCESSING_TIME)
    assert "GreaterThanOrEqual(event_ts" in plan(kept.select("event_id"))


def test_landing_layout_prunes_days(spark, folder):
    path = f"{folder}/landing"
    write_events(inputs.landing_events(spark, SMALL), path)
    one_day = spark.read.parquet(path).where(F.col("event_date") == "2024-01-05").select("tenant_id")
    assert "PartitionFilters: [isnotnull(event_date" in plan(one_day)
    assert one_day.inputFiles() and one_day.count() > 0


def test_no_forced_broadcast_of_growing_dimensions(spark):
    tenants = activity.tenant_dimension(inputs.landing_events(spark, SMALL))
    fact = activity.daily_delivery_fact(inputs.landing_events(spark, SMALL))
    assert "strategy=broadcast" not in optimized(marts.delivery_daily_metrics(fact, tenants))
