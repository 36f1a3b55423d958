"""Work is cut by the number of records, whatever the files and row groups they come in."""

import glob

import pytest
from pyspark.sql import functions as F

from letterlake.catalog import inputs, queries
from letterlake.operators.contracts import contract_violations
from letterlake.session import RECORD_SETTINGS

from .conftest import SMALL

# A path of its own, so that no input stored before is taken.
ALONE = f"{SMALL}/."


@pytest.mark.parametrize("build", [inputs.contract_topic, inputs.change_topic])
def test_an_input_has_as_many_files_as_its_rows_need(spark, monkeypatch, build):
    monkeypatch.setattr(inputs, "TASK_ROWS", 50)
    stored = build(spark, ALONE)
    inputs._STORED.pop((spark.sparkContext.applicationId, ALONE, build.__name__))
    files = stored.inputFiles()
    assert len(files) >= 15
    rows = stored.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert rows < 150


def test_a_query_sets_splits_and_method_length(spark):
    for key in RECORD_SETTINGS:
        spark.conf.unset(key)
    queries.QUERIES["contract_violations"](spark, SMALL)
    assert {key: spark.conf.get(key) for key in RECORD_SETTINGS} == RECORD_SETTINGS


def test_lower_case_marks_of_a_date_time(topic_of):
    record = """{"event_id":"e","event_type":"x","event_version":"1.0.0","event_time":"%s","ingested_at":"%s",
        "source_system":"s","message_id":"m","correlation_id":"c","payload":{}}"""
    topic = topic_of(record % ("2024-01-01t00:00:00z", "2024-02-30T00:00:00Z"), record % ("2024-01-01 00:00:00+01:00", "1704067200000"))
    found = {(row.offset, row.violation) for row in contract_violations(topic).collect()}
    assert found == {(0, "format:ingested_at"), (1, "format:ingested_at")}


def test_a_stream_has_bounded_files_and_batches(spark, monkeypatch):
    monkeypatch.setattr(queries, "FILE_RECORDS", 100)
    monkeypatch.setattr(queries, "BATCH_FILES", 3)
    read, seen = queries.topics.read_topic_table, {}

    def noting(session, path, **given):
        seen.update(given, path=path)
        return read(session, path, **given)

    monkeypatch.setattr(queries.topics, "read_topic_table", noting)
    landed = queries.QUERIES["stream_land_events"](spark, SMALL)
    assert len(glob.glob(f"{seen['path']}/*.parquet")) > 8
    assert seen["max_files"] == 3
    assert landed.exceptAll(queries.QUERIES["land_events"](spark, SMALL)).isEmpty()
    assert landed.count() == queries.QUERIES["land_events"](spark, SMALL).count()


def test_the_upserts_parse_their_records_once(spark):
    text = queries.QUERIES["incremental_upsert"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "from_json(" not in text and "parse_json" not in text.lower()
