"""Streams give what the batch gives, also after restarts, replays and redeliveries."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from letterlake import schemas
from letterlake.operators import activity, contracts, decode, latest, upsert
from letterlake.plans import marts
from letterlake.sinks import tables
from letterlake.sinks import topics as sinks
from letterlake.sinks.commits import TableLog
from letterlake.sinks.merge import MergeTable
from letterlake.sources import topics
from letterlake.streaming import landing, routers, tracking

from .test_semantics import NOW, envelope

DAY = dt.datetime(2024, 1, 1)


def event(number, day=0, **fields):
    at = DAY + dt.timedelta(days=day, minutes=number)
    base = {
        "event_id": f"e{number}",
        "event_time": at.isoformat() + "Z",
        "ingested_at": at.isoformat() + "Z",
        "tenant_id": f"t{number % 3}",
        "message_id": f"m{number % 4}",
        "event_type": ["mail.requested", "mail.delivered", "mail.opened"][number % 3],
    }
    return envelope(**{**base, **fields})


def same(left, right):
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def recomputed(spark, root):
    events = landing.landing_table(spark, root)
    return {name: build(events) for name, build in landing.REFRESHED.items()}


def assert_refreshed(spark, root):
    for name, full in recomputed(spark, root).items():
        assert same(landing.refreshed_table(spark, root, name), full), name


def run(topic, root, checkpoint, **options):
    landing.start_landing(topic, root, checkpoint, once=True, **options).awaitTermination()


def test_landing_over_restarts_with_redeliveries(spark, topic_of, tmp_path):
    source, root, checkpoint = (str(tmp_path / name) for name in ("source", "root", "checkpoint"))
    batches = [
        topic_of(event(1), event(2), event(2), "broken", event(3, day=1)),
        topic_of(event(2), event(4), event(3, day=1), envelope(event_id=None), start=10),
        topic_of(event(5, day=-30), event(1), event(6, event_time="?"), event(6, event_time="?"), start=20),
        topic_of(event(6, event_time="?"), "broken again", start=30),
    ]
    for batch in batches:
        batch.coalesce(1).write.mode("append").parquet(source)
        # Each run is a new query on the same checkpoint: a restart.
        run(topics.read_topic_table(spark, source, streaming=True), root, checkpoint)
    events = landing.landing_table(spark, root)
    assert sorted(r.event_id for r in events.collect()) == [f"e{i}" for i in range(1, 7)]
    assert tables.dead_letter_table(spark, root).count() == 3
    assert_refreshed(spark, root)


def test_streams_and_new_checkpoints_share_a_root(spark, topic_of, tmp_path):
    root = str(tmp_path / "root")
    batches = [
        topic_of(event(1), event(2), "broken"),
        topic_of(event(2), event(3), "broken too", start=10),
        topic_of(event(3, day=1), event(4), start=20),
    ]
    for number, batch in enumerate(batches):
        source = str(tmp_path / f"source{number}")
        batch.coalesce(1).write.parquet(source)
        # Every run is batch 0 of its own checkpoint.
        run(topics.read_topic_table(spark, source, streaming=True), root, str(tmp_path / f"c{number}"))
    assert sorted(r.event_id for r in landing.landing_table(spark, root).collect()) == ["e1", "e2", "e3", "e4"]
    letters = tables.dead_letter_table(spark, root).collect()
    assert sorted(r.raw_payload for r in letters) == ["broken", "broken too"]
    assert_refreshed(spark, root)


@pytest.mark.parametrize("refresh", [False, True])
@pytest.mark.parametrize("bad_at", [0, 1, 2])
def test_a_batch_without_good_events_lands(spark, topic_of, folder, refresh, bad_at):
    for number in range(3):
        values = ["broken", "[]"] if number == bad_at else [event(number), event(number + 10)]
        landing.land_batch(topic_of(*values, start=10 * number), number, folder, refresh=refresh)
        landed = number + 1 - (bad_at <= number)
        assert landing.landing_table(spark, folder).count() == 2 * landed
        assert tables.dead_letter_table(spark, folder).count() == (2 if bad_at <= number else 0)
        if refresh:
            assert_refreshed(spark, folder)


def test_nothing_landed_yet_reads_as_empty(spark, folder):
    assert landing.landing_table(spark, f"{folder}/none").isEmpty()
    assert tables.dead_letter_table(spark, f"{folder}/none").isEmpty()
    assert landing.activity_table(spark, f"{folder}/none").current().isEmpty()


def test_landed_files_are_sorted_by_tenant(spark, topic_of, folder):
    landing.land_batch(topic_of(*[event(n) for n in range(40)]), 0, folder, refresh=False)
    rows = spark.read.parquet(f"{folder}/landing").select("tenant_id", "_metadata.file_path").collect()
    for path in {r.file_path for r in rows}:
        tenants = [r.tenant_id for r in rows if r.file_path == path]
        assert tenants == sorted(tenants)


def test_an_id_that_returns_with_another_day_lands_once(spark, topic_of, folder):
    landing.land_batch(topic_of(event(1)), 0, folder)
    landing.land_batch(topic_of(event(1, day=9)), 1, folder)
    assert landing.landing_table(spark, folder).count() == 1


def test_a_replayed_batch_changes_nothing(spark, topic_of, folder):
    landing.land_batch(topic_of(event(1), event(2)), 0, folder)
    batch = topic_of(event(2), event(3), "broken")
    for _ in range(3):
        landing.land_batch(batch, 1, folder)
        assert landing.landing_table(spark, folder).count() == 3
        assert tables.dead_letter_table(spark, folder).count() == 1
        assert_refreshed(spark, folder)


def test_a_replay_of_a_noted_batch_reads_no_record(spark, topic_of, folder, monkeypatch):
    batch = topic_of(event(1), "not json", event(2))
    landing.land_batch(batch, 3, folder)
    read = []
    monkeypatch.setattr(landing, "parse_envelopes", lambda records: read.append(records))
    for batch_id in (3, 2):
        landing.land_batch(batch, batch_id, folder)
    assert not read
    assert landing.landing_table(spark, folder).count() == 2
    assert tables.dead_letter_table(spark, folder).count() == 1
    assert_refreshed(spark, folder)


def test_compaction_keeps_the_state(spark, topic_of, folder):
    log = TableLog(spark, folder)
    for number in range(1, 13):
        landing.land_batch(topic_of(event(number), event(number + 1)), number, folder, compact_every=3)
        assert_refreshed(spark, folder)
        for table in (landing.LANDED, landing.ACTIVITY, "event_ids"):
            # At most two sets of every size class.
            assert all(len(sets) <= 6 for sets in log.snapshot().partitions(table).values())
    assert sorted(r.event_id for r in landing.landing_table(spark, folder).collect()) == sorted(f"e{n}" for n in range(1, 14))
    table = landing.activity_table(spark, folder)
    before = table.current()
    version = log.snapshot().version
    assert table.compact(3).version == version  # run again: nothing is left to merge
    assert same(before, table.current())


def test_readers_see_the_last_complete_version(spark, folder):
    path = f"{folder}/t"
    for version in (1, 2, 10):
        tables.overwrite_version(spark.range(version), path, version)
    spark.range(5).write.parquet(f"{folder}/unfinished")
    (spark._jvm.java.io.File(f"{path}/v=11")).mkdirs()
    assert tables.read_version(spark, path).count() == 10
    assert tables.read_version(spark, path, at_most=9).count() == 2
    tables.drop_versions(spark, path, keep=1)
    assert tables.versions(spark, path) == [10]


def test_routers(spark, topic_of, tmp_path):
    source, root = str(tmp_path / "source"), str(tmp_path / "root")
    values = [event(1), event(2, message_id=" "), event(3, tenant_id=None), "broken", None]
    topic_of(*values).coalesce(1).write.parquet(source)
    for _ in range(2):  # the second start finds nothing new
        records = topics.read_topic_table(spark, source, streaming=True)
        routers.start_lifecycle_router(records, root, str(tmp_path / "c"), NOW, once=True).awaitTermination()

    def published(topic):
        return [(r.key, r.value) for r in sinks.published(spark, root, topic).collect()]

    assert sorted(published(topics.INTERNAL)) == [("m1", values[0]), ("m3", values[2])]
    assert published(topics.CUSTOMER) == [("t1", values[0])]
    ((key, health),) = published(topics.HEALTH)
    assert key == "pipeline.job_failed" and json.loads(health)["message_id"] == "unknown"
    assert tables.dead_letter_table(spark, root).first().raw_payload == "broken"
    # The one thing the contract does not list is the source record, kept on purpose.
    (broken,) = contracts.contract_violations(topic_of(health)).collect()
    assert broken.violation == "extra:payload.source_payload"


def test_operational_router_feeds_both_sinks(spark, topic_of, tmp_path):
    source, root = str(tmp_path / "source"), str(tmp_path / "root")
    topic_of('{"event_id":"o","message_id":"m","status":"sent"}', "broken").coalesce(1).write.parquet(source)
    records = topics.read_topic_table(spark, source, streaming=True)
    routers.start_operational_router(records, root, str(tmp_path / "c"), NOW, once=True).awaitTermination()
    sent = [sinks.published(spark, root, t).first() for t in (topics.INTERNAL, topics.DASHBOARD)]
    assert sent[0].value == sent[1].value and sent[0].key == "m"
    document = spark.read.parquet(f"{root}/dashboard_documents").first()
    assert document.status == "sent" and document["@timestamp"] == dt.datetime(2024, 2, 1)
    assert tables.dead_letter_table(spark, root).count() == 1
    # The lifecycle router adds its records to the same topic and dead letters.
    other = str(tmp_path / "other")
    topic_of(event(1), "broken too").coalesce(1).write.parquet(other)
    records = topics.read_topic_table(spark, other, streaming=True)
    routers.start_lifecycle_router(records, root, str(tmp_path / "c2"), NOW, once=True).awaitTermination()
    assert sorted(r.key for r in sinks.published(spark, root, topics.INTERNAL).collect()) == ["m", "m1"]
    assert tables.dead_letter_table(spark, root).count() == 2


def test_text_files_as_topic(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text(event(1) + "\nbroken\n")
    batch = topics.read_topic(spark, "t", path=str(tmp_path))
    assert batch.columns == schemas.TOPIC.fieldNames()
    good, bad = decode.split_dead_letters(batch)
    assert good.count() == 1 and bad.first().kafka_topic == "t"
    stream = topics.read_topic(spark, "t", path=str(tmp_path), streaming=True, max_per_trigger=1)
    assert stream.isStreaming and stream.columns == batch.columns


def test_replaying_the_archive_as_a_batch_gives_the_same_state(spark, topic_of, tmp_path):
    source, root = str(tmp_path / "source"), str(tmp_path / "root")
    for start in range(0, 30, 10):
        values = [event(n, day=n % 2) for n in range(start, start + 12)]
        topic_of(*values, start=start).coalesce(1).write.mode("append").parquet(source)
    run(topics.read_topic_table(spark, source, streaming=True, max_files=1), root, str(tmp_path / "c"))
    replayed = str(tmp_path / "replayed")
    landing.land_batch(topics.read_topic_table(spark, source), 0, replayed)
    assert same(landing.landing_table(spark, root), landing.landing_table(spark, replayed))


def lifecycle_row(number, minute, status, day=1, message=None):
    at = dt.datetime(2024, 1, day, 0, minute)
    message = message or f"m{number % 2}"
    return (f"e{number}", "mail.opened", "t", message, "c", None, at, at, status, None)


def test_tracking_merges_batches_in_any_order(spark, folder):
    rows = [lifecycle_row(n, (n * 7) % 50, f"s{n}") for n in range(12)]
    full = spark.createDataFrame(rows, schemas.FCT_MAIL_LIFECYCLE)
    table = tracking.tracking_table(spark, folder)
    for batch_id, part in enumerate((rows[6:], rows[:3], rows[3:6])):
        for _ in range(2):
            table.add(spark.createDataFrame(part, schemas.FCT_MAIL_LIFECYCLE), batch_id)
    assert same(tracking.current_states(spark, folder), latest.latest_per_message(full))
    table.compact(1)
    assert same(tracking.current_states(spark, folder), latest.latest_per_message(full))


def test_a_corrected_redelivery_replaces_the_event_before_messages_are_ranked(spark, folder):
    at = [dt.datetime(2024, 1, 1, hour) for hour in range(6)]

    def row(event_id, event_time, ingested_at, status):
        return (event_id, "mail.opened", "t", "m", "c", None, event_time, ingested_at, status, None)

    # e1 is corrected to an earlier time, so e2 is the message's latest event.
    rows = [row("e1", at[3], at[3], "delivered"), row("e2", at[2], at[3], "opened"), row("e1", at[1], at[4], "x")]
    frames = [spark.createDataFrame([one_row], schemas.FCT_MAIL_LIFECYCLE) for one_row in rows]
    fact = marts.fct_mail_lifecycle(frames[0].unionByName(frames[1]), frames[2])
    table = tracking.tracking_table(spark, folder)
    for batch_id, frame in enumerate(frames):
        table.add(frame, batch_id)
    for states in (latest.latest_per_message(fact), tracking.current_states(spark, folder)):
        assert [r.latest_status for r in states.collect()] == ["opened"]


def test_merge_table_of_two_writers(spark, folder):
    schema = schemas.T.StructType().add("k", "string").add("n", "long")
    table = MergeTable(spark, folder, lambda rows: rows.groupBy("k").agg(F.sum("n").alias("n")), schema)
    for batch_id in range(4):
        for writer in ("x", "y"):
            table.add(spark.createDataFrame([("a", 1), ("b", batch_id)], schema), batch_id, writer)
    want = {("a", 8), ("b", 12)}
    assert {tuple(r) for r in table.current().collect()} == want
    for up_to in (0, 2, 3):
        table.compact(up_to, "x")
        assert {tuple(r) for r in table.current().collect()} == want
    table.compact(1, "y")
    assert {tuple(r) for r in table.current().collect()} == want


def upserted(spark, path, rows):
    batch = spark.createDataFrame(rows, schemas.FCT_MAIL_LIFECYCLE).withColumn(
        "event_date", F.to_date("event_time")
    )
    upsert.upsert_table(spark, path, batch, "event_id", "event_date", upsert.newest_first())
    return {(r.event_id, r.latest_status, r.event_date.day) for r in upsert.stored_table(spark, path).collect()}


def test_upsert_moves_rows_between_partitions(spark, folder):
    path = f"{folder}/fact"
    first = [lifecycle_row(1, 0, "a", day=1), lifecycle_row(2, 0, "a", day=2), lifecycle_row(3, 0, "a", day=2)]
    assert upserted(spark, path, first) == {("e1", "a", 1), ("e2", "a", 2), ("e3", "a", 2)}
    # e1 leaves day 1 empty; e2 stays; e4 is new; of two rows for e4 the newer counts.
    second = [
        lifecycle_row(1, 5, "b", day=3),
        lifecycle_row(2, 5, "b", day=2),
        lifecycle_row(4, 5, "old", day=4),
        lifecycle_row(4, 6, "new", day=4),
    ]
    want = {("e1", "b", 3), ("e2", "b", 2), ("e3", "a", 2), ("e4", "new", 4)}
    for _ in range(2):
        assert upserted(spark, path, second) == want


def test_dedup_and_volume_streams(spark, topic_of, tmp_path):
    source = str(tmp_path / "source")
    values = [event(1), event(2), event(1), event(70), event(3, event_time=None)]
    topic_of(*values).coalesce(1).write.parquet(source)

    def events():
        return decode.decode_envelope(topics.read_topic_table(spark, source, streaming=True))

    def collect(df, mode, name):
        query = (
            df.writeStream.format("memory").queryName(name).outputMode(mode)
            .option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        )
        query.awaitTermination()
        return spark.table(name).collect()

    # Later batches bring an event far behind the others and one without a time.
    late = topic_of(event(4, day=-90), event(70), event(5, event_time=None), start=10)
    late.coalesce(1).write.mode("append").parquet(source)
    unique = collect(routers.dedup_stream(events()), "append", "unique_events")
    assert sorted(r.event_id for r in unique) == ["e1", "e2", "e3", "e4", "e5", "e70"]
    root = str(tmp_path / "volume")
    routers.start_volume(events(), root, str(tmp_path / "c"), once=True).awaitTermination()
    counts = routers.volume_table(spark, root).current().collect()
    assert sorted(r.events for r in counts) == [1, 2, 3]


def test_rollup_gives_what_the_events_give(spark, topic_of):
    records = topic_of(*[event(n, day=n % 3) for n in range(40)])
    events = decode.utc_wall_clock(decode.decode_envelope(records))
    rollup = activity.activity_rollup(events, landing.ACTIVITY_KEYS)
    for build in landing.REFRESHED.values():
        assert same(build(events), build(rollup))


def test_key_order_splits_a_hot_key(spark):
    from letterlake.sinks.topics import in_key_order

    rows = spark.range(2000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("key"),
        F.col("id").alias("offset"),
    )
    ordered = in_key_order(rows, topics.RAW, "offset").withColumn("task", F.spark_partition_id())
    got = [(r.key, r.offset) for r in ordered.collect()]
    assert got == sorted(got) and len(got) == 2000
    assert ordered.where("key = 'hot'").select("task").distinct().count() > 1


def test_broadcast_only_below_the_bound(spark):
    from letterlake.functions.sizes import broadcast_if_small

    keys = spark.range(100).select(F.col("id").cast("string").alias("k"))

    def hinted(df):
        return "strategy=broadcast" in spark.range(1).select(F.lit("1").alias("k")).join(
            df, "k"
        )._jdf.queryExecution().analyzed().toString()

    assert hinted(broadcast_if_small(keys))
    assert not hinted(broadcast_if_small(keys, limit=100))
    assert hinted(broadcast_if_small(keys.where("false")))


def test_producers_and_normalizer_chain(spark, topic_of, tmp_path):
    """Changes become raw events, raw events normalised ones and their projections."""
    from .test_semantics import change, images

    root = str(tmp_path / "root")
    topic_of(change(), "broken").coalesce(1).write.parquet(str(tmp_path / "changes"))
    topic_of(images({"message_id": {"S": "m"}})).coalesce(1).write.parquet(str(tmp_path / "items"))
    changes = topics.read_topic_table(spark, str(tmp_path / "changes"), streaming=True)
    items = topics.read_topic_table(spark, str(tmp_path / "items"), streaming=True)
    routers.start_change_producer(changes, root, str(tmp_path / "c1"), NOW, once=True).awaitTermination()
    routers.start_attribute_producer(items, root, str(tmp_path / "c2"), NOW, once=True).awaitTermination()

    def published(topic):
        return [(r.key, json.loads(r.value)) for r in sinks.published(spark, root, topic).collect()]

    reasons = [r.reason for r in tables.dead_letter_table(spark, root).collect()]
    assert reasons == ["not_json_object"]
    ((key, raw),) = published(topics.RAW)
    assert key == "m" and raw["event_type"] == "mail.requested" and raw["correlation_id"] == "x"
    ((key, operational),) = published(topics.OPERATIONAL)
    assert key == "m" and operational["status"] == "unknown"

    topic_of(json.dumps(raw), event(1, message_id=None)).coalesce(1).write.parquet(str(tmp_path / "raw"))
    records = topics.read_topic_table(spark, str(tmp_path / "raw"), streaming=True)
    routers.start_normalizer(records, root, str(tmp_path / "c3"), once=True).awaitTermination()
    reasons = [r.reason for r in tables.dead_letter_table(spark, root).collect()]
    assert sorted(reasons) == ["missing_identifier", "not_json_object"]
    ((key, normalized),) = published(topics.NORMALIZED)
    assert key == "m" and normalized["event_id"] == raw["event_id"]
    ((key, customer),) = published(topics.CUSTOMER)
    assert key == "t" and set(customer) == {"tenant_id", "message_id", "event_type", "event_time", "payload"}
    assert "correlation_id" in published(topics.INTERNAL)[0][1]


def test_upsert_keeps_undated_rows_undated(spark, folder):
    def fact(*rows):
        return spark.createDataFrame(list(rows), schemas.FCT_MAIL_LIFECYCLE).withColumn(
            "event_date", F.to_date("event_time")
        )

    undated = lifecycle_row(1, 0, "a")[:6] + (None,) + lifecycle_row(1, 0, "a")[7:]
    path, order = f"{folder}/fact", upsert.newest_first()
    upsert.upsert_table(spark, path, fact(undated, lifecycle_row(2, 0, "a")), "event_id", "event_date", order)
    assert {(r.event_id, r.event_date is None) for r in upsert.stored_table(spark, path).collect()} == {("e1", True), ("e2", False)}
    # The event's time becomes known: its row leaves the undated partition.
    upsert.upsert_table(spark, path, fact(lifecycle_row(1, 5, "b")), "event_id", "event_date", order)
    assert {(r.event_id, r.event_date is None) for r in upsert.stored_table(spark, path).collect()} == {("e1", False), ("e2", False)}
