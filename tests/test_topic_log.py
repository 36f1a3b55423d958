"""Topics with offsets, expiry of stored tables, and the index of dead letters."""

import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from letterlake import schemas
from letterlake.operators import decode, retention
from letterlake.sinks import expiry, letter_index, tables
from letterlake.sinks.commits import Change, TableLog
from letterlake.sinks.topic_log import STAGED, TopicLog
from letterlake.sinks.topics import publish, published
from letterlake.sources.topics import Topic
from letterlake.streaming import landing

from .test_streams import event

TOPIC = Topic("letters", 3, "7d", "message_id")


def pairs_of(spark, rows):
    return spark.createDataFrame(rows, "key string, value string")


def gapless(log):
    """(partition, key, value) by offset, after checking that the offsets are those of a log."""
    rows = sorted(log.read().collect(), key=lambda r: (r.partition, r.offset))
    ends = {}
    for row in rows:
        assert row.offset == ends.get(row.partition, 0)
        ends[row.partition] = row.offset + 1
    assert log.ends() == ends
    return [(r.partition, r.key, r.value) for r in rows]


def test_offsets_are_unique_and_gapless_over_writers_and_replays(spark, folder):
    log = TopicLog(spark, folder, TOPIC)
    first = pairs_of(spark, [(f"k{i % 7}", f"v{i:03}") for i in range(200)]).repartition(8)
    # One key holds most records, some have no key, some are equal, one has neither key nor value.
    second = pairs_of(spark, [("k1", f"w{i % 90:03}") for i in range(300)] + [(None, f"w{i}") for i in range(50)] + [(None, None), ("", "")])
    log.append(first, 0, writer="a")
    log.append(second, 0, writer="b")
    log.append(first, 0, writer="a")
    rows = gapless(log)
    assert len(rows) == 200 + 352
    # A key has one partition, and its records follow one another in each batch.
    assert len({(p, k) for p, k, _ in rows if k}) == 7
    assert [v for _, k, v in rows if k == "k1"] == [f"v{i:03}" for i in range(1, 200, 7)] + sorted(f"w{i % 90:03}" for i in range(300))
    # Staged files are gone.
    assert not [s for s in log.log._list(f"{folder}/{STAGED}")]


def test_an_order_within_a_key(spark, folder):
    log = TopicLog(spark, folder, TOPIC)
    rows = spark.createDataFrame([("k", f"v{9 - i}", i) for i in range(10)], "key string, value string, at int")
    log.append(rows, 0, "at")
    assert [v for _, _, v in gapless(log)] == [f"v{9 - i}" for i in range(10)]


def test_an_empty_batch_is_noted(spark, folder):
    log = TopicLog(spark, folder, TOPIC)
    assert log.read().count() == 0 and log.ends() == {}
    log.append(pairs_of(spark, []), 3)
    log.append(pairs_of(spark, [("k", "late")]), 3)
    assert gapless(log) == []
    log.append(pairs_of(spark, [("k", "next")]), 4)
    assert [v for _, _, v in gapless(log)] == ["next"]


def test_racing_writers_share_the_offsets(spark, folder):
    def write(writer):
        own = TopicLog(spark, folder, TOPIC)
        for batch in range(2):
            own.append(pairs_of(spark, [(f"k{i}", f"{writer}-{batch}-{i}") for i in range(20)]), batch, writer=writer)

    threads = [threading.Thread(target=write, args=(name,)) for name in "abc"]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert len({v for _, _, v in gapless(TopicLog(spark, folder, TOPIC))}) == 120


def test_reading_on_from_an_offset_visits_its_partitions_only(spark, folder):
    log = TopicLog(spark, folder, TOPIC)
    log.append(pairs_of(spark, [(f"k{i}", f"v{i}") for i in range(60)]), 0)
    everything = log.read().collect()
    rows = log.read({1: 5, 2: 0})
    assert sorted((r.partition, r.offset) for r in rows.collect()) == sorted(
        (r.partition, r.offset) for r in everything if (r.partition == 1 and r.offset >= 5) or r.partition == 2
    )
    assert not any("partition=0/" in file for file in rows.inputFiles())
    assert log.read({}).count() == 0


def test_old_records_expire_and_offsets_go_on(spark, folder):
    log = TopicLog(spark, folder, TOPIC)
    day = dt.datetime(2024, 1, 1)
    for number in range(4):
        log.append(pairs_of(spark, [("k", f"v{number}")]), number, now=day + dt.timedelta(days=3 * number))
    log.expire(day + dt.timedelta(days=11))
    assert [(r.offset, r.value) for r in log.read().orderBy("offset").collect()] == [(2, "v2"), (3, "v3")]
    version = log.log.snapshot().version
    assert log.expire(day + dt.timedelta(days=11)).version == version
    log.append(pairs_of(spark, [("k", "v4")]), 4)
    assert log.read().agg(F.max("offset")).first()[0] == 4


def test_compacted_batches_keep_their_records_and_expire_together(spark, folder):
    log = TopicLog(spark, folder, TOPIC)
    day = dt.datetime(2024, 1, 1)
    for number in range(5):
        log.append(pairs_of(spark, [(f"k{i}", f"v{number}-{i}") for i in range(9)]), number, now=day + dt.timedelta(hours=number if number < 4 else 30))
    before = gapless(log)
    snapshot = log.compact(fan=2)
    assert gapless(log) == before and len(snapshot.sets(TOPIC.name)) < 5
    log.expire(day + dt.timedelta(days=7, hours=1))
    assert log.read().count() == 45
    log.expire(day + dt.timedelta(days=7, hours=4))
    assert {r.value[:2] for r in log.read().collect()} == {"v4"}


def test_publishing_to_a_folder_numbers_the_records(spark, folder):
    for _ in range(2):
        publish(pairs_of(spark, [("a", "1"), ("b", "2")]), TOPIC, 0, root=folder)
    assert sorted(map(tuple, published(spark, folder, TOPIC).collect())) == [("a", "1"), ("b", "2")]


# Expiry.

EVENT = schemas.T.StructType().add("event_id", "integer").add("event_ts", "timestamp_ntz").add("event_date", "date")
NOW = "2024-02-01 12:00:00"


def stored_events(spark, folder):
    log = TableLog(spark, folder)
    noon = dt.datetime(2024, 2, 1, 12)
    times = [None, *[noon - dt.timedelta(hours=6 * i) for i in range(170)]]
    rows = spark.createDataFrame([(i, t, t and t.date()) for i, t in enumerate(times)], EVENT).coalesce(1)
    added = log.write(rows, "events", "event_date")
    log.transact(lambda _: Change(add=[added]))
    return log, rows


def ids(rows):
    return sorted(r.event_id for r in rows.collect())


def files_of(log, snapshot):
    return set(log.read(snapshot, "events", EVENT).inputFiles())


@pytest.mark.parametrize("keep", ["7d", "12h", "6h", "400d"])
def test_stored_rows_expire_as_the_filter_says(spark, folder, keep):
    log, rows = stored_events(spark, folder)
    before = log.snapshot()
    after = expiry.expire(log, "events", EVENT, keep, NOW)
    assert ids(log.read(after, "events", EVENT)) == ids(retention.apply_retention(rows, "event_ts", keep, NOW))
    # Files of other days keep their names, and the older version can still be read.
    border = (dt.datetime.fromisoformat(NOW) - retention.duration(keep)).date()
    assert not [f for f in files_of(log, after) - files_of(log, before) if f"event_date={border}" not in f]
    assert ids(log.read(before, "events", EVENT)) == ids(rows)
    assert expiry.expire(log, "events", EVENT, keep, NOW).version == after.version


def test_days_move_through_the_tiers(spark, folder):
    log, rows = stored_events(spark, folder)
    for now in ("2024-01-20 00:00:00", NOW, NOW):
        expiry.move_tiers(log, "events", EVENT, now)
    found = expiry.read_tiers(log, "events", EVENT).persist()
    assert ids(found) == ids(rows)
    spans = {r.tier: (r.first, r.last) for r in found.groupBy("tier").agg(F.min("event_date").alias("first"), F.max("event_date").alias("last")).collect()}
    assert spans["hot"][0] == dt.date(2024, 1, 25) and spans["warm"] == (dt.date(2024, 1, 2), dt.date(2024, 1, 24))
    assert spans["cold"][1] == dt.date(2024, 1, 1)
    found.unpersist()


# The index of dead letters.

LETTERS = ["Record_1 is broken", "record_10 is broken", "is broken record_1 is broken twice", "{'a': 'x.y is'}", "", "broken is", "x.y", "İs broken", "broken broken broken"]
PHRASES = ["is broken", "IS BROKEN", "record_1", "record_10 is", "broken is", "x.y is", "broken broken", "is broken record_1 is", "", "...", "nowhere", "broken broken broken broken"]


def test_the_index_finds_what_a_scan_finds(spark, folder, topic_of):
    landing.land_batch(topic_of(*LETTERS, event(1), None), 0, folder, refresh=False)
    landing.land_batch(topic_of("is broken", LETTERS[0], start=50), 1, folder, refresh=False, compact_every=2)
    landing.land_batch(topic_of("is broken", LETTERS[0], start=50), 1, folder, refresh=False)
    landing.land_batch(topic_of("is broken", "is broken", start=90), 0, folder, writer="other", refresh=False)
    letters = tables.dead_letter_table(spark, folder)
    for phrase in PHRASES:
        want = sorted(map(str, decode.search_dead_letters(letters, phrase).collect()))
        assert sorted(map(str, letter_index.search(spark, folder, phrase).collect())) == want, phrase


def test_a_search_reads_the_phrases_buckets_only(spark, folder, topic_of):
    landing.land_batch(topic_of(*[f"token{i} other{i}" for i in range(200)]), 0, folder, refresh=False)
    log = TableLog(spark, folder)
    assert len(log.snapshot().partitions(letter_index.TABLE)) > 30
    found = letter_index.holders(log, "token7 other7")
    assert found.count() == 1
    assert 1 <= len({file.split("bucket=")[1].split("/")[0] for file in found.inputFiles()}) <= 2
    assert "dead_letters/" not in found._jdf.queryExecution().toString()


def test_nothing_is_found_where_nothing_landed(spark, folder):
    assert letter_index.search(spark, folder, "is broken").count() == 0
