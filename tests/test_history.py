"""Message histories and offset ranges against brute force."""

import datetime as dt
import random

from letterlake import schemas
from letterlake.operators import history, lifecycle, ranges
from letterlake.operators.lifecycle import LIFECYCLE_STAGES
from letterlake.sources import topics
from letterlake.streaming import routers

START = dt.datetime(2024, 1, 1)
STAGE = {kind: stage for stage, kinds in LIFECYCLE_STAGES.items() for kind in kinds}
KINDS = [*STAGE, "mail.retry_scheduled", "mail.other", None]


def _rows(n, seed=1):
    """A third of all events on one message; many at one moment, some undated, blank or unknown."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        message = "hot" if i % 3 == 0 else rng.choice(["a", "b", "c", " ", "", None])
        at = None if rng.random() < 0.05 else START + dt.timedelta(seconds=30 * rng.randrange(40))
        arrived = None if rng.random() < 0.3 else START + dt.timedelta(seconds=rng.randrange(3))
        rows.append((f"e{i:04}", rng.choice(KINDS), "t", message, "c", "p", at, arrived, rng.choice(["sent", None]), None))
    return rows


def _course(rows):
    out = {}
    for r in rows:
        if r[3] and r[3].strip() and r[6]:
            out.setdefault(r[3], []).append(r)
    for events in out.values():
        events.sort(key=lambda r: (r[6], r[7] or dt.datetime.min, r[0]))
    return out


def test_state_as_of_against_brute_force(spark):
    rows = _rows(600)
    moments = [START + dt.timedelta(seconds=s) for s in (-1, 0, 1, 30, 59, 60, 299, 600, 5000)] + [None]
    asked = [(m, at) for m in ("hot", "a", "b", "unknown", " ", None) for at in moments] + [("a", START)]
    got = history.state_as_of(
        spark.createDataFrame(rows, schemas.FCT_MAIL_LIFECYCLE).repartition(5),
        spark.createDataFrame(asked, "message_id string, as_of timestamp_ntz"),
    ).collect()
    course, want = _course(rows), []
    for message, at in asked:
        before = [r for r in course.get(message, []) if at and r[6] <= at]
        last = before[-1] if before else (None,) * 10
        want.append((message, at, last[0], last[1], last[8], last[9], last[6]))
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_a_corrected_event_changes_the_state(spark):
    """A later event with an earlier time is placed by its time, not by its arrival."""
    rows = [
        ("e1", "mail.requested", "t", "m", "c", "p", START, START, None, None),
        ("e3", "mail.delivered", "t", "m", "c", "p", START + dt.timedelta(hours=2), START, None, None),
        ("e2", "mail.bounced", "t", "m", "c", "p", START + dt.timedelta(hours=1), START + dt.timedelta(days=9), None, "550"),
    ]
    asked = [("m", START + dt.timedelta(minutes=90)), ("m", START + dt.timedelta(hours=3))]
    got = history.state_as_of(
        spark.createDataFrame(rows, schemas.FCT_MAIL_LIFECYCLE), spark.createDataFrame(asked, "message_id string, as_of timestamp_ntz")
    )
    assert sorted((r.as_of, r.event_id, r.failure_code) for r in got.collect()) == [(asked[0][1], "e2", "550"), (asked[1][1], "e3", None)]


def test_stage_steps_against_brute_force(spark):
    rows = _rows(900, seed=2)
    got = {r.message_id: tuple(r)[1:] for r in history.stage_steps(spark.createDataFrame(rows, schemas.FCT_MAIL_LIFECYCLE).repartition(5)).collect()}
    want = {}
    for message, events in _course(rows).items():
        stages = [STAGE[r[1]] for r in events if r[1] in STAGE]
        steps = [b - a for a, b in zip(stages, stages[1:], strict=False)]
        path = list(dict.fromkeys(stages))
        counts = [sum(s == 1 for s in steps), sum(s > 1 for s in steps), sum(s == 0 for s in steps), sum(s < 0 for s in steps)]
        want[message] = (len(stages), ">".join(map(str, path)), *counts, max(stages) - len(path))
    assert got == want and "hot" in got


def test_an_orderly_message_is_no_violation(spark):
    orderly = ["mail.requested", "mail.accepted", "mail.enriched", "mail.routed", "mail.dispatched", "mail.delivered", "mail.opened", "mail.opened"]
    courses = {"fine": orderly, "hasty": orderly[:2] + orderly[4:], "back": orderly + ["mail.routed"], "short": orderly[:1]}
    rows = [
        (f"{m}{i}", kind, "t", m, "c", "p", START + dt.timedelta(minutes=17 * i), None, None, None)
        for m, kinds in courses.items()
        for i, kind in enumerate(kinds)
    ]
    got = {r.message_id: (r.skipped, r.backward, r.never_entered) for r in history.stage_violations(spark.createDataFrame(rows, schemas.FCT_MAIL_LIFECYCLE)).collect()}
    assert got == {"hasty": (1, 0, 2), "back": (0, 1, 0)}


def test_no_events(spark):
    none = spark.createDataFrame([], schemas.FCT_MAIL_LIFECYCLE)
    asked = spark.createDataFrame([("m", START)], "message_id string, as_of timestamp_ntz")
    assert [tuple(r) for r in history.state_as_of(none, asked).collect()] == [("m", START, None, None, None, None, None)]
    assert history.stage_steps(none).count() == 0


def _merged(spark, rows):
    df = spark.createDataFrame(rows, "topic string, partition int, first long, last long")
    return ranges.merge_ranges(df, ["topic", "partition"])


def test_ranges_merge_in_any_order(spark):
    rng = random.Random(3)
    block = ranges.BLOCK
    rows = []
    for _ in range(300):
        first = rng.choice([0, block, 5 * block]) + rng.randrange(-200, 400)
        rows.append(("t", rng.randrange(2), first, first + rng.choice([0, 0, 1, 5, 3 * block])))
    rows += rows[:20] + [(None, None, 1, 2)]
    whole = sorted(map(str, _merged(spark, rows).collect()))
    parts = [tuple(r) for part in (rows[::2], rows[1::2]) for r in _merged(spark, part).collect()]
    assert sorted(map(str, _merged(spark, parts).collect())) == whole
    for partition in (0, 1):
        held = sorted((a, b) for t, p, a, b in rows if p == partition)
        want = [list(held[0])]
        for a, b in held[1:]:
            if a > want[-1][1] + 1:
                want.append([a, b])
            want[-1][1] = max(want[-1][1], b)
        got = [[r.first, r.last] for r in _merged(spark, rows).where(f"partition = {partition}").orderBy("first").collect()]
        assert got == want


def test_offset_gaps_read_the_topic_once(spark, topic_of, folder):
    topic_of("a", "b").write.parquet(f"{folder}/t")
    plan = lifecycle.offset_gaps(spark.read.parquet(f"{folder}/t"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 2


def test_late_records_close_their_gap(spark, topic_of, folder):
    offsets = [0, 1, 2, 5, 6, 9, 12]
    records = topic_of(*map(str, range(13)))

    def send(wanted, root, checkpoint):
        path = f"{folder}/{checkpoint}"
        records.where(records["offset"].isin(wanted)).repartition(3).write.parquet(path)
        stream = topics.read_topic_table(spark, path, streaming=True, max_files=1)
        routers.start_offset_tracking(stream, root, f"{folder}/c-{checkpoint}", once=True, compact_every=2).awaitTermination()
        return sorted((r.first_missing, r.last_missing) for r in routers.current_gaps(spark, root).collect())

    root = f"{folder}/ranges"
    assert send(offsets, root, "one") == [(3, 4), (7, 8), (10, 11)]
    assert send([3, 4, 5, 10], root, "two") == [(7, 8), (11, 11)]
    assert send([7, 8, 11], root, "three") == []
    assert routers.offset_table(spark, root).current().count() == 1
