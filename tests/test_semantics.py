"""Small inputs for each rule about missing, blank, malformed and repeated data."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from letterlake import schemas
from letterlake.functions.clock import duration, event_timestamp
from letterlake.functions.rates import rate
from letterlake.functions.text import is_blank
from letterlake.operators import (
    activity,
    cdc,
    contracts,
    dashboards,
    decode,
    dynamodb,
    latest,
    lifecycle,
    operational,
    quality,
    ranges,
    retention,
    routing,
    staging,
)
from letterlake.plans import marts, semantic

NOW = "2024-02-01 00:00:00"


def envelope(**fields):
    base = {
        "event_id": "e1",
        "event_type": "mail.delivered",
        "event_version": "1.0.0",
        "event_time": "2024-01-02T03:04:05Z",
        "ingested_at": "2024-01-02T03:04:06Z",
        "source_system": "s",
        "tenant_id": "t1",
        "message_id": "m1",
        "correlation_id": "c1",
        "payload": {},
    }
    return json.dumps({**base, **fields})


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


# Values.


@pytest.mark.parametrize(
    "text, blank",
    [(None, True), ("", True), ("  ", True), ("\t\n", True), (" ", True), (" ", False), ("a ", False)],
)
def test_blank_is_whitespace_of_any_script(spark, text, blank):
    df = spark.createDataFrame([(text,)], "x string")
    assert one(df.select(is_blank(F.col("x"))))[0] is blank


@pytest.mark.parametrize(
    "text, expected",
    [
        ("1704164645000", dt.datetime(2024, 1, 2, 3, 4, 5)),
        ("2024-01-02T03:04:05Z", dt.datetime(2024, 1, 2, 3, 4, 5)),
        ("2024-01-02T05:04:05+02:00", dt.datetime(2024, 1, 2, 3, 4, 5)),
        ("2024-01-02 03:04:05", dt.datetime(2024, 1, 2, 3, 4, 5)),
        ("03:04:05", None),
        ("99999999999999999999", None),
        ("soon", None),
        ("", None),
        (None, None),
    ],
)
def test_event_time_from_millis_or_text(spark, text, expected):
    df = spark.createDataFrame([(text,)], "x string")
    assert one(df.select(event_timestamp(F.col("x")).cast("timestamp_ntz")))[0] == expected


@pytest.mark.parametrize("text", ["100000000000000", "1700000000000000", "-9223372036854775", "9223372036854775", "9223372036854776"])
def test_event_time_of_any_length_a_timestamp_holds(spark, text):
    df = spark.createDataFrame([(text,)], "x string")
    held = abs(int(text)) <= 9223372036854775
    assert one(df.select(F.unix_millis(event_timestamp(F.col("x")))))[0] == (int(text) if held else None)


def test_rate_of_zero_and_null(spark):
    df = spark.createDataFrame([(3, 2), (3, 0), (3, None)], "a long, b long")
    assert [r[0] for r in df.select(rate("a", "b")).collect()] == [1.5, 0.0, None]


def test_duration():
    assert duration("7d") == dt.timedelta(days=7)
    with pytest.raises(ValueError):
        duration("7 weeks")


# Decoding.


def test_payload_under_either_name(spark, topic_of):
    rows = decode.decode_envelope(
        topic_of(
            envelope(event_id="a", payload={"k": 1}),
            envelope(event_id="b", payload=None, payload_json='{"k":2}'),
        )
    )
    assert {r.event_id: r.payload for r in rows.collect()} == {"a": '{"k":1}', "b": '{"k":2}'}


def test_every_record_lands_or_is_a_dead_letter(spark, topic_of):
    topic = topic_of(
        envelope(event_id="good", event_time=1704164645000),
        "MALFORMED_NON_JSON_1",
        '{"event_id":"x",',
        "[1,2]",
        '"text"',
        envelope(event_id=None),
        None,
    )
    good, bad = decode.split_dead_letters(topic)
    row = one(good)
    assert (row.event_id, row.event_date) == ("good", dt.date(2024, 1, 2))
    reasons = [r.reason for r in bad.orderBy("kafka_offset").collect()]
    assert reasons == ["not_json_object"] * 4 + ["missing_event_id"]
    assert decode.search_dead_letters(bad, "malformed_non_json_1").count() == 1
    assert decode.search_dead_letters(bad, "MALFORMED_non_json").count() == 0
    assert decode.search_dead_letters(bad, "event_id: x").count() == 1
    assert decode.search_dead_letters(bad, "?").count() == 0


def test_bad_time_does_not_fail(spark, topic_of):
    row = one(decode.decode_envelope(topic_of(envelope(event_time="yesterday"))))
    assert row.event_ts is None and row.event_date is None


def test_redaction(spark, topic_of):
    bad = decode.dead_letters(decode.parse_envelopes(topic_of('{"recipient": "a@b.c", "x": "y"')))
    assert one(decode.redact(bad, ("recipient",))).raw_payload == '{"recipient": "***", "x": "y"'


@pytest.mark.parametrize(
    ("text", "masked"),
    [
        (r'{"recipient": "a\"SECRET", "x": 1', r'{"recipient": "***", "x": 1'),
        (r'{"recipient": "a\\", "x": "y"', r'{"recipient": "***", "x": "y"'),
        ('{"recipient": 4711, "x": 1', '{"recipient": ***, "x": 1'),
        ("{'recipient': 'SECRET', 'x': 'y'", "{'recipient': '***', 'x': 'y'"),
        (r'{"p": "{\"recipient\":\"S\\\"ECRET\",\"x\":\"y\"}"', r'{"p": "{\"recipient\":\"***\",\"x\":\"y\"}"'),
        (r'{"p": "{\"recipient\":4711,\"x\":1}"', r'{"p": "{\"recipient\":***,\"x\":1}"'),
        ('{"recipient": "SECRET', '{"recipient": "***'),
        ('{"recipient": {"recipient": true', '{"recipient": {"recipient": ***'),
        ('{"other": "recipient"', '{"other": "recipient"'),
    ],
)
def test_redaction_of_every_kind_of_value(spark, topic_of, text, masked):
    bad = decode.dead_letters(decode.parse_envelopes(topic_of(text)))
    assert one(decode.redact(bad, ("recipient",))).raw_payload == masked


def test_redaction_of_very_long_values(spark, topic_of):
    text = '{"recipient": "' + r"\"a" * 100_000 + '", "x": 1'
    bad = decode.dead_letters(decode.parse_envelopes(topic_of(text)))
    assert one(decode.redact(bad, ("recipient",))).raw_payload == '{"recipient": "***", "x": 1'


# Routing.


def routes_of(topic):
    routed = routing.with_routes(decode.parse_envelopes(topic))
    return {r.offset: sorted(r.routes) for r in routed.collect()}


def test_routes(spark, topic_of):
    topic = topic_of(
        envelope(),
        envelope(event_type="MAIL.DELIVERED"),
        envelope(tenant_id="  "),
        envelope(tenant_id=None),
        envelope(message_id=" \t"),
        envelope(message_id=None),
        envelope(event_type=None),
        envelope(event_id=None),
        "broken",
    )
    assert routes_of(topic) == {
        0: ["customer", "internal"],
        1: ["internal"],
        2: ["internal"],
        3: ["internal"],
        4: ["health"],
        5: ["health"],
        6: ["internal"],
        7: ["customer", "internal"],
    }


def test_normalising_needs_three_ids_and_lowers_the_type(spark, topic_of):
    parsed = decode.parse_envelopes(
        topic_of(
            envelope(event_type="MAIL.Opened"),
            envelope(event_id=None),
            envelope(message_id=None),
            envelope(correlation_id=None),
            envelope(event_id="blank", message_id=""),
        )
    )
    rows = routing.normalize_lifecycle(parsed)
    assert {r.event_id: r.event_type for r in rows.collect()} == {
        "e1": "mail.opened",
        "blank": "mail.delivered",
    }


def test_health_event_is_a_full_envelope_and_repeatable(spark, topic_of):
    source = envelope(message_id="", correlation_id=None)
    routed = routing.with_routes(decode.parse_envelopes(topic_of(source)))
    first, second = (one(routing.health_events(routed, NOW)) for _ in range(2))
    assert first == second
    assert tuple(first.asDict()) == schemas.ENVELOPE_FIELDS
    assert first.correlation_id == first.event_id
    payload = json.loads(first.payload)
    assert payload["failure_reason"] == "missing_message_id"
    assert payload["source_payload"] == source


# Change records.


def change(**payload):
    base = {"op": "c", "ts_ms": 5, "source": {"db": "d", "table": "t", "txId": "x"}, "before": None}
    return json.dumps({"payload": {**base, "after": {"message_id": "m", "tenant_id": "t"}, **payload}})


def test_change_records(spark, topic_of):
    topic = topic_of(
        change(),
        change(op="r"),
        change(op="u"),
        change(op="d", after=None, before={"message_id": "old"}),
        change(op="x"),
        json.dumps({"payload": {"after": {"message_id": " ", "tenant_id": ""}}}),
        json.dumps({"payload": None}),
        change(after=None),
        "broken",
    )
    rows = cdc.cdc_to_canonical(topic, NOW).collect()
    assert [r.event_type for r in rows] == [
        "mail.requested",
        "mail.requested",
        "mail.updated",
        "mail.deleted",
        "mail.unknown",
        "mail.updated",
    ]
    assert rows[3].message_id == "old"
    bare = rows[5]
    assert bare.source_system == "postgres.unknown"
    assert bare.tenant_id is None and bare.message_id.startswith("gen-")
    assert bare.correlation_id == bare.message_id
    assert bare.event_time == "1706745600000"
    assert len({r.event_id for r in rows}) == 6


def test_redelivered_change_gives_the_same_event(spark, topic_of):
    topic = topic_of(change())
    assert cdc.cdc_to_canonical(topic, NOW).collect() == cdc.cdc_to_canonical(topic, NOW).collect()


# Attribute images.


def images(*items):
    return json.dumps({"Records": [{"dynamodb": {"NewImage": item}} for item in items]})


def test_attribute_images(spark, topic_of):
    topic = topic_of(
        images(
            {"mail_id": {"S": "a"}, "message_id": {"S": ""}, "status": {"NULL": True}},
            {"message_id": {"N": "-5"}, "status": {"BOOL": True}, "provider": {"X": 1}},
            {},
        ),
        json.dumps({"Records": [{"dynamodb": {"Keys": {}}}, {}]}),
        json.dumps({"Other": 1}),
    )
    rows = dynamodb.ddb_to_operational(topic, NOW).orderBy("event_id").collect()
    assert {r.message_id for r in rows} == {"a", "-5"}
    by_id = {r.message_id: r for r in rows}
    assert by_id["a"].status == "unknown" and by_id["a"].correlation_id == "a"
    assert by_id["-5"].status == "true" and by_id["-5"].provider == '{"X":1}'
    payload = json.loads(by_id["a"].payload_json)
    assert payload["error_code"] is None and payload["updated_at"] == "2024-02-01T00:00:00Z"


def test_nested_attributes(spark, topic_of):
    item = {
        "m": {"M": {"a": {"N": "1"}, "b": {"M": {"c": {"S": "x"}}}}},
        "l": {"L": [{"N": "1"}, {"N": "2"}, {"NULL": True}]},
    }
    from pyspark.sql.types import _parse_datatype_string

    schema = _parse_datatype_string("m struct<a: int, b: struct<c: string>>, l array<int>, none struct<a: int>")
    rows = dynamodb.new_images(dynamodb.stream_records(topic_of(images(item))))
    row = one(dynamodb.unmarshal(rows, schema))
    assert row.m.a == 1 and row.m.b.c == "x" and row.l == [1, 2, None] and row.none is None


def test_odd_attributes(spark, topic_of):
    odd = {
        "status": "plain",
        "provider": 7,
        "error_code": None,
        "error_message": {"NULL": False},
        "mailbox_id": {"S": None, "N": "3"},
        "trace_id": {"L": [{"S": "x"}]},
        "tenant_id": {"N": 12, "S": {"a": 1}},
        "message_id": {"BOOL": False, "NULL": True},
        "mail_id": {"NULL": "no"},
        "correlation_id": {"NULL": {}},
        "processing_stage": [],
        "updated_at": {"Status": "x", "s": "y"},
    }
    rows = dynamodb.new_images(dynamodb.stream_records(topic_of(images(odd, {"other": {"S": "x"}}))))
    item = dynamodb.unmarshal(rows, dynamodb.ITEM)
    names = [field.name for field in dynamodb.ITEM]
    each = rows.select(*[dynamodb.attribute(F.col("image"), f"$.{n}", T.StringType()).alias(n) for n in names])
    assert sorted(map(str, item.select(*names).collect())) == sorted(map(str, each.collect()))


# Operational records.


def test_operational_defaults(spark, topic_of):
    topic = topic_of(
        json.dumps({"message_id": "m", "payload_json": '{"status":"sent","provider":null}'}),
        json.dumps({"message_id": "m", "status": "", "payload_json": {"status": "sent", "mailbox_id": 7}}),
        json.dumps({"message_id": "m", "event_time": "2024-01-02T03:04:05Z", "correlation_id": "c"}),
        json.dumps({"message_id": "  "}),
        json.dumps({"message_id": "m", "payload_json": "{broken"}),
        json.dumps({"message_id": "m", "payload_json": ""}),
        "broken",
        json.dumps({"message_id": "", "payload_json": "{broken"}),
    )
    rows = operational.ops_enrich(topic, NOW).collect()
    assert [r.status for r in rows] == ["sent", "", "unknown", "unknown"]
    assert [r.mailbox_id for r in rows] == ["unknown", "7", "unknown", "unknown"]
    assert rows[0].event_id is None and rows[0].provider is None
    assert rows[0].event_type == "mail.operational.status_changed"
    assert [r.correlation_id for r in rows] == ["m", "m", "c", "m"]
    assert rows[2].event_time == 1704164645000 and rows[0].event_time == 1706745600000
    bad = operational.operational_dead_letters(topic).orderBy("kafka_offset").collect()
    assert [r.reason for r in bad] == ["malformed_payload", "not_json_object"]


# Staging and marts.


def landing(spark, *rows):
    """Rows of (event_id, tenant, type, minute, payload)."""
    noon = dt.datetime(2024, 1, 1, 12)
    full = []
    for event_id, tenant, kind, minute, payload in rows:
        at = noon + dt.timedelta(minutes=minute)
        full.append(
            (event_id, kind, "1.0.0", "", "", "s", tenant, "m", "c", None, None, payload, at, at, at.date())
        )
    return spark.createDataFrame(full, schemas.LANDING)


def test_attributes_from_either_spelling(spark):
    rows = landing(
        spark,
        ("flat", "t", "x", 0, '{"campaign_id": 7, "status": null, "delivery": {"status": "s"}}'),
        ("nested", "t", "x", 0, '{"campaign": {"id": "c"}, "template": "scalar"}'),
        ("bad", "t", "x", 0, "not-json"),
        ("none", "t", "x", 0, None),
    )
    got = {r.event_id: r for r in staging.stage_events(rows).collect()}
    assert got["flat"].campaign_id == "7" and got["flat"].delivery_status == "s"
    assert got["nested"].campaign_id == "c" and got["nested"].template_id is None
    assert got["bad"].campaign_id is None and got["none"].campaign_id is None
    assert len(got) == 4


def test_campaign_join_repeats_rows_unless_one_description_is_chosen(spark):
    staged = staging.stage_events(
        landing(
            spark,
            ("a", "t", "mail.delivered", 0, '{"campaign_id":"c","provider":"p1"}'),
            ("b", "t", "mail.opened", 1, '{"campaign_id":"c","provider":"p2"}'),
            ("c", "t", "mail.opened", 2, '{"campaign_id":"c","provider":"p2"}'),
        )
    )
    metrics, dimension = activity.campaign_daily_metrics(staged), activity.campaign_dimension(staged)
    assert one(metrics).open_rate == 2.0
    assert marts.campaign_performance(metrics, dimension).count() == 2
    chosen = marts.one_description(dimension, "campaign", ["campaign_name"])
    row = one(marts.campaign_performance(metrics, chosen))
    assert (row.provider, row.campaign_name, row.campaign_total_events) == ("p2", "c", 2)


def test_null_keys_do_not_enter_dimensions(spark):
    rows = landing(spark, ("a", None, "x", 0, "{}"), ("b", "t", None, 0, "{}"))
    assert [r.tenant_id for r in activity.tenant_dimension(rows).collect()] == ["t"]
    assert [r.event_type for r in activity.event_type_dimension(rows).collect()] == ["x"]
    assert activity.daily_delivery_fact(rows).count() == 1


def test_layer_of_a_small_day(spark, folder):
    offer = json.dumps({"campaign_id": "c7", "campaign_name": "Harvest", "template_id": "t3", "template_channel": "sms", "provider": "post"})
    events = landing(
        spark,
        ("1", "north", "mail.requested", 60, offer),
        ("2", "north", "mail.delivered", 90, offer),
        ("3", "north", "mail.clicked", 95, offer),
        ("4", "south", "mail.requested", 30, "{}"),
    )
    built = semantic.build_semantic_layer(spark, events, folder, gate=True)
    summary = {
        r.tenant_id: (r.requested_count, r.delivered_count, r.opened_count, r.clicked_count, r.delivery_success_rate, r.tenant_lifetime_events)
        for r in built["customer_delivery_summary"].collect()
    }
    assert summary == {"north": (1, 1, 0, 1, 1.0, 3), "south": (1, 0, 0, 0, 0.0, 1)}
    assert [(r.campaign_id, r.campaign_total_events) for r in built["campaign_performance"].collect()] == [("c7", 3)]
    assert built["reporting_dimensions"].count() == 6
    semantic.register_views(built)
    assert one(spark.sql("select sum(tenant_total_events) from customer_tenant"))[0] == 4
    again = semantic.build_semantic_layer(spark, events.where("event_id <> '4'"), folder, version=1, only=("event_type",))
    assert again["event_type"].agg(F.sum("total_events")).first()[0] == 3
    assert built["event_type"].agg(F.sum("total_events")).first()[0] == 4


def test_unknown_time_never_wins_the_latest_state(spark):
    rows = [
        ("e1", "mail.opened", "t", "m", "c", None, dt.datetime(2024, 1, 1), None, "s1", None),
        ("e2", "mail.clicked", "t", "m", "c", None, None, dt.datetime(2025, 1, 1), "s2", None),
        ("e3", "mail.clicked", "t", "m", "c", None, dt.datetime(2024, 1, 1), None, "s3", None),
    ]
    fact = spark.createDataFrame(rows, schemas.FCT_MAIL_LIFECYCLE)
    assert one(latest.latest_per_message(fact)).latest_status == "s3"


def test_grid_has_every_pair(spark):
    names = "first_seen_at timestamp_ntz, last_seen_at timestamp_ntz, total_events long"
    left = spark.createDataFrame([(f"t{i}", None, None, i) for i in range(100)], f"tenant_id string, {names}")
    right = spark.createDataFrame([(f"e{i}", None, None, i) for i in range(7)], f"event_type string, {names}")
    pairs = marts.reporting_dimensions(left, right).select("tenant_id", "event_type")
    assert pairs.count() == 700 and pairs.distinct().count() == 700


def test_empty_relation_has_its_schema(spark):
    empty = marts.empty_relation(spark, schemas.FCT_MAIL_LIFECYCLE)
    assert empty.count() == 0
    assert [(f.name, f.dataType) for f in empty.schema] == [
        (f.name, f.dataType) for f in schemas.FCT_MAIL_LIFECYCLE
    ]


# Quality.


def test_checks(spark):
    df = spark.createDataFrame(
        [("a", 0.5, 1), ("a", 1.5, -1), (None, None, None), (None, 1.0, 0), (" ", 0.0, 2)], "k string, r double, n int"
    )
    checks = quality.Checks(
        not_null=("k",),
        not_empty=("k",),
        non_negative=("n",),
        between_zero_and_one=("r",),
        unique=("k",),
        unique_combination=(("k",),),
    )
    report = {r["check"]: r.failures for r in quality.run_checks(df, "x", checks).collect()}
    assert report == {
        "not_null": 2,
        "not_empty": 1,
        "non_negative": 1,
        "between_zero_and_one": 1,
        "unique": 1,
        "unique_combination": 2,
    }
    assert quality.failing_rows(df, "non_negative", "n").count() == 1


def test_gate_stops_before_the_marts(spark, folder, tmp_path):
    rows = landing(spark, ("a", "t", "mail.delivered", 0, "{}"), ("a", "t", "mail.delivered", 0, "{}"))
    with pytest.raises(quality.QualityError, match="event_id unique_combination: 1"):
        semantic.build_semantic_layer(spark, rows, folder, gate=True)
    assert not (tmp_path / "customer_tenant").exists()


@pytest.mark.parametrize("now, status", [("2024-01-01 13:00:00", "pass"), ("2024-01-01 15:00:00", "warn"), ("2024-01-01 19:00:00", "error")])
def test_freshness(spark, now, status):
    rows = landing(spark, ("a", "t", "x", 0, "{}"))
    rule = quality.FRESHNESS["landing_events"]
    assert one(quality.freshness(rows, "r", rule, now)).status == status
    assert one(quality.freshness(rows.where("false"), "r", rule, now)).status == "error"


def violations(topic):
    return sorted(r.violation for r in contracts.contract_violations(topic).collect())


def test_contracts(spark, topic_of):
    good = {"provider": "p", "provider_message_id": "x", "delivery_status": "delivered"}
    assert violations(topic_of(envelope(payload=good))) == []
    assert violations(topic_of(envelope(payload=good, event_type="mail.other"))) == []
    assert violations(topic_of("broken")) == ["not_json_object"]
    assert violations(topic_of(envelope(payload="{}"))) == ["type:payload"]
    assert violations(topic_of(envelope(payload=good, event_version="1", actor_type=None, shard=2))) == [
        "extra:shard",
        "pattern:event_version",
    ]
    bad = {"provider": None, "delivery_status": "late", "provider_latency_ms": -1, "delivered_at": "soon", "z": 1}
    assert violations(topic_of(envelope(payload=bad))) == [
        "extra:payload.z",
        "format:payload.delivered_at",
        "minimum:payload.provider_latency_ms",
        "missing:payload.provider_message_id",
        "type:payload.provider",
        "value:payload.delivery_status",
    ]
    for time in ("1700000000000", "2024-01-01", "2024-01-01T10:00:00", "2024-13-01T10:00:00Z"):
        assert violations(topic_of(envelope(payload=good, event_time=time))) == ["format:event_time"]
    for time in ("2024-01-01T10:00:00Z", "2024-01-01t10:00:00.25+01:00"):
        assert violations(topic_of(envelope(payload=good, event_time=time))) == []
    for latency, broken in ((12.0, []), (12.5, ["type"]), (-12.0, ["minimum"]), (3, [])):
        found = violations(topic_of(envelope(payload={**good, "provider_latency_ms": latency})))
        assert found == [f"{name}:payload.provider_latency_ms" for name in broken]


# Dashboards, retention, lifecycle questions.


def test_terms_leave_out_missing_values_and_break_ties_by_value(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,), (None,), (None,)], "x string")
    assert [tuple(r) for r in dashboards.top_terms(df, "x", 2).collect()] == [("c", 2), ("a", 1)]


def test_histogram_has_no_empty_bucket(spark):
    noon = dt.datetime(2024, 1, 1, 12)
    rows = [(noon,), (noon + dt.timedelta(minutes=59),), (noon + dt.timedelta(hours=5),), (None,)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz")
    counts = dashboards.volume_over_time(df, "ts", "1 hour").orderBy("bucket_start").collect()
    assert [tuple(r) for r in counts] == [(noon, 2), (noon + dt.timedelta(hours=5), 1)]
    assert dashboards.automatic_interval(df, "ts") == "300 seconds"


def test_retention_keeps_the_boundary(spark):
    now = dt.datetime(2024, 2, 1)
    ages = [dt.timedelta(days=7), dt.timedelta(days=7, seconds=1), dt.timedelta()]
    df = spark.createDataFrame([(now - age,) for age in ages] + [(None,)], "ts timestamp_ntz")
    assert retention.apply_retention(df, "ts", "7d", NOW).count() == 3
    tiers = [r.tier for r in retention.with_tier(df, "ts", NOW).collect()]
    assert tiers == ["hot", "warm", "hot", None]


def test_offset_gaps_across_blocks(spark):
    block = ranges.BLOCK
    offsets = [0, 1, 4, block - 1, block, block + 1, 3 * block + 5]
    df = spark.createDataFrame([("t", 0, o) for o in offsets], "topic string, partition int, offset long")
    gaps = {(r.first_missing, r.last_missing, r.missing) for r in lifecycle.offset_gaps(df).collect()}
    assert gaps == {(2, 3, 2), (5, block - 2, block - 6), (block + 2, 3 * block + 4, 2 * block + 3)}


def test_taxonomy(spark):
    df = spark.createDataFrame([("mail.opened",), ("mail.retry_scheduled",), ("mail.other",), (None,)], "event_type string")
    got = [(r.event_family, r.lifecycle_stage) for r in lifecycle.classify(df).collect()]
    assert got == [("engagement", 7), ("dispatch", None), (None, None), (None, None)]


def test_declared_tables(spark):
    from letterlake.sources import lakehouse

    lakehouse.create_tables(spark, "lake")
    lakehouse.create_tables(spark, "lake")
    try:
        for name, schema in lakehouse.SOURCE_TABLES.items():
            stored = lakehouse.source_table(spark, name, catalog="lake")
            assert stored.columns == schema.fieldNames() and stored.count() == 0
        layout = spark.sql("describe lake.landing_events").collect()
        assert any(r.col_name == "# Partition Information" for r in layout)
    finally:
        spark.sql("drop namespace lake cascade")


def test_hot_keys_against_brute_force(spark):
    """A third of all rows on one message, one tenant, one event id."""
    from collections import Counter

    rows = []
    for n in range(3000):
        hot = n % 3 == 0
        at = dt.datetime(2024, 1, 1) + dt.timedelta(seconds=(n * 7919) % 3000)
        rows.append(
            ("hot" if hot else f"e{n}", "mail.opened", "hot" if hot else f"t{n % 50}",
             "hot" if hot else f"m{n % 100}", "c", "p", at, at, f"s{n}", None)
        )
    fact = spark.createDataFrame(rows, schemas.FCT_MAIL_LIFECYCLE).repartition(8)

    newest = {}
    for r in rows:
        key = (r[6], r[7], r[0], r[8])
        if r[3] not in newest or key[:3] > newest[r[3]][:3]:
            newest[r[3]] = key
    got = {r.message_id: r.latest_event_time for r in latest.latest_per_message(fact).collect()}
    assert got == {message: key[0] for message, key in newest.items()}

    unique = marts.fct_mail_lifecycle(fact.limit(0), fact)
    assert unique.count() == len({r[0] for r in rows})
    top = dashboards.top_terms(fact, "tenant_id", 1).first()
    assert tuple(top) == Counter(r[2] for r in rows).most_common(1)[0]
    history = [(r.message_id, r.event_time, r.event_id) for r in lifecycle.audit_history(fact).collect()]
    assert history == sorted((r[3], r[6], r[0]) for r in rows)
