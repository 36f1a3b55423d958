"""The registered queries once more, as plain SQL for DuckDB over the same tables.

Inputs and results are derived here from the driver's tables alone, independent of the Spark code:
named relations below are put in front of a query as common table expressions where it needs them.
"""

from __future__ import annotations

import re

_MAIL_TYPE = """case kind when 'signup' then 'mail.requested' when 'purchase' then 'mail.delivered'
    when 'view' then 'mail.opened' when 'click' then 'mail.clicked'
    else case when k % 2 = 0 then 'mail.dispatched' else 'mail.bounced' end end"""

_ISO = "strftime({0}, '%Y-%m-%dT%H:%M:%S.%gZ')"


def _quoted(expression: str) -> str:
    return f"""coalesce('"' || replace({expression}, '"', '\\"') || '"', 'null')"""


def _topic(source: str, name: str, partitions: int, value: str) -> str:
    return f"""
        select {value} as value, '{name}' as topic, cast(i % {partitions} as integer) as partition,
            i // {partitions} + copy * 1000000000000 as "offset",
            ts + to_seconds(21 + copy * 60) as "timestamp"
        from {source}, lateral (select unnest(case when i % 79 = 0 then [0, 1] else [0] end) as copy)"""


def _time(text: str) -> str:
    """Epoch-millisecond digits or ISO text as a timestamp."""
    return f"""case when regexp_full_match({text}, '-?[0-9]+')
            and abs(try_cast({text} as hugeint)) <= 9223372036854775 then make_timestamp(cast({text} as bigint) * 1000)
        when regexp_matches({text}, '^[0-9]{{4}}-') then try_cast({text} as timestamp) end"""


def _counts(weight: str = "1") -> str:
    types = ("requested", "dispatched", "delivered", "opened", "clicked")
    return ", ".join(
        f"cast(sum(if(event_type = 'mail.{t}', {weight}, 0)) as bigint) as {t}_count" for t in types
    )


def _rate(part: str, whole: str, name: str) -> str:
    return f"case when {whole} = 0 then 0.0 else cast({part} as double) / {whole} end as {name}"


_RATES = ", ".join(
    (
        _rate("opened_count", "delivered_count", "open_rate"),
        _rate("clicked_count", "delivered_count", "click_through_rate"),
    )
)

_SEEN = "min(event_ts) as first_seen_at, max(event_ts) as last_seen_at, count(*) as total_events"

_BLANK = "coalesce(trim({0}), '') = ''"

_FIVE_TYPES = "('mail.requested', 'mail.dispatched', 'mail.delivered', 'mail.opened', 'mail.clicked')"

_NOW = "timestamp '2024-02-01 00:00:00'"
_NOW_MILLIS = "1706745600000"

_PLACE = """sha256(topic || '|' || partition || '|' || "offset")"""

RELATIONS = {
    "numbered": """
        select event_id as i, event_id // 4 as m, cast(json_extract_string(props, '$.k') as integer) as k,
            ts, event_type as kind from events""",
    "told": f"""
        select *,
            case when i % 7 = 0 then upper({_MAIL_TYPE}) else {_MAIL_TYPE} end as event_type,
            case when i % 61 = 0 then null else 'tenant-' || (m % 80) end as tenant_id,
            case when i % 53 = 0 then '' when i % 59 = 0 then '  ' when i % 67 = 0 then null
                else 'msg-' || m end as message_id,
            case when i % 71 = 0 then 'not-json' when m % 9 = 0 then '{{}}'
                when i % 2 = 0 then '{{"campaign_id":"cmp-' || (m % 12) || '","template_id":"tpl-' || (m % 8)
                    || case when k >= 50 then '","template_name":"Template ' || (m % 8) else '' end
                    || '","provider":"prov-' || (m % 5) || '"'
                    || case when k % 3 = 0 then ',"status":"accepted"' else '' end
                    || case when kind = 'error' then ',"error_code":"E' || (k % 5) || '"' else '' end || '}}'
                else '{{"campaign":{{"id":"cmp-' || (m % 12) || '","name":"Name cmp-' || (m % 12)
                    || '"}},"template":{{"id":"tpl-' || (m % 8) || '","channel":"'
                    || case k % 3 when 0 then 'email' when 1 then 'sms' else 'postal_mail' end
                    || '"}},"delivery":{{"provider":"prov-' || (m % 5) || '","status":'
                    || case when k % 4 = 0 then 'null' else '"sent"' end || '}},"attempt":' || (k % 4) || '}}'
                end as payload,
            {_ISO.format('ts')} as iso, {_ISO.format("ts + interval 20 seconds")} as ingested_iso,
            cast(epoch_us(ts) // 1000 as varchar) as millis
        from numbered""",
    "landing": """
        select 'evt-' || i as event_id, event_type, '1.0.0' as event_version,
            case when i % 2 = 0 then iso else millis end as event_time, ingested_iso as ingested_at,
            'mail.pipeline' as source_system, tenant_id, message_id, 'corr-' || m as correlation_id,
            'trace-' || i as trace_id, 'service' as actor_type, payload, ts as event_ts,
            ts + interval 20 seconds as ingested_ts, cast(ts as date) as event_date
        from told""",
    "lifecycle": _topic(
        "told",
        "evt.mail.lifecycle.raw",
        12,
        f"""case when i % 101 = 0 then 'MALFORMED_NON_JSON_' || i when i % 103 = 0 then null
            when i % 107 = 0 then '{{"event_id":"evt-' || i || '","event_type":'
            when i % 109 = 0 then '["not","an","object"]'
            else '{{"event_id":' || case when i % 113 = 0 then 'null' else '"evt-' || i || '"' end
                || ',"event_type":"' || event_type || '","event_version":"1.0.0","event_time":'
                || case when i % 2 = 0 then '"' || iso || '"' else millis end
                || ',"ingested_at":"' || ingested_iso || '","source_system":"mail.pipeline","tenant_id":'
                || {_quoted('tenant_id')} || ',"message_id":' || {_quoted('message_id')}
                || ',"correlation_id":' || case when i % 43 = 0 then 'null' else '"corr-' || m || '"' end
                || ',"trace_id":"trace-' || i || '","actor_type":"service",'
                || case when payload = 'not-json' then '"payload":"not-json"'
                    when i % 5 = 0 then '"payload_json":' || {_quoted('payload')}
                    else '"payload":' || payload end || '}}' end""",
    ),
    "parsed": """
        select topic, partition, "offset", "timestamp", value, doc is null as corrupt,
            doc->>'$.event_id' as event_id, doc->>'$.event_type' as event_type,
            doc->>'$.event_version' as event_version, doc->>'$.event_time' as event_time,
            doc->>'$.ingested_at' as ingested_at, doc->>'$.source_system' as source_system,
            doc->>'$.tenant_id' as tenant_id, doc->>'$.message_id' as message_id,
            doc->>'$.correlation_id' as correlation_id, doc->>'$.trace_id' as trace_id,
            doc->>'$.actor_type' as actor_type,
            coalesce(doc->>'$.payload', doc->>'$.payload_json') as payload
        from (select *, case when json_valid(value) and value like '{%' then value::json end as doc
              from lifecycle where value is not null)""",
    "decoded": f"""
        select event_id, event_type, event_version, event_time, ingested_at, source_system, tenant_id,
            message_id, correlation_id, trace_id, actor_type, payload, {_time('event_time')} as event_ts,
            {_time('ingested_at')} as ingested_ts, cast({_time('event_time')} as date) as event_date
        from parsed where not corrupt and event_id is not null""",
    "dead": """
        select value as raw_payload, topic as kafka_topic, partition as kafka_partition,
            "offset" as kafka_offset, "timestamp" as kafka_timestamp,
            case when corrupt then 'not_json_object' else 'missing_event_id' end as reason
        from parsed where corrupt or event_id is null""",
    "normalized": f"""
        select event_id, lower(event_type) as event_type, event_version, {_time('event_time')} as event_time,
            {_time('ingested_at')} as ingested_at, source_system, tenant_id, message_id, correlation_id,
            trace_id, actor_type, payload
        from parsed
        where not corrupt and event_id is not null and message_id is not null and correlation_id is not null""",
    "staged": """
        select event_id, tenant_id, message_id, correlation_id, event_type, source_system, actor_type,
            event_ts, ingested_ts, event_date, payload,
            coalesce(doc->>'$.campaign_id', doc->>'$.campaign.id') as campaign_id,
            coalesce(doc->>'$.campaign_name', doc->>'$.campaign.name') as campaign_name,
            coalesce(doc->>'$.template_id', doc->>'$.template.id') as template_id,
            coalesce(doc->>'$.template_name', doc->>'$.template.name') as template_name,
            coalesce(doc->>'$.template_channel', doc->>'$.template.channel') as template_channel,
            coalesce(doc->>'$.provider', doc->>'$.delivery.provider') as provider,
            coalesce(doc->>'$.status', doc->>'$.delivery.status') as delivery_status
        from (select *, case when json_valid(payload) then payload::json end as doc from landing)""",
    "tenants": f"select tenant_id, {_SEEN} from landing where tenant_id is not null group by tenant_id",
    "types": f"select event_type, {_SEEN} from landing where event_type is not null group by event_type",
    "daily": f"""
        select tenant_id, event_date, {_counts()} from landing
        where tenant_id is not null and event_date is not null group by all""",
    "daily_metrics": f"""
        select d.*, coalesce(t.total_events, 0) as tenant_lifetime_events, {_RATES},
            {_rate('delivered_count', 'requested_count', 'delivery_success_rate')}
        from daily d left join tenants t on d.tenant_id = t.tenant_id""",
    "campaign_days": f"""
        select *, {_RATES} from (select tenant_id, campaign_id, event_date, {_counts()} from staged
            where campaign_id is not null group by all)""",
    "template_days": f"""
        select *, {_RATES} from (select tenant_id, template_id, event_date, {_counts()} from staged
            where template_id is not null group by all)""",
    "campaigns": f"""
        select tenant_id, campaign_id, coalesce(campaign_name, campaign_id) as campaign_name, provider,
            first_seen_at, last_seen_at, total_events
        from (select tenant_id, campaign_id, campaign_name, provider, {_SEEN} from staged
            where campaign_id is not null group by all)""",
    "templates": f"""
        select tenant_id, template_id, coalesce(template_name, template_id) as template_name,
            template_channel, provider, first_seen_at, last_seen_at, total_events
        from (select tenant_id, template_id, template_name, template_channel, provider, {_SEEN} from staged
            where template_id is not null group by all)""",
    "campaigns_once": """
        select * from campaigns qualify row_number() over (partition by tenant_id, campaign_id
            order by last_seen_at desc nulls last, provider nulls last, campaign_name nulls last) = 1""",
    "templates_once": """
        select * from templates qualify row_number() over (partition by tenant_id, template_id
            order by last_seen_at desc nulls last, provider nulls last, template_name nulls last,
                template_channel nulls last) = 1""",
    "ops_told": f"""
        select *, '"status":"' || case when i % 23 = 0 then '' else status end || '","mailbox_id":"mbx-' || (m % 50)
                || '","processing_stage":"' || stage || '","provider":'
                || case when k % 10 = 0 then 'null' else '"prov-' || (m % 5) || '"' end
                || case when status = 'failed'
                    then ',"error_code":"E' || (k % 6) || '","error_message":"failure ' || (k % 6) || '"'
                    else '' end as fields
        from (select *,
            case k % 5 when 0 then 'queued' when 1 then 'processing' when 2 then 'delivered'
                when 3 then 'failed' else 'retrying' end as status,
            case k % 4 when 0 then 'intake' when 1 then 'routing' when 2 then 'dispatch'
                else 'delivery' end as stage
            from told)""",
    "ops_detailed": """
        select *, case when i % 7 = 0 then '{}' else '{' || fields || ',"attempt":' || (k % 4) || '}' end as details
        from ops_told""",
    "operational": _topic(
        "ops_detailed",
        "evt.mail.operational.raw",
        12,
        f"""case when i % 101 = 0 then 'MALFORMED_NON_JSON_' || i
            else '{{' || case when i % 47 = 0 then '' else '"event_id":"ops-' || i || '",' end
                || case when i % 3 = 0 then '' else '"event_type":"mail.operational.' || status
                    || '","event_version":"1.1.0","source_system":"mailroom",' end
                || '"tenant_id":' || {_quoted('tenant_id')} || ',"message_id":' || {_quoted('message_id')}
                || case when i % 4 = 0 then '' else ',"correlation_id":"corr-' || m || '"' end
                || case when i % 19 = 0 then '' when i % 17 = 0 then ',"event_time":"' || iso || '"'
                    else ',"event_time":' || millis end
                || case when i % 3 = 0 then '' else ',' || fields end || ',"payload_json":'
                || case when i % 41 = 0 then '"{{broken"' when i % 5 = 0 then details
                    else {_quoted('details')} end || '}}' end""",
    ),
    "ops_parsed": """
        select *, case when json_valid(doc->>'$.payload_json') then (doc->>'$.payload_json')::json end as details
        from (select *, case when json_valid(value) then value::json end as doc from operational)""",
    "enriched": f"""
        select doc->>'$.event_id' as event_id,
            coalesce(doc->>'$.event_type', 'mail.operational.status_changed') as event_type,
            coalesce(doc->>'$.event_version', '1.0.0') as event_version,
            coalesce(doc->>'$.source_system', 'dynamodb.mail_tracking') as source_system,
            doc->>'$.tenant_id' as tenant_id, doc->>'$.message_id' as message_id,
            coalesce(doc->>'$.correlation_id', doc->>'$.message_id') as correlation_id,
            coalesce(doc->>'$.status', details->>'$.status', 'unknown') as status,
            coalesce(doc->>'$.mailbox_id', details->>'$.mailbox_id', 'unknown') as mailbox_id,
            coalesce(doc->>'$.processing_stage', details->>'$.processing_stage', 'unknown') as processing_stage,
            coalesce(doc->>'$.provider', details->>'$.provider') as provider,
            coalesce(doc->>'$.error_code', details->>'$.error_code') as error_code,
            coalesce(doc->>'$.error_message', details->>'$.error_message') as error_message,
            coalesce(epoch_us({_time("(doc->>'$.event_time')")}) // 1000, {_NOW_MILLIS}) as event_time,
            '2024-02-01T00:00:00Z' as dashboard_ts
        from ops_parsed
        where doc is not null and details is not null and not ({_BLANK.format("doc->>'$.message_id'")})""",
    "documents_out": f"""
        select * replace (make_timestamp(event_time * 1000) as event_time, {_NOW} as dashboard_ts),
            'internal_mail_tracking' as dashboard_source, {_NOW} as "@timestamp"
        from enriched""",
    "fact": """
        select event_id, event_type, tenant_id, message_id, correlation_id, provider_id, event_time,
            ingested_at, coalesce(status, split_part(event_type, '.', 2)) as latest_status, failure_code
        from (
            select distinct event_id, event_type, tenant_id, message_id, correlation_id,
                coalesce(doc->>'$.provider', doc->>'$.delivery.provider') as provider_id, event_time, ingested_at,
                coalesce(doc->>'$.status', doc->>'$.delivery.status') as status,
                doc->>'$.error_code' as failure_code
            from (select *, case when json_valid(payload) then payload::json end as doc from normalized)
            union all
            select distinct event_id, event_type, tenant_id, message_id, correlation_id, provider,
                make_timestamp(event_time * 1000), timestamp '2024-02-01 00:00:00', status, error_code
            from enriched where event_id is not null)""",
    "changes": _topic(
        """(select *, '{"message_id":"' || case when i % 79 = 0 then ' ' else 'msg-' || i end
                || '","tenant_id":"' || case when i % 71 = 0 then '' else 'tenant-' || t end
                || '","trace_id":"trace-' || i || '","status":"' || status || '","priority":"' || priority
                || '","created_at":' || millis || ',"updated_at":' || millis || '}' as image,
            case when i % 13 < 7 then 'c' when i % 13 < 12 then 'u' else 'd' end as op
            from ordered)""",
        "dbz.postgres.mail.public.mail_events",
        4,
        """case when i % 97 = 0 then 'not a change record ' || i when i % 89 = 0 then '{"payload":null}'
            else '{"payload":{' || case when i % 73 = 0 then ''
                    else '"op":"' || case when i % 61 = 0 then 'x' else op end || '",' end
                || case when i % 53 = 0 then '' else '"ts_ms":' || millis || ',' end || '"source":{'
                || case when i % 67 = 0 then '' else '"db":"mail",' end || '"schema":"public"'
                || case when i % 59 = 0 then '' else ',"txId":"tx-' || i || '"' end
                || case when i % 43 = 0 then '' else ',"table":"mail_events"' end || '},"before":'
                || case when op = 'd' and i % 83 <> 0 then image else 'null' end || ',"after":'
                || case when op = 'd' or i % 83 = 0 then 'null' else image end || '}}' end""",
    ),
    "ordered": """
        select o_orderkey as i, o_custkey % 80 as t, o_orderstatus as status, o_orderpriority as priority,
            o_orderdate as ts, cast(epoch_us(o_orderdate) // 1000 as varchar) as millis,
            strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') as iso
        from orders""",
    "canonical_changes": f"""
        select 'cdc-' || place as event_id,
            case coalesce(doc->>'$.payload.op', 'u') when 'c' then 'mail.requested' when 'r' then 'mail.requested'
                when 'u' then 'mail.updated' when 'd' then 'mail.deleted' else 'mail.unknown' end as event_type,
            '1.0.0' as event_version, coalesce(doc->>'$.payload.ts_ms', '{_NOW_MILLIS}') as event_time,
            '{_NOW_MILLIS}' as ingested_at,
            coalesce(doc->>'$.payload.source.db', 'postgres') || '.'
                || coalesce(doc->>'$.payload.source.table', 'unknown') as source_system,
            nullif(trim(img->>'$.tenant_id'), '') as tenant_id,
            coalesce(nullif(trim(img->>'$.message_id'), ''), 'gen-' || place) as message_id,
            coalesce(doc->>'$.payload.source.txId', nullif(trim(img->>'$.message_id'), ''), 'gen-' || place)
                as correlation_id,
            nullif(trim(img->>'$.trace_id'), '') as trace_id, 'service' as actor_type,
            cast(img as varchar) as payload
        from (select *, {_PLACE} as place,
                case when doc->>'$.payload.after' is not null then doc->'$.payload.after'
                    when doc->>'$.payload.before' is not null then doc->'$.payload.before' end as img
            from (select *, case when json_valid(value) then value::json end as doc from changes))
        where img is not null""",
    "attributes": _topic(
        "ordered",
        "evt.mail.operational.raw",
        12,
        """'{"Records":[{"eventID":"e-' || i || '","eventName":"MODIFY","dynamodb":{"Keys":{"id":{"S":"'
            || i || '"}}' || case when i % 11 = 0 then '' else ',"NewImage":{'
            || case when i % 13 = 0 then '"mail_id":{"S":"mail-' || i || '"}'
                when i % 17 = 0 then '"message_id":{"S":""}' else '"message_id":{"S":"msg-' || i || '"}' end
            || case when i % 3 = 0 then '' else ',"correlation_id":{"S":"corr-' || i || '"}' end
            || ',"tenant_id":{"S":"tenant-' || t || '"}'
            || case when i % 19 = 0 then ',"status":{"NULL":true}' when i % 29 = 0 then ''
                else ',"status":{"S":"' || status || '"}' end
            || ',"mailbox_id":{"N":"' || (i % 50) || '"}'
            || case when i % 31 = 0 then '' else ',"processing_stage":{"S":"' || priority || '"}' end
            || ',"error_code":{"NULL":true}'
            || case when i % 7 = 0 then ',"error_message":{"S":"late"}' else '' end
            || case when i % 5 = 0 then '' else ',"provider":{"S":"prov-' || (i % 5) || '"}' end
            || case when i % 23 = 0 then '' when i % 2 = 0 then ',"updated_at":{"S":"' || iso || '"}'
                else ',"last_updated_at":{"S":"' || iso || '"}' end
            || ',"attempts":{"N":"' || (2 - i % 5) || '"},"flagged":{"BOOL":'
            || case when i % 2 = 0 then 'true' else 'false' end
            || '},"details":{"M":{"region":{"S":"r-' || (t % 4) || '"},"size":{"N":"' || (i % 9)
            || '"},"tags":{"L":[{"S":"a' || (i % 3) || '"},{"N":"' || (i % 4) || '"}]}}}}' end
            || '}},{"eventID":"x-' || i || '","eventName":"REMOVE","dynamodb":{"Keys":{"id":{"S":"' || i || '"}}}}]}'""",
    ),
    "records": """
        select topic, partition, "offset", r.no as record_no, value::json->'$.Records'->r.no as record
        from attributes, lateral (select unnest([0, 1]) as no) r""",
    "images": """
        select * from (select topic, partition, "offset", record_no, record->'$.dynamodb.NewImage' as image
            from records) where image is not null""",
    "items": f"""
        select 'ddb-' || {_PLACE} || '-' || record_no as event_id,
            coalesce(nullif(image->>'$.message_id.S', ''), nullif(image->>'$.mail_id.S', ''),
                'gen-' || {_PLACE} || '-' || record_no) as message_id,
            image->>'$.correlation_id.S' as correlation_id, image->>'$.tenant_id.S' as tenant_id,
            coalesce(image->>'$.status.S', 'unknown') as status, image->>'$.mailbox_id.N' as mailbox_id,
            coalesce(image->>'$.processing_stage.S', 'unknown') as processing_stage,
            image->>'$.error_message.S' as error_message, image->>'$.provider.S' as provider,
            coalesce(image->>'$.updated_at.S', image->>'$.last_updated_at.S', '2024-02-01T00:00:00Z') as updated_at
        from images""",
    "latency": """
        select message_id, requested_at, delivered_at, provider_id,
            cast(floor(epoch(delivered_at)) as bigint) - cast(floor(epoch(requested_at)) as bigint) as latency_seconds
        from (select message_id, min(event_time) filter (event_type = 'mail.requested') as requested_at,
                min(event_time) filter (event_type = 'mail.delivered') as delivered_at,
                first(provider_id order by event_time, event_id) filter (event_type = 'mail.delivered') as provider_id
            from fact where coalesce(trim(message_id), '') <> '' group by message_id)
        where requested_at <= delivered_at""",
}


def _needs(sql: str) -> list[str]:
    return [name for name in RELATIONS if re.search(rf"(?<![\w.'\"$])\b{name}\b(?![\w'\"])", _code(sql))]


def _code(sql: str) -> str:
    return re.sub(r"'[^']*'", "''", sql)


def _with(body: str) -> str:
    """``body`` behind the relations it needs, each after those it builds on."""
    ordered: list[str] = []

    def add(sql: str) -> None:
        for name in _needs(sql):
            if name not in ordered:
                add_relation(name)

    def add_relation(name: str) -> None:
        for other in _needs(RELATIONS[name]):
            if other != name and other not in ordered:
                add_relation(other)
        if name not in ordered:
            ordered.append(name)

    add(body)
    if not ordered:
        return body
    parts = ",\n".join(f"{name} as materialized ({RELATIONS[name]})" for name in ordered)
    return f"with {parts}\n{body}"


_DOCUMENT_COLUMNS = """event_id, event_type, event_version, source_system, tenant_id, message_id,
    correlation_id, status, mailbox_id, processing_stage, provider, error_code, error_message, event_time,
    dashboard_ts, dashboard_source, "@timestamp" """

_ENVELOPE = """event_id, event_type, event_version, event_time, ingested_at, source_system, tenant_id,
    message_id, correlation_id, trace_id, actor_type, payload"""

_ROUTED = f"""(select *, {_BLANK.format('message_id')} as no_message from parsed where not corrupt)"""


def _performance(entity: str, labels: str, days: str, dimension: str) -> str:
    return f"""
        select m.*, {labels}, d.total_events as {entity}_total_events, d.first_seen_at as {entity}_first_seen_at,
            d.last_seen_at as {entity}_last_seen_at
        from {days} m left join {dimension} d on m.tenant_id = d.tenant_id and m.{entity}_id = d.{entity}_id"""


def _top(relation: str, column: str, size: int) -> str:
    return f"""select {column}, count(*) as events from {relation} where {column} is not null
        group by {column} order by events desc, {column} limit {size}"""


def _row_check(relation: str, check: str, column: str, condition: str) -> str:
    source = _CHECKED[relation]
    return f"""select '{check}' as "check", '{relation}' as relation, '{column}' as "column",
        count(*) filter ({condition}) as failures from {source}"""


def _key_check(relation: str, check: str, columns: str) -> str:
    source = _CHECKED[relation]
    where = f"where {columns} is not null" if check == "unique" else ""
    return f"""select '{check}' as "check", '{relation}' as relation, '{columns}' as "column",
        count(*) as failures from (select 1 from {source} {where} group by {columns} having count(*) > 1)"""


# The relation behind each name in the declared checks.
_CHECKED = {
    "landing_events": "landing",
    "dim_customer_tenant": "tenants",
    "dim_customer_event_type": "types",
    "fct_daily_customer_delivery": "daily",
    "customer_delivery_summary": "daily_metrics",
    "customer_tenant": "tenants",
    "event_type": "types",
    "campaign_performance": f"({_performance('campaign', 'd.campaign_name, d.provider', 'campaign_days', 'campaigns')})",
    "template_performance": "("
    + _performance("template", "d.template_name, d.template_channel, d.provider", "template_days", "templates")
    + ")",
    "internal_mail_tracking": """(select message_id, event_type as latest_event_type, event_time as latest_event_time
        from fact qualify row_number() over (partition by message_id
            order by event_time desc nulls last, ingested_at desc nulls last, event_id desc) = 1)""",
    "fct_mail_lifecycle": "fact",
    "dim_tenant": "(select cast(c_custkey as varchar) as tenant_id from customer)",
    "dim_provider": "(select cast(s_suppkey as varchar) as provider_id from supplier)",
}

_ROW_CONDITIONS = {
    "not_null": "{0} is null",
    "not_empty": "trim({0}) = ''",
    "non_negative": "{0} < 0",
    "between_zero_and_one": "{0} < 0 or {0} > 1",
}

# What is expected of each relation.
_EXPECTED = {
    "not_null": {
        "landing_events": "event_id tenant_id event_type event_ts",
        "dim_customer_tenant": "tenant_id",
        "dim_customer_event_type": "event_type",
        "fct_daily_customer_delivery": "tenant_id event_date",
        "customer_delivery_summary": "tenant_id event_date",
        "customer_tenant": "tenant_id",
        "event_type": "event_type",
        "campaign_performance": "tenant_id campaign_id event_date",
        "template_performance": "tenant_id template_id event_date",
        "internal_mail_tracking": "message_id latest_event_type latest_event_time",
        "fct_mail_lifecycle": "event_id event_type message_id correlation_id",
        "dim_tenant": "tenant_id",
        "dim_provider": "provider_id",
    },
    "not_empty": {
        "landing_events": "tenant_id event_type",
        "dim_customer_tenant": "tenant_id",
        "dim_customer_event_type": "event_type",
    },
    "non_negative": {
        "fct_daily_customer_delivery": "delivered_count opened_count clicked_count",
        "customer_delivery_summary": "tenant_lifetime_events",
        "campaign_performance": "requested_count delivered_count",
        "template_performance": "requested_count delivered_count",
    },
    "between_zero_and_one": {
        "customer_delivery_summary": "open_rate click_through_rate delivery_success_rate",
        "campaign_performance": "open_rate click_through_rate",
        "template_performance": "open_rate click_through_rate",
    },
}


def _row_checks(check: str) -> str:
    condition = _ROW_CONDITIONS[check]
    return "\nunion all\n".join(
        _row_check(relation, check, column, condition.format(column))
        for relation, columns in _EXPECTED[check].items()
        for column in columns.split()
    )


def _contract_sql() -> str:
    """Violations as a union of one query per rule."""
    def kind(path: str) -> str:
        return f"json_type(doc, '{path}')"

    iso = """(try_cast({0} as timestamptz) is null or not regexp_full_match({0},
        '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}[Tt ][0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}([.][0-9]+)?([Zz]|[+-][0-9]{{2}}:[0-9]{{2}})'))"""
    rules: list[tuple[str, str, str]] = []

    def text_rule(field: str, path: str, when: str, required: bool, nullable: bool) -> None:
        allowed = "('VARCHAR', 'NULL')" if nullable else "('VARCHAR')"
        rules.append((f"type:{field}", when, f"{kind(path)} not in {allowed}"))
        if required:
            rules.append((f"missing:{field}", when, f"{kind(path)} is null"))

    def extra(label: str, path: str, when: str, condition: str) -> None:
        rules.append((label, when, f"{kind(path)} = 'VARCHAR' and {condition.format(f'(doc->>{chr(39)}{path}{chr(39)})')}"))

    for field in "event_id event_type event_version event_time ingested_at source_system message_id correlation_id".split():
        text_rule(field, f"$.{field}", "true", True, False)
    for field in "tenant_id trace_id actor_type".split():
        text_rule(field, f"$.{field}", "true", False, True)
    extra("pattern:event_version", "$.event_version", "true", "not regexp_full_match({0}, '[0-9]+[.][0-9]+[.][0-9]+')")
    extra("format:event_time", "$.event_time", "true", iso)
    extra("format:ingested_at", "$.ingested_at", "true", iso)
    extra("value:actor_type", "$.actor_type", "true", "{0} not in ('user', 'system', 'scheduler', 'provider', 'service')")
    rules.append(("type:payload", "true", f"{kind('$.payload')} <> 'OBJECT'"))
    rules.append(("missing:payload", "true", f"{kind('$.payload')} is null"))

    texts = {
        "mail.requested": ("recipient channel template_id requested_by", "", "priority", "campaign_id"),
        "mail.delivered": ("provider provider_message_id delivery_status", "", "delivered_at", ""),
        "mail.operational.status_changed": (
            "status mailbox_id processing_stage updated_at", "", "", "error_code error_message provider"),
        "pipeline.job_failed": ("job_name job_type failure_reason failed_at", "", "", ""),
    }
    for event_type, (required, _, optional, nullable) in texts.items():
        when = f"event_type = '{event_type}' and {kind('$.payload')} = 'OBJECT'"
        for field in required.split():
            text_rule(f"payload.{field}", f"$.payload.{field}", when, True, False)
        for field in optional.split():
            text_rule(f"payload.{field}", f"$.payload.{field}", when, False, False)
        for field in nullable.split():
            text_rule(f"payload.{field}", f"$.payload.{field}", when, False, True)
    def of(event_type: str) -> str:
        return f"event_type = '{event_type}' and {kind('$.payload')} = 'OBJECT'"

    extra("value:payload.channel", "$.payload.channel", of("mail.requested"), "{0} not in ('email', 'postal_mail', 'sms')")
    extra("value:payload.priority", "$.payload.priority", of("mail.requested"), "{0} not in ('low', 'normal', 'high')")
    extra("value:payload.delivery_status", "$.payload.delivery_status", of("mail.delivered"), "{0} <> 'delivered'")
    extra("format:payload.delivered_at", "$.payload.delivered_at", of("mail.delivered"), iso)
    extra("format:payload.updated_at", "$.payload.updated_at", of("mail.operational.status_changed"), iso)
    extra("value:payload.job_type", "$.payload.job_type", of("pipeline.job_failed"), "{0} not in ('flink', 'airflow', 'dbt', 'connector')")
    extra("format:payload.failed_at", "$.payload.failed_at", of("pipeline.job_failed"), iso)
    latency = "$.payload.provider_latency_ms"
    rules.append(("type:payload.provider_latency_ms", of("mail.delivered"), f"{kind(latency)} not in ('UBIGINT', 'BIGINT', 'NULL')"))
    rules.append(("minimum:payload.provider_latency_ms", of("mail.delivered"), f"{kind(latency)} in ('UBIGINT', 'BIGINT') and cast(doc->>'{latency}' as bigint) < 0"))
    rules.append(("type:payload.recoverable", of("pipeline.job_failed"), f"{kind('$.payload.recoverable')} <> 'BOOLEAN'"))

    known = {
        "mail.requested": "recipient channel template_id campaign_id requested_by priority",
        "mail.delivered": "provider provider_message_id delivery_status delivered_at provider_latency_ms",
        "mail.operational.status_changed": "status mailbox_id processing_stage error_code error_message provider updated_at",
        "pipeline.job_failed": "job_name job_type failure_reason failed_at recoverable",
    }
    envelope = "event_id event_type event_version event_time ingested_at source_system tenant_id message_id correlation_id trace_id actor_type payload"

    def listed(names: str) -> str:
        return ", ".join(f"'{name}'" for name in names.split())

    keys = 'topic, partition, "offset", event_id, event_type'
    checks = ", ".join(f"case when ({when}) and ({condition}) then '{label}' end" for label, when, condition in rules)
    extras = [
        f"select {keys}, 'extra:' || key as violation from (select {keys}, unnest(json_keys(doc)) as key from docs) where key not in ({listed(envelope)})"
    ] + [
        f"select {keys}, 'extra:payload.' || key as violation from (select {keys}, unnest(json_keys(doc, '$.payload')) as key from docs where {of(event_type)}) where key not in ({listed(names)})"
        for event_type, names in known.items()
    ]
    return f"""
        select * from (with docs as (select *, doc->>'$.event_id' as event_id, doc->>'$.event_type' as event_type
            from (select *, value::json as doc from contracted))
        select * from (select {keys}, unnest([{checks}]) as violation from docs) where violation is not null
        union all {' union all '.join(extras)})"""


RELATIONS["contracted"] = _topic(
    f"""(select *, {_ISO.format('ts')} as iso,
            case k % 4 when 0 then 'mail.requested' when 1 then 'mail.delivered'
                when 2 then 'mail.operational.status_changed' else 'pipeline.job_failed' end as event_type,
            case k % 4
            when 0 then '{{"recipient":"r' || m || '","channel":"' || case when i % 11 = 0 then 'fax' else 'email' end || '"'
                || case when i % 13 = 0 then '' else ',"template_id":"tpl-' || (m % 8) || '"' end
                || ',"campaign_id":' || case when i % 3 = 0 then 'null' else '"cmp-1"' end || ',"requested_by":"u1"'
                || case when i % 17 = 0 then ',"priority":"urgent"' else ',"priority":"high"' end || '}}'
            when 1 then '{{"provider":"prov-' || (m % 5) || '"'
                || case when i % 11 = 0 then '' else ',"provider_message_id":"pm-' || i || '"' end
                || ',"delivery_status":"' || case when i % 13 = 0 then 'late' else 'delivered' end
                || '","provider_latency_ms":' || case when i % 17 = 0 then '-5' when i % 19 = 0 then '"12"'
                    when i % 5 = 0 then 'null' else cast(k as varchar) end || '}}'
            when 2 then '{{"status":"s","mailbox_id":' || case when i % 11 = 0 then '7' else '"mbx"' end
                || ',"processing_stage":"intake","error_code":null,"updated_at":"'
                || case when i % 13 = 0 then 'yesterday' else {_ISO.format('ts')} end || '"'
                || case when i % 17 = 0 then ',"shard":3' else '' end || '}}'
            else '{{"job_name":"j","job_type":"' || case when i % 11 = 0 then 'cron' else 'dbt' end
                || '","failure_reason":"timeout","failed_at":"' || {_ISO.format('ts')} || '"'
                || case when i % 13 = 0 then ',"recoverable":"yes"' else ',"recoverable":true' end || '}}' end as payload
        from numbered)""",
    "evt.mail.lifecycle.raw",
    12,
    """'{"event_id":' || case when i % 29 = 0 then cast(i as varchar) else '"evt-' || i || '"' end
        || ',"event_type":"' || event_type || '"'
        || case when i % 31 = 0 then '' else ',"event_version":"' || case when i % 37 = 0 then '1.0' else '1.0.0' end || '"' end
        || ',"event_time":"' || case when i % 41 = 0 then 'soon' else iso end || '","ingested_at":"' || iso
        || '","source_system":"mail.pipeline","tenant_id":' || case when i % 61 = 0 then 'null' else '"tenant-1"' end
        || case when i % 67 = 0 then '' else ',"message_id":"msg-' || m || '"' end || ',"correlation_id":"corr-' || m
        || '","actor_type":"' || case when i % 43 = 0 then 'robot' else 'service' end || '"'
        || case when i % 47 = 0 then ',"shard":1' else '' end
        || ',"payload":' || case when i % 53 = 0 then '"text"' else payload end || '}'""",
)

_STAGE_CASE = """case when t in ('mail.requested') then 1 when t in ('mail.accepted', 'mail.rejected') then 2
    when t in ('mail.normalized', 'mail.enriched') then 3 when t = 'mail.routed' then 4 when t = 'mail.dispatched' then 5
    when t in ('mail.delivered', 'mail.deferred', 'mail.bounced', 'mail.dropped') then 6
    when t in ('mail.opened', 'mail.clicked', 'mail.unsubscribed', 'mail.complained') then 7 end"""

_FAMILY_CASE = """case when t in ('mail.requested', 'mail.accepted', 'mail.rejected', 'mail.scheduled') then 'intake'
    when t in ('mail.normalized', 'mail.enriched', 'mail.classified', 'mail.routed') then 'enrichment'
    when t in ('mail.dispatched', 'mail.dispatch_failed', 'mail.retry_scheduled', 'mail.retry_exhausted') then 'dispatch'
    when t in ('mail.delivered', 'mail.bounced', 'mail.deferred', 'mail.dropped') then 'delivery_outcome'
    when t in ('mail.opened', 'mail.clicked', 'mail.unsubscribed', 'mail.complained') then 'engagement' end"""

_FAILED = """(event_type in ('mail.dispatch_failed', 'mail.bounced', 'mail.dropped', 'mail.rejected')
    or coalesce(latest_status, '') = 'failed')"""
_RETRIED = "(event_type = 'mail.retry_scheduled' or coalesce(latest_status, '') = 'retrying')"


def _fresh(relation: str, column: str, warn: int, error: int) -> str:
    return f"""select '{relation}' as relation, newest, age_seconds,
        case when newest is null or age_seconds > {error} then 'error' when age_seconds > {warn} then 'warn'
            else 'pass' end as status
        from (select newest, cast(floor(epoch(timestamp '2024-01-31 00:00:00')) - floor(epoch(newest)) as bigint) as age_seconds
            from (select cast(max({column}) as timestamp) as newest from {_CHECKED[relation]}))"""


_LIFECYCLE_UPSERT = f"""
    select event_id, event_type, tenant_id, message_id, correlation_id, provider_id, event_time,
        case when event_type = 'mail.bounced' then ingested_at + interval 1 hour else ingested_at end as ingested_at,
        case when event_type = 'mail.bounced' then 'corrected' else latest_status end as latest_status, failure_code
    from fact"""

QUERIES = {
    "src_topic_text": """
        select topic, partition, row_number() over (partition by partition order by writer, value) - 1 as "offset", value
        from (select topic, value, cast('0x' || substr(md5(value), 1, 8) as bigint) % 12 as partition,
                cast('0x' || substr(md5(value), 9, 4) as bigint) % 2 as writer
            from lifecycle where value is not null)""",
    "src_lakehouse_tables": """
        select 'landing_events' as relation, count(*) as documents from landing
        union all select 'dim_customer_tenant', count(*) from tenants
        union all select 'dim_customer_event_type', count(*) from types
        union all select 'fct_daily_customer_delivery', count(*) from daily""",
    "keyed_publish": """select case when trim(message_id) <> '' then message_id end as key, value
        from parsed where not corrupt""",
    "land_events": f"""select {_ENVELOPE}, event_ts, ingested_ts, event_date from (
        select * from decoded) group by all""",
    "dead_letter_split": """
        select 'landing' as target, count(*) as records from decoded
        union all select reason, count(*) from dead group by reason""",
    "dead_letter_docs": "select raw_payload, kafka_topic, kafka_partition, kafka_offset, kafka_timestamp from dead",
    "dead_letter_search": """select raw_payload, kafka_partition, kafka_offset from dead
        where list_contains(regexp_extract_all(lower(raw_payload), '[a-z0-9_]+'), 'malformed_non_json_101')""",
    "dead_letter_redaction": """select kafka_partition, kafka_offset,
        regexp_replace(regexp_replace(raw_payload,
                '("(?:event_id|tenant_id|message_id)"\\s*:\\s*")[^"]*', '\\1***', 'g'),
            '("(?:event_id|tenant_id|message_id)"\\s*:\\s*)[a-z0-9][^,}]*', '\\1***', 'g') as raw_payload
        from dead""",
    "decode_envelope": "select * from decoded",
    "normalize_lifecycle": "select * from normalized",
    "customer_projection": f"""select tenant_id, message_id, event_type, event_time, payload from normalized
        where tenant_id is not null and event_type in {_FIVE_TYPES}""",
    "internal_projection": "select tenant_id, message_id, correlation_id, event_type, event_time, payload from normalized",
    "route_internal": f"select message_id as key, value from {_ROUTED} where not no_message",
    "route_customer": f"""select tenant_id as key, value from {_ROUTED} where not no_message
        and event_type in {_FIVE_TYPES} and coalesce(trim(tenant_id), '') <> ''""",
    "route_health": f"select value from {_ROUTED} where no_message",
    "health_events": f"""select 'health-' || {_PLACE} as event_id, 'pipeline.job_failed' as event_type,
        '1.0.0' as event_version, '2024-02-01T00:00:00Z' as event_time, '2024-02-01T00:00:00Z' as ingested_at,
        'flink.mail_lifecycle_router' as source_system, tenant_id, 'unknown' as message_id,
        coalesce(correlation_id, 'health-' || {_PLACE}) as correlation_id, trace_id, 'system' as actor_type,
        '{{"failure_reason":"missing_message_id","job_name":"mail-lifecycle-router-java","job_type":"flink","failed_at":"2024-02-01T00:00:00Z","source_payload":'
            || cast(to_json(value) as varchar) || '}}' as payload
        from {_ROUTED} where no_message""",
    "cdc_to_canonical": "select * from canonical_changes",
    "ddb_records_explode": 'select topic, partition, "offset", record_no, record->>\'$.eventName\' as event_name from records',
    "ddb_unmarshal": """select "offset", partition, image->>'$.message_id.S' as message_id,
        coalesce(image->>'$.mail_id.S', null) as mail_id, image->>'$.status.S' as status,
        cast(image->>'$.attempts.N' as integer) as attempts, cast(image->>'$.flagged.BOOL' as boolean) as flagged,
        image->>'$.details.M.region.S' as region, cast(image->>'$.details.M.size.N' as bigint) as size,
        (image->>'$.details.M.tags.L[0].S') || ',' || (image->>'$.details.M.tags.L[1].N') as tags
        from images""",
    "ddb_to_operational": f"""select event_id, 'mail.operational.status_changed' as event_type, '1.0.0' as event_version,
        {_NOW_MILLIS} as event_time, {_NOW_MILLIS} as ingested_at, 'dynamodb.mail_tracking' as source_system, tenant_id,
        message_id, coalesce(correlation_id, message_id) as correlation_id, cast(null as varchar) as trace_id,
        'system' as actor_type, status, mailbox_id, processing_stage, cast(null as varchar) as error_code,
        error_message, provider,
        '{{"status":"' || status || '","mailbox_id":"' || mailbox_id || '","processing_stage":"' || processing_stage
            || '","error_code":null,"error_message":' || coalesce('"' || error_message || '"', 'null')
            || ',"provider":' || coalesce('"' || provider || '"', 'null') || ',"updated_at":"' || updated_at || '"}}' as payload_json
        from items""",
    "ops_enrich": "select * from enriched",
    "dashboard_docs": f"select {_DOCUMENT_COLUMNS} from documents_out",
    "operational_dead_letters": """select value as raw_payload, topic as kafka_topic, partition as kafka_partition,
        "offset" as kafka_offset, "timestamp" as kafka_timestamp,
        case when doc is null then 'not_json_object' else 'malformed_payload' end as reason
        from ops_parsed where doc is null
            or (details is null and coalesce(trim(doc->>'$.message_id'), '') <> '')""",
    "internal_union": """select event_id, event_type, tenant_id, message_id, correlation_id, status, processing_stage, payload
        from (select event_id, event_type, tenant_id, message_id, correlation_id, null as status,
                null as processing_stage, payload from normalized
            union all select event_id, event_type, tenant_id, message_id, correlation_id, status, processing_stage, null
            from enriched)""",
    "stg_events": "select * from staged",
    "stg_tenant": "select * from tenants",
    "stg_event_type": "select * from types",
    "stg_daily": "select * from daily",
    "dim_tenant_activity": "select * from tenants",
    "dim_event_type": "select * from types",
    "fct_daily_delivery": "select * from daily",
    "delivery_daily_metrics": "select * from daily_metrics",
    "customer_delivery_summary": "select * from daily_metrics",
    "mart_customer_tenant": "select tenant_id, first_seen_at, last_seen_at, total_events as tenant_total_events from tenants",
    "mart_event_type": "select * from types",
    "campaign_daily": "select * from campaign_days",
    "template_daily": "select * from template_days",
    "campaign_dimension": "select * from campaigns",
    "template_dimension": "select * from templates",
    "campaign_performance": _performance("campaign", "d.campaign_name, d.provider", "campaign_days", "campaigns"),
    "campaign_performance_dedup": _performance("campaign", "d.campaign_name, d.provider", "campaign_days", "campaigns_once"),
    "template_performance": _performance(
        "template", "d.template_name, d.template_channel, d.provider", "template_days", "templates"),
    "template_performance_dedup": _performance(
        "template", "d.template_name, d.template_channel, d.provider", "template_days", "templates_once"),
    "reporting_dimensions": """select t.tenant_id, t.first_seen_at, t.last_seen_at, t.total_events as tenant_total_events,
        e.event_type, e.first_seen_at as event_type_first_seen_at, e.last_seen_at as event_type_last_seen_at,
        e.total_events as event_type_total_events from tenants t cross join types e""",
    "volume_over_time": """select time_bucket(interval 1 hour, "@timestamp") as bucket_start, count(*) as events
        from (select event_time as "@timestamp" from documents_out) group by 1""",
    "volume_over_time_auto": """select time_bucket(to_seconds(width), event_time, timestamp '1970-01-01 00:00:00') as bucket_start, count(*) as events
        from documents_out, (select min(w) as width from (select unnest([1, 5, 10, 30, 60, 300, 600, 1800, 3600, 10800,
            43200, 86400, 604800, 2592000, 31536000]) as w) where cast(w as bigint) * 100 >=
            (select floor(epoch(max(event_time))) - floor(epoch(min(event_time))) from documents_out)) group by 1""",
    "events_by_type": _top("documents_out", "event_type", 10),
    "status_distribution": _top("documents_out", "status", 10),
    "top_tenants": _top("documents_out", "tenant_id", 20),
    "dlq_volume": """select time_bucket(interval 1 hour, kafka_timestamp) as bucket_start, count(*) as events
        from dead group by 1""",
    "dlq_top_partitions": _top("dead", "kafka_partition", 10),
    "recent_events": """select "@timestamp", event_type, tenant_id, message_id, status, provider, processing_stage
        from documents_out order by event_time desc, event_id desc nulls last, message_id desc, event_type limit 50""",
    "recent_dead_letters": """select kafka_timestamp, kafka_topic, kafka_partition, kafka_offset from dead
        order by kafka_timestamp desc, kafka_partition, kafka_offset desc limit 50""",
    "topic_peek": 'select partition, "offset", value from lifecycle order by partition, "offset" limit 5',
    "sink_counts": """select 'internal-mail-tracking' as relation, count(*) as documents from documents_out
        union all select 'internal-mail-tracking-deadletter', count(*) from dead""",
    "internal_mail_tracking": """select message_id, tenant_id, correlation_id, event_type as latest_event_type,
        event_time as latest_event_time, latest_status, failure_code from fact
        qualify row_number() over (partition by message_id
            order by event_time desc nulls last, ingested_at desc nulls last, event_id desc) = 1""",
    "fct_mail_lifecycle": "select * from fact",
    "dim_tenant": """select cast(c_custkey as varchar) as tenant_id, c_name as tenant_name, c_mktsegment as tenant_tier,
        created as tenant_created_at from customer
        left join (select o_custkey, min(o_orderdate) as created from orders group by 1) on o_custkey = c_custkey""",
    "dim_provider": """select cast(s_suppkey as varchar) as provider_id, s_name as provider_name, 'mail' as provider_type,
        r_name as provider_region from supplier left join nation on s_nationkey = n_nationkey
        left join region on n_regionkey = r_regionkey""",
    "incremental_upsert": _LIFECYCLE_UPSERT,
    "upsert_table": _LIFECYCLE_UPSERT,
    "dedup_events": f"select {_ENVELOPE}, event_ts, ingested_ts, event_date from decoded group by all",
    "retention_filter": """select event_id, event_ts from landing
        where event_ts >= timestamp '2024-02-01 00:00:00' - interval 7 days""",
    "retention_tiers": """select tier, count(*) as events from (select case
        when age <= 7 * 86400 then 'hot' when age <= 30 * 86400 then 'warm' else 'cold' end as tier
        from (select epoch(timestamp '2024-02-01 00:00:00') - floor(epoch(event_ts)) as age from landing)) group by tier""",
    "stored_retention": """select event_id, event_ts from landing
        where event_ts >= timestamp '2024-02-01 00:00:00' - interval 7 days""",
    "stored_tiers": """select event_date, count(*) as events, case
            when event_date >= date '2024-02-01' - 7 then 'hot' when event_date >= date '2024-02-01' - 30 then 'warm'
            else 'cold' end as tier from landing group by all""",
    "dq_not_null": _row_checks("not_null"),
    "dq_not_empty": _row_checks("not_empty"),
    "dq_non_negative": _row_checks("non_negative"),
    "dq_between_0_1": _row_checks("between_zero_and_one"),
    "dq_unique": "\nunion all\n".join(
        _key_check(relation, "unique", column)
        for relation, column in {
            "dim_customer_tenant": "tenant_id", "dim_customer_event_type": "event_type", "customer_tenant": "tenant_id",
            "event_type": "event_type", "internal_mail_tracking": "message_id", "fct_mail_lifecycle": "event_id",
            "dim_tenant": "tenant_id", "dim_provider": "provider_id",
        }.items()
    ),
    "dq_unique_combo": "\nunion all\n".join(
        _key_check(relation, "unique_combination", columns)
        for relation, columns in {
            "landing_events": "event_id", "fct_daily_customer_delivery": "tenant_id, event_date",
            "campaign_performance": "tenant_id, campaign_id, event_date",
            "template_performance": "tenant_id, template_id, event_date",
        }.items()
    ),
    "dq_freshness": "\nunion all\n".join(
        (
            _fresh("landing_events", "event_ts", 7200, 21600),
            _fresh("dim_customer_tenant", "last_seen_at", 21600, 86400),
            _fresh("dim_customer_event_type", "last_seen_at", 21600, 86400),
            _fresh("fct_daily_customer_delivery", "event_date", 86400, 172800),
        )
    ),
    "contract_violations": _contract_sql(),
    "event_family": f"""select {_FAMILY_CASE} as event_family, {_STAGE_CASE} as lifecycle_stage, count(*) as events
        from (select event_type as t from normalized) group by all""",
    "audit_history": """select message_id, event_time, event_id, event_type, tenant_id, correlation_id, latest_status,
        failure_code from fact""",
    "message_state_as_of": """select * from (with asked as (select distinct message_id, unnest([d + interval 12 hour, d - interval 12 hour]) as as_of
            from (select message_id, date_trunc('day', event_time) as d from fact
                where message_id is not null and event_time is not null))
        select a.message_id, a.as_of, f.event_id, f.event_type, f.latest_status, f.failure_code, f.event_time as state_since
        from asked a left join fact f on f.message_id = a.message_id and trim(f.message_id) <> '' and f.event_time <= a.as_of
        qualify row_number() over (partition by a.message_id, a.as_of
            order by f.event_time desc nulls last, f.ingested_at desc nulls last, f.event_id desc nulls last) = 1)""",
    "stage_violations": f"""select * from (with staged as (select message_id, event_time, ingested_at, event_id, {_STAGE_CASE} as stage
            from (select *, event_type as t from fact)
            where coalesce(trim(message_id), '') <> '' and event_time is not null),
        steps as (select *, stage - lag(stage) over w as step, row_number() over w as n from staged where stage is not null
            window w as (partition by message_id order by event_time, ingested_at nulls first, event_id)),
        entries as (select message_id, string_agg(stage, '>' order by entered) as path, count(*) as stages
            from (select message_id, stage, min(n) as entered from steps group by all) group by message_id)
        select message_id, count(*) as staged_events, any_value(path) as path, count(*) filter (step = 1) as forward,
            count(*) filter (step > 1) as skipped, count(*) filter (step = 0) as repeated, count(*) filter (step < 0) as backward,
            cast(max(stage) - any_value(stages) as integer) as never_entered
        from steps join entries using (message_id) group by message_id
        having count(*) filter (step > 1 or step < 0) > 0)""",
    "failure_tracking": f"""select * from (select message_id, count(*) filter ({_FAILED}) as failures,
            count(*) filter ({_RETRIED}) as retries, count(*) filter (event_type = 'mail.retry_exhausted') as exhausted,
            count(failure_code) as failure_codes, min(event_time) filter ({_FAILED}) as first_failure_at,
            max(event_time) filter ({_FAILED}) as last_failure_at
        from fact where coalesce(trim(message_id), '') <> '' group by message_id)
        where failures > 0 or retries > 0 or exhausted > 0""",
    "provider_sla": """select provider_id, count(*) as deliveries, min(latency_seconds) as fastest_seconds,
        max(latency_seconds) as slowest_seconds, cast(sum(latency_seconds) as double) / count(*) as mean_seconds,
        count(*) filter (latency_seconds > 3600) as breaches,
        cast(count(*) filter (latency_seconds <= 3600) as double) / count(*) as within_target_rate
        from latency group by provider_id""",
    "provider_latency_percentiles": """select provider_id, quantile_disc(latency_seconds, 0.5) as p50_seconds,
        quantile_disc(latency_seconds, 0.95) as p95_seconds, quantile_disc(latency_seconds, 0.99) as p99_seconds
        from latency group by provider_id""",
    "backlog": """select tenant_id, count(*) as open_messages, min(opened_at) as oldest_opened_at,
        cast(1706745600 - floor(epoch(min(opened_at))) as bigint) as oldest_age_seconds
        from (select message_id, max(tenant_id) as tenant_id, min(event_time) as opened_at,
                bool_or(event_type in ('mail.delivered', 'mail.bounced', 'mail.dropped', 'mail.rejected')) as closed
            from fact where coalesce(trim(message_id), '') <> '' group by message_id)
        where not closed group by tenant_id""",
    "engagement_rollup": f"""select tenant_id, campaign_id, level, requested_count, dispatched_count, delivered_count,
        opened_count, clicked_count, {_RATES} from (select tenant_id, campaign_id,
            cast(grouping(tenant_id, campaign_id) as integer) as level,
            cast(sum(requested_count) as bigint) as requested_count, cast(sum(dispatched_count) as bigint) as dispatched_count,
            cast(sum(delivered_count) as bigint) as delivered_count, cast(sum(opened_count) as bigint) as opened_count,
            cast(sum(clicked_count) as bigint) as clicked_count
        from campaign_days group by rollup (tenant_id, campaign_id))""",
    "campaign_trend": """select tenant_id, campaign_id, event_date, delivered_count, opened_count,
        delivered_count - lag(delivered_count) over w as delivered_change,
        opened_count - lag(opened_count) over w as opened_change
        from campaign_days window w as (partition by tenant_id, campaign_id order by event_date)""",
    "tenant_kpis": f"""select *, {_rate('rolling_opened_count', 'rolling_delivered_count', 'rolling_open_rate')},
        {_rate('rolling_delivered_count', 'rolling_requested_count', 'rolling_success_rate')}
        from (select *, cast(sum(requested_count) over w as bigint) as rolling_requested_count,
            cast(sum(delivered_count) over w as bigint) as rolling_delivered_count,
            cast(sum(opened_count) over w as bigint) as rolling_opened_count from daily
            window w as (partition by tenant_id order by event_date range between interval 6 days preceding and current row))""",
    "tenant_cohorts": """select cohort_week, cast(date_diff('day', cohort_week, week) // 7 as integer) as weeks_later,
        count(*) as active_tenants from (select distinct tenant_id, cast(date_trunc('week', event_date) as date) as week,
            cast(min(date_trunc('week', event_date)) over (partition by tenant_id) as date) as cohort_week from daily)
        group by all""",
    "date_dimension": """select date_day, cast(year(date_day) as integer) as year, cast(quarter(date_day) as integer) as quarter,
        cast(month(date_day) as integer) as month, cast(day(date_day) as integer) as day,
        cast(isodow(date_day) - 1 as integer) as weekday, cast(weekofyear(date_day) as integer) as week,
        isodow(date_day) >= 6 as is_weekend
        from (select cast(unnest(generate_series(min(event_date), max(event_date), interval 1 day)) as date) as date_day
            from landing)""",
    "workflow_dimension": """select correlation_id, min(event_ts) as started_at, max(event_ts) as last_event_at,
        count(*) as events, count(*) filter (event_type = 'mail.delivered') as deliveries
        from landing where correlation_id is not null group by correlation_id""",
    "tenant_slice": "select * from daily_metrics where tenant_id = 'tenant-7'",
    "lag_events": f"""select topic, partition, "offset", event_id, 'pipeline.lag_detected' as event_type, lag_seconds
        from (select *, cast(floor(epoch("timestamp")) - floor(epoch({_time('event_time')})) as bigint) as lag_seconds
            from parsed where not corrupt) where lag_seconds > 60""",
    "offset_gaps": """select topic, partition, previous + 1 as first_missing, "offset" - 1 as last_missing,
        "offset" - previous - 1 as missing, 'connector.cdc_gap_detected' as event_type
        from (select topic, partition, "offset", lag("offset") over (partition by topic, partition order by "offset") as previous
            from changes) where "offset" > previous + 1""",
}

_LANDED = "(select * from decoded group by all)"
QUERIES |= {
    "layer_campaign_performance": QUERIES["campaign_performance"],
    "layer_template_performance": QUERIES["template_performance"],
    "layer_delivery_summary": QUERIES["customer_delivery_summary"],
    "layer_internal_mail_tracking": QUERIES["internal_mail_tracking"],
    "layer_fct_mail_lifecycle": QUERIES["fct_mail_lifecycle"],
    "layer_dim_tenant": QUERIES["dim_tenant"],
    "layer_dim_provider": QUERIES["dim_provider"],
    "stream_land_events": f"select {_ENVELOPE}, event_ts, ingested_ts, event_date from decoded group by all",
    "stream_dead_letters": QUERIES["dead_letter_docs"],
    "stream_dim_tenant": f"select tenant_id, {_SEEN} from {_LANDED} where tenant_id is not null group by tenant_id",
    "stream_dim_event_type": f"select event_type, {_SEEN} from {_LANDED} where event_type is not null group by event_type",
    "stream_daily_fact": f"""select tenant_id, event_date, {_counts()} from {_LANDED}
        where tenant_id is not null and event_date is not null group by all""",
    "stream_route_customer": QUERIES["route_customer"],
    "stream_route_health": f"select value from {_ROUTED} where no_message",
    "stream_land_two_sources": f"select {_ENVELOPE}, event_ts, ingested_ts, event_date from decoded group by all",
    "stream_internal_topic": f"""select message_id as key, message_id, event_id from {_ROUTED} where not no_message
        union all select message_id, message_id, event_id from enriched""",
    "stream_dedup": "select event_id, event_type, event_ts from decoded group by all",
    "stream_volume_over_time": """select time_bucket(interval 1 hour, event_ts) as bucket_start, count(*) as events
        from decoded where event_ts is not null group by 1""",
    "stream_offset_gaps": QUERIES["offset_gaps"],
    "stream_internal_tracking": QUERIES["internal_mail_tracking"],
}


def oracle_sql() -> dict[str, str]:
    return {name: _with(body) for name, body in QUERIES.items()}
