"""Test inputs: the driver's tables retold as mail events, change records and topics.

Each input covers its whole table. Irregular records (malformed text, blank identifiers, missing
fields, redeliveries) are sprinkled over it by fixed rules on the row's number.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from letterlake.schemas import LANDING
from letterlake.session import scratch_path
from letterlake.sources.topics import CHANGES, OPERATIONAL, RAW, Topic

# The clock of every job run on the inputs.
PROCESSING_TIME = "2024-02-01 00:00:00"
# Rows that one task makes records of.
TASK_ROWS = 50_000


_STORED: dict[tuple[str, str, str], str] = {}


def stored(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Writes an input once per session to the shared folder, as the topic or table it stands for.

    The queries then start where a job starts, at stored records.
    """

    @functools.wraps(build)
    def read(spark: SparkSession, sf_dir: str) -> DataFrame:
        key = (spark.sparkContext.applicationId, sf_dir, build.__name__)
        if key not in _STORED:
            path = scratch_path(spark, build.__name__)
            build(spark, sf_dir).write.parquet(path)
            _STORED[key] = path
        return spark.read.parquet(_STORED[key])

    return read


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame, key: str) -> DataFrame:
    """A table's rows dealt by key over as many tasks as their number needs, each of which writes one file.

    The files and row groups of the table may be few and large. The rows move while they are narrow,
    before records are made of them.
    """
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // TASK_ROWS))
    return rows.repartition(tasks, key)


def _every(n: int, number: str = "i") -> Column:
    return F.expr(f"{number} % {n} = 0")


def _numbered_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    # Number of the event (i), of its message (m), and a spread value 0..99 (k).
    return spread(events.select("event_id", "ts", "event_type", "props"), "event_id").select(
        F.col("event_id").alias("i"),
        F.expr("event_id div 4").alias("m"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        "ts",
        F.col("event_type").alias("kind"),
    )


_MAIL_TYPE = """
    case kind when 'signup' then 'mail.requested' when 'purchase' then 'mail.delivered'
              when 'view' then 'mail.opened' when 'click' then 'mail.clicked'
              else if(k % 2 = 0, 'mail.dispatched', 'mail.bounced') end
"""

_TENANT = "if(i % 61 = 0, null, concat('tenant-', m % 80))"

_MESSAGE = """
    case when i % 53 = 0 then '' when i % 59 = 0 then '  ' when i % 67 = 0 then null
         else concat('msg-', m) end
"""

_PAYLOAD = """
    case when i % 71 = 0 then 'not-json'
         when m % 9 = 0 then '{}'
         when i % 2 = 0 then concat(
            '{"campaign_id":"cmp-', m % 12, '","template_id":"tpl-', m % 8,
            if(k >= 50, concat('","template_name":"Template ', m % 8), ''),
            '","provider":"prov-', m % 5, '"',
            if(k % 3 = 0, ',"status":"accepted"', ''),
            if(kind = 'error', concat(',"error_code":"E', k % 5, '"'), ''), '}')
         else concat(
            '{"campaign":{"id":"cmp-', m % 12, '","name":"Name cmp-', m % 12,
            '"},"template":{"id":"tpl-', m % 8, '","channel":"',
            case k % 3 when 0 then 'email' when 1 then 'sms' else 'postal_mail' end,
            '"},"delivery":{"provider":"prov-', m % 5, '","status":',
            if(k % 4 = 0, 'null', '"sent"'), '},"attempt":', k % 4, '}') end
"""


@stored
def landing_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landing table: 15 columns, one row per event."""
    rows = _numbered_events(spark, sf_dir).selectExpr(
        "concat('evt-', i) as event_id",
        f"if(i % 7 = 0, upper({_MAIL_TYPE}), {_MAIL_TYPE}) as event_type",
        "'1.0.0' as event_version",
        "if(i % 2 = 0, date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSS'Z'\"),"
        " cast(unix_millis(cast(ts as timestamp)) as string)) as event_time",
        "date_format(ts + interval 20 seconds, \"yyyy-MM-dd'T'HH:mm:ss.SSS'Z'\") as ingested_at",
        "'mail.pipeline' as source_system",
        f"{_TENANT} as tenant_id",
        f"{_MESSAGE} as message_id",
        "concat('corr-', m) as correlation_id",
        "concat('trace-', i) as trace_id",
        "'service' as actor_type",
        f"{_PAYLOAD} as payload",
        "ts as event_ts",
        "ts + interval 20 seconds as ingested_ts",
        "to_date(ts) as event_date",
    )
    return rows.select(*LANDING.fieldNames())


def _json_text(expression: str) -> str:
    """SQL for a JSON string or null; the text holds no character that needs escaping but quotes."""
    return f"""coalesce(concat('"', replace({expression}, '"', '\\\\"'), '"'), 'null')"""


def _topic(rows: DataFrame, topic: Topic, value: str, number: str = "i") -> DataFrame:
    """Records of a topic; one in 79 is delivered a second time with a later offset."""
    copies = F.explode(F.when(_every(79, number), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.withColumn("copy", copies).select(
        F.lit(None).cast("string").alias("key"),
        F.expr(value).alias("value"),
        F.lit(topic.name).alias("topic"),
        F.expr(f"cast({number} % {topic.partitions} as int)").alias("partition"),
        F.expr(f"{number} div {topic.partitions} + copy * 1000000000000").alias("offset"),
        F.expr("cast(ts + make_interval(0, 0, 0, 0, 0, 0, 21 + copy * 60) as timestamp)").alias("timestamp"),
    )


@stored
def lifecycle_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw lifecycle records as text, with malformed, truncated, empty and redelivered ones."""
    rows = _numbered_events(spark, sf_dir).selectExpr(
        "*",
        f"if(i % 7 = 0, upper({_MAIL_TYPE}), {_MAIL_TYPE}) as event_type",
        f"{_TENANT} as tenant_id",
        f"{_MESSAGE} as message_id",
        f"{_PAYLOAD} as payload",
        "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSS'Z'\") as iso",
        "date_format(ts + interval 20 seconds, \"yyyy-MM-dd'T'HH:mm:ss.SSS'Z'\") as ingested_iso",
        "cast(unix_millis(cast(ts as timestamp)) as string) as millis",
    )
    value = f"""
        case when i % 101 = 0 then concat('MALFORMED_NON_JSON_', i)
             when i % 103 = 0 then null
             when i % 107 = 0 then concat('{{"event_id":"evt-', i, '","event_type":')
             when i % 109 = 0 then '["not","an","object"]'
             else concat(
                '{{"event_id":', if(i % 113 = 0, 'null', concat('"evt-', i, '"')),
                ',"event_type":"', event_type, '","event_version":"1.0.0","event_time":',
                if(i % 2 = 0, concat('"', iso, '"'), millis),
                ',"ingested_at":"', ingested_iso, '","source_system":"mail.pipeline","tenant_id":',
                {_json_text('tenant_id')}, ',"message_id":', {_json_text('message_id')},
                ',"correlation_id":', if(i % 43 = 0, 'null', concat('"corr-', m, '"')),
                ',"trace_id":"trace-', i, '","actor_type":"service",',
                case when payload = 'not-json' then '"payload":"not-json"'
                     when i % 5 = 0 then concat('"payload_json":', {_json_text('payload')})
                     else concat('"payload":', payload) end, '}}') end
    """
    return _topic(rows, RAW, value)


@stored
def operational_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operational status records as text, fields at the root or in the payload."""
    rows = _numbered_events(spark, sf_dir).selectExpr(
        "*",
        f"{_TENANT} as tenant_id",
        f"{_MESSAGE} as message_id",
        "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSS'Z'\") as iso",
        "cast(unix_millis(cast(ts as timestamp)) as string) as millis",
        "case k % 5 when 0 then 'queued' when 1 then 'processing' when 2 then 'delivered'"
        " when 3 then 'failed' else 'retrying' end as status",
        "case k % 4 when 0 then 'intake' when 1 then 'routing' when 2 then 'dispatch'"
        " else 'delivery' end as stage",
    ).selectExpr(
        "*",
        """concat(
            '"status":"', if(i % 23 = 0, '', status), '","mailbox_id":"mbx-', m % 50,
            '","processing_stage":"', stage, '","provider":',
            if(k % 10 = 0, 'null', concat('"prov-', m % 5, '"')),
            if(status = 'failed', concat(',"error_code":"E', k % 6, '","error_message":"failure ', k % 6, '"'), '')
        ) as fields""",
    ).selectExpr(
        "*",
        "case when i % 7 = 0 then '{}' else concat('{', fields, ',\"attempt\":', k % 4, '}') end as details",
    )
    value = f"""
        case when i % 101 = 0 then concat('MALFORMED_NON_JSON_', i)
             else concat(
                '{{', if(i % 47 = 0, '', concat('"event_id":"ops-', i, '",')),
                if(i % 3 = 0, '', concat('"event_type":"mail.operational.', status,
                   '","event_version":"1.1.0","source_system":"mailroom",')),
                '"tenant_id":', {_json_text('tenant_id')}, ',"message_id":', {_json_text('message_id')},
                if(i % 4 = 0, '', concat(',"correlation_id":"corr-', m, '"')),
                case when i % 19 = 0 then '' when i % 17 = 0 then concat(',"event_time":"', iso, '"')
                     else concat(',"event_time":', millis) end,
                if(i % 3 = 0, '', concat(',', fields)),
                ',"payload_json":',
                case when i % 41 = 0 then '"{{broken"'
                     when i % 5 = 0 then details
                     else {_json_text('details')} end, '}}') end
    """
    return _topic(rows, OPERATIONAL, value)


def _numbered_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    columns = ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
    return spread(orders.select(*columns), "o_orderkey").select(
        F.col("o_orderkey").alias("i"),
        F.expr("o_custkey % 80").alias("t"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderdate").alias("ts"),
        F.expr("cast(unix_millis(cast(o_orderdate as timestamp)) as string)").alias("millis"),
    )


@stored
def change_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Database change records as text, one per order."""
    rows = _numbered_orders(spark, sf_dir).selectExpr(
        "*",
        "case when i % 13 < 7 then 'c' when i % 13 < 12 then 'u' else 'd' end as op",
        """concat(
            '{"message_id":"', if(i % 79 = 0, ' ', concat('msg-', i)),
            '","tenant_id":"', if(i % 71 = 0, '', concat('tenant-', t)),
            '","trace_id":"trace-', i, '","status":"', status, '","priority":"', priority,
            '","created_at":', millis, ',"updated_at":', millis, '}') as image""",
    )
    value = """
        case when i % 97 = 0 then concat('not a change record ', i)
             when i % 89 = 0 then '{"payload":null}'
             else concat(
                '{"payload":{', if(i % 73 = 0, '', concat('"op":"', if(i % 61 = 0, 'x', op), '",')),
                if(i % 53 = 0, '', concat('"ts_ms":', millis, ',')), '"source":{',
                if(i % 67 = 0, '', '"db":"mail",'), '"schema":"public"',
                if(i % 59 = 0, '', concat(',"txId":"tx-', i, '"')),
                if(i % 43 = 0, '', ',"table":"mail_events"'), '},"before":',
                if(op = 'd' and i % 83 <> 0, image, 'null'), ',"after":',
                if(op = 'd' or i % 83 = 0, 'null', image), '}}') end
    """
    return _topic(rows, CHANGES, value)


@stored
def attribute_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key-value store stream batches as text: a new image and a removal per order."""
    rows = _numbered_orders(spark, sf_dir).selectExpr(
        "*",
        "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss'Z'\") as iso",
    )
    value = """
        concat('{"Records":[{"eventID":"e-', i, '","eventName":"MODIFY","dynamodb":{"Keys":{"id":{"S":"',
            i, '"}}', if(i % 11 = 0, '', concat(
            ',"NewImage":{',
            case when i % 13 = 0 then concat('"mail_id":{"S":"mail-', i, '"}')
                 when i % 17 = 0 then '"message_id":{"S":""}'
                 else concat('"message_id":{"S":"msg-', i, '"}') end,
            if(i % 3 = 0, '', concat(',"correlation_id":{"S":"corr-', i, '"}')),
            ',"tenant_id":{"S":"tenant-', t, '"}',
            case when i % 19 = 0 then ',"status":{"NULL":true}' when i % 29 = 0 then ''
                 else concat(',"status":{"S":"', status, '"}') end,
            ',"mailbox_id":{"N":"', i % 50, '"}',
            if(i % 31 = 0, '', concat(',"processing_stage":{"S":"', priority, '"}')),
            ',"error_code":{"NULL":true}',
            if(i % 7 = 0, ',"error_message":{"S":"late"}', ''),
            if(i % 5 = 0, '', concat(',"provider":{"S":"prov-', i % 5, '"}')),
            case when i % 23 = 0 then '' when i % 2 = 0 then concat(',"updated_at":{"S":"', iso, '"}')
                 else concat(',"last_updated_at":{"S":"', iso, '"}') end,
            ',"attempts":{"N":"', 2 - i % 5, '"},"flagged":{"BOOL":', if(i % 2 = 0, 'true', 'false'),
            '},"details":{"M":{"region":{"S":"r-', t % 4, '"},"size":{"N":"', i % 9,
            '"},"tags":{"L":[{"S":"a', i % 3, '"},{"N":"', i % 4, '"}]}}}}')),
            '}},{"eventID":"x-', i, '","eventName":"REMOVE","dynamodb":{"Keys":{"id":{"S":"', i, '"}}}}]}')
    """
    return _topic(rows, OPERATIONAL, value)


@stored
def contract_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of all four contracted types, some breaking their contract."""
    rows = _numbered_events(spark, sf_dir).selectExpr(
        "*",
        "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSS'Z'\") as iso",
        """case k % 4 when 0 then 'mail.requested' when 1 then 'mail.delivered'
                when 2 then 'mail.operational.status_changed' else 'pipeline.job_failed' end as event_type""",
    ).selectExpr(
        "*",
        """case k % 4
            when 0 then concat('{"recipient":"r', m, '","channel":"', if(i % 11 = 0, 'fax', 'email'), '"',
                if(i % 13 = 0, '', concat(',"template_id":"tpl-', m % 8, '"')),
                ',"campaign_id":', if(i % 3 = 0, 'null', '"cmp-1"'), ',"requested_by":"u1"',
                if(i % 17 = 0, ',"priority":"urgent"', ',"priority":"high"'), '}')
            when 1 then concat('{"provider":"prov-', m % 5, '"',
                if(i % 11 = 0, '', concat(',"provider_message_id":"pm-', i, '"')),
                ',"delivery_status":"', if(i % 13 = 0, 'late', 'delivered'),
                '","provider_latency_ms":', case when i % 17 = 0 then '-5' when i % 19 = 0 then '"12"'
                    when i % 5 = 0 then 'null' else cast(k as string) end, '}')
            when 2 then concat('{"status":"s","mailbox_id":', if(i % 11 = 0, '7', '"mbx"'),
                ',"processing_stage":"intake","error_code":null,"updated_at":"', if(i % 13 = 0, 'yesterday', iso),
                '"', if(i % 17 = 0, ',"shard":3', ''), '}')
            else concat('{"job_name":"j","job_type":"', if(i % 11 = 0, 'cron', 'dbt'),
                '","failure_reason":"timeout","failed_at":"', iso, '"',
                if(i % 13 = 0, ',"recoverable":"yes"', ',"recoverable":true'), '}') end as payload""",
    )
    value = """
        concat('{"event_id":', if(i % 29 = 0, concat('', i), concat('"evt-', i, '"')),
            ',"event_type":"', event_type, '"',
            if(i % 31 = 0, '', concat(',"event_version":"', if(i % 37 = 0, '1.0', '1.0.0'), '"')),
            ',"event_time":"', if(i % 41 = 0, 'soon', iso), '","ingested_at":"', iso,
            '","source_system":"mail.pipeline","tenant_id":', if(i % 61 = 0, 'null', '"tenant-1"'),
            if(i % 67 = 0, '', concat(',"message_id":"msg-', m, '"')), ',"correlation_id":"corr-', m,
            '","actor_type":"', if(i % 43 = 0, 'robot', 'service'), '"',
            if(i % 47 = 0, ',"shard":1', ''), ',"payload":', if(i % 53 = 0, '"text"', payload), '}')
    """
    return _topic(rows, RAW, value)


