"""Validation of raw records against the event contracts."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from letterlake.operators.decode import COORDINATES


@dataclass(frozen=True)
class Rule:
    """What one JSON field must be."""

    kind: str = "string"
    required: bool = True
    nullable: bool = False
    values: tuple[str, ...] = ()
    pattern: str | None = None
    date_time: bool = False
    minimum: int | None = None


TEXT = Rule()
TIME = Rule(date_time=True)
OPTIONAL_TEXT = Rule(required=False, nullable=True)

# The contracts of the envelope and of each event type's payload.
ENVELOPE_CONTRACT = {
    "event_id": TEXT,
    "event_type": TEXT,
    "event_version": Rule(pattern=r"\A[0-9]+\.[0-9]+\.[0-9]+\z"),
    "event_time": TIME,
    "ingested_at": TIME,
    "source_system": TEXT,
    "tenant_id": OPTIONAL_TEXT,
    "message_id": TEXT,
    "correlation_id": TEXT,
    "trace_id": OPTIONAL_TEXT,
    "actor_type": Rule(
        required=False,
        nullable=True,
        values=("user", "system", "scheduler", "provider", "service"),
    ),
    "payload": Rule(kind="object"),
}

PAYLOAD_CONTRACTS = {
    "mail.requested": {
        "recipient": TEXT,
        "channel": Rule(values=("email", "postal_mail", "sms")),
        "template_id": TEXT,
        "campaign_id": OPTIONAL_TEXT,
        "requested_by": TEXT,
        "priority": Rule(required=False, values=("low", "normal", "high")),
    },
    "mail.delivered": {
        "provider": TEXT,
        "provider_message_id": TEXT,
        "delivery_status": Rule(values=("delivered",)),
        "delivered_at": Rule(required=False, date_time=True),
        "provider_latency_ms": Rule(kind="integer", required=False, nullable=True, minimum=0),
    },
    "mail.operational.status_changed": {
        "status": TEXT,
        "mailbox_id": TEXT,
        "processing_stage": TEXT,
        "error_code": OPTIONAL_TEXT,
        "error_message": OPTIONAL_TEXT,
        "provider": OPTIONAL_TEXT,
        "updated_at": TIME,
    },
    "pipeline.job_failed": {
        "job_name": TEXT,
        "job_type": Rule(values=("flink", "airflow", "dbt", "connector")),
        "failure_reason": TEXT,
        "failed_at": TIME,
        "recoverable": Rule(kind="boolean", required=False),
    },
}

_VARIANT_KINDS = {"string": "STRING", "integer": "BIGINT", "boolean": "BOOLEAN", "object": "OBJECT"}

# Fixed value: a date-time of the schema language (RFC 3339): date, time and offset are all there.
_DATE_TIME = (
    r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}[Tt ][0-9]{2}:[0-9]{2}:[0-9]{2}(?:\.[0-9]+)?(?:[Zz]|[+-][0-9]{2}:[0-9]{2})\z"
)

ENVELOPE = "envelope"
_DOCUMENT = "map<string, variant>"


def _rule_table() -> Column:
    """All rules as one constant map, by scope and field."""

    def entry(scope: str, field: str, rule: Rule) -> list[Column]:
        return [
            F.lit(f"{scope}/{field}"),
            F.struct(
                F.lit(_VARIANT_KINDS[rule.kind]).alias("kind"),
                F.lit(rule.nullable).alias("nullable"),
                F.array(*[F.lit(value) for value in rule.values]).cast("array<string>").alias("values"),
                F.lit(rule.pattern).cast("string").alias("pattern"),
                F.lit(rule.date_time).alias("date_time"),
                F.lit(rule.minimum).cast("bigint").alias("minimum"),
            ),
        ]

    scopes = {ENVELOPE: ENVELOPE_CONTRACT, **PAYLOAD_CONTRACTS}
    return F.create_map(
        *[
            part
            for scope, contract in scopes.items()
            for field, rule in contract.items()
            for part in entry(scope, field, rule)
        ]
    )


def _required(contract: Mapping[str, Rule]) -> Column:
    return F.array(*[F.lit(field) for field, rule in contract.items() if rule.required])


def _fields(scope: Column, object_fields: Column, required: Column) -> Column:
    """The fields of an object, and those it must have but lacks (with a NULL node)."""
    present = F.transform(
        F.map_entries(object_fields),
        lambda e: F.struct(scope.alias("scope"), e["key"].alias("field"), e["value"].alias("node")),
    )
    absent = F.transform(
        F.array_except(required, F.map_keys(object_fields)),
        lambda field: F.struct(
            scope.alias("scope"), field.alias("field"), F.lit(None).cast("variant").alias("node")
        ),
    )
    return F.concat(present, absent)


def _field_violation() -> Column:
    """How one field (columns scope, field, node, rule, kind, text) breaks its rule; NULL if it does not.

    Beyond presence and type a rule sets at most one further condition, so one case is enough.
    """
    rule, kind, text = F.col("rule"), F.col("kind"), F.col("text")
    label = F.when(F.col("scope") == ENVELOPE, F.col("field")).otherwise(
        F.concat(F.lit("payload."), "field")
    )

    def named(name: str) -> Column:
        return F.concat(F.lit(f"{name}:"), label)

    void = kind == "VOID"
    # 12.0 is an integer too.
    number = F.when(F.rlike(kind, F.lit("^(DECIMAL|DOUBLE|FLOAT)")), text.try_cast("double"))
    whole = (rule["kind"] == "BIGINT") & F.coalesce(number == F.floor(number), F.lit(False))
    return (
        F.when(F.col("scope").isNull(), F.lit("not_json_object"))
        .when(rule.isNull(), named("extra"))
        .when(F.col("node").isNull(), named("missing"))
        .when(void & rule["nullable"], F.lit(None))
        .when(~kind.startswith(rule["kind"]) & ~whole, named("type"))
        .when((F.size(rule["values"]) > 0) & ~F.array_contains(rule["values"], text), named("value"))
        .when(rule["pattern"].isNotNull() & ~F.rlike(text, rule["pattern"]), named("pattern"))
        .when(
            rule["date_time"]
            & ~(F.rlike(text, F.lit(_DATE_TIME)) & F.try_to_timestamp(F.translate(text, "tz", "TZ")).isNotNull()),
            named("format"),
        )
        .when(
            rule["minimum"].isNotNull() & (text.try_cast("double") < rule["minimum"]), named("minimum")
        )
    )


def contract_violations(topic: DataFrame) -> DataFrame:
    """One row per violation of a record with a value.

    Each record is taken apart into its fields once; a field finds its rule in a constant table, so
    the plan holds one set of checks however many contracts there are.
    """
    records = topic.where(F.col("value").isNotNull()).select(
        *COORDINATES, F.explode(F.array(F.from_json("value", _DOCUMENT))).alias("document")
    )
    at = ["topic", "partition", "offset"]
    text = {
        name: F.try_variant_get(F.col("document")[name], "$", "string").alias(name)
        for name in ("event_id", "event_type")
    }
    read = records.select(
        *at,
        *text.values(),
        "document",
        F.try_variant_get(F.col("document")["payload"], "$", _DOCUMENT).alias("payload"),
    )
    required = F.lit(None).cast("array<string>")
    for event_type, contract in PAYLOAD_CONTRACTS.items():
        required = F.when(F.col("event_type") == event_type, _required(contract)).otherwise(required)
    in_envelope = _fields(F.lit(ENVELOPE), F.col("document"), _required(ENVELOPE_CONTRACT))
    # NULL for an unknown type or a payload that is no object: nothing to check there.
    in_payload = F.when(required.isNotNull(), _fields(F.col("event_type"), F.col("payload"), required))
    # A record that is no JSON object stands as one field without a scope.
    unreadable = F.array(F.struct(*[F.lit(None).alias(name) for name in ("scope", "field", "node")]))
    fields = read.select(
        *at,
        "event_id",
        "event_type",
        F.inline(
            F.when(F.col("document").isNull(), unreadable.cast(_FIELDS)).otherwise(
                F.concat(in_envelope, F.coalesce(in_payload, F.array().cast(_FIELDS)))
            )
        ),
    )
    rule = F.try_element_at(_rule_table(), F.concat_ws("/", "scope", "field"))
    kind = F.schema_of_variant("node")
    text = F.try_variant_get("node", "$", "string")
    checked = F.struct(rule.alias("rule"), kind.alias("kind"), text.alias("text"))
    ruled = fields.select("*", F.inline(F.array(checked)))
    return ruled.select(
        *at, "event_id", "event_type", _field_violation().alias("violation")
    ).where(F.col("violation").isNotNull())


_FIELDS = "array<struct<scope: string, field: string, node: variant>>"
