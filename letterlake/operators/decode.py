"""From topic records to canonical events, and what cannot become one."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from letterlake.functions.clock import event_timestamp, ntz
from letterlake.functions.text import CORRUPT, is_blank, parse_object
from letterlake.schemas import ENVELOPE_FIELDS, strings

COORDINATES = ("topic", "partition", "offset", "timestamp")

# Some producers call the payload field payload_json.
_WIRE = strings(*ENVELOPE_FIELDS, "payload_json")


def parse_envelopes(topic: DataFrame) -> DataFrame:
    """Coordinates, raw value and the envelope fields; records without a value are skipped."""
    records = topic.where(F.col("value").isNotNull())
    parsed = parse_object(records, "value", _WIRE, [*COORDINATES, "value"])
    return parsed.withColumn("payload", F.coalesce("payload", "payload_json")).drop("payload_json")


def rejection() -> Column:
    """Why a parsed record cannot land; NULL for a good one."""
    return F.when(F.col(CORRUPT).isNotNull(), F.lit("not_json_object")).when(
        F.col("event_id").isNull(), F.lit("missing_event_id")
    )


def with_times(envelopes: DataFrame) -> DataFrame:
    event_ts = event_timestamp(F.col("event_time"))
    return envelopes.withColumns(
        {
            "event_ts": event_ts,
            "ingested_ts": event_timestamp(F.col("ingested_at")),
            "event_date": F.to_date(event_ts),
        }
    )


def landing_rows(parsed: DataFrame) -> DataFrame:
    """The 15 landing columns of the good records; times stay TIMESTAMP, as watermarks need them."""
    good = parsed.where(rejection().isNull()).select(*ENVELOPE_FIELDS)
    return with_times(good)


def decode_envelope(topic: DataFrame) -> DataFrame:
    return landing_rows(parse_envelopes(topic))


def utc_wall_clock(df: DataFrame) -> DataFrame:
    """TIMESTAMP columns as TIMESTAMP_NTZ, the type of stored and compared results."""
    zoned = [name for name, kind in df.dtypes if kind == "timestamp"]
    return df.withColumns({name: ntz(F.col(name)) for name in zoned}) if zoned else df


def dead_letters(parsed: DataFrame, reason: Column | None = None) -> DataFrame:
    """Rejected records as dead-letter documents, with the reason beside the five mapped fields."""
    reason = rejection() if reason is None else reason
    return parsed.withColumn("reason", reason).where(F.col("reason").isNotNull()).select(
        F.col("value").alias("raw_payload"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
        "reason",
    )


def split_dead_letters(topic: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(landing rows, dead letters); every record with a value is in exactly one of them."""
    parsed = parse_envelopes(topic)
    return landing_rows(parsed), dead_letters(parsed)


# A token: letters, digits and underscores, also around single inner dots and apostrophes.
_TOKEN = r"[\p{L}\p{N}_]++(?:[.'’][\p{L}\p{N}_]++)*+"


def token_list(text: Column) -> Column:
    """The lower-case tokens of a text in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(_TOKEN), F.lit(0))


def _tokens(text: Column) -> Column:
    """The lower-case tokens of a text, each between spaces."""
    return F.concat(F.lit(" "), F.array_join(token_list(text), " "), F.lit(" "))


def search_dead_letters(documents: DataFrame, phrase: str) -> DataFrame:
    """Dead letters whose payload has the phrase's tokens one after the other, whatever the case.

    Whole tokens match: ``record_1`` does not find ``record_10``. A phrase without tokens finds nothing.
    """
    wanted = _tokens(F.lit(phrase))
    return documents.where((F.trim(wanted) != "") & F.contains(_tokens(F.col("raw_payload")), wanted))


# How a value can be written behind its field name: opening mark and content up to the closing one.
_VALUES = (
    ('"', r'(?s:[^"\\]++|\\.)*+'),
    (r'\\"', r'(?:\\\\\\"|\\[^"]|[^"\\]++)*+'),
    ("'", r"(?s:[^'\\]++|\\.)*+"),
    ("", r"""[^\s,{}\[\]"'\\][^\s,{}\[\]]*+"""),
)


def redact(documents: DataFrame, fields: tuple[str, ...], mask: str = "***") -> DataFrame:
    """Masks the scalar values of the named JSON fields in dead-letter payloads.

    Dead letters need not be JSON: quotes may be single, missing at the end or, in JSON kept as text
    inside JSON, escaped. Numbers, booleans and nulls are masked as well; objects and lists are kept,
    with the named fields in them masked.
    """
    names = "|".join(re.escape(name) for name in fields)
    text = F.col("raw_payload")
    for opening, content in _VALUES:
        pattern = rf"""(\\*["'](?:{names})\\*["']\s*:\s*{opening}){content}"""
        text = F.regexp_replace(text, pattern, rf"$1{mask}")
    return documents.withColumn("raw_payload", text)


def keyed(parsed: DataFrame, key: str, value: Column | str = "value") -> DataFrame:
    """(key, value) pairs for a keyed topic; a blank key publishes as NULL."""
    value = F.col(value) if isinstance(value, str) else value
    return parsed.select(F.when(~is_blank(F.col(key)), F.col(key)).alias("key"), value.alias("value"))
