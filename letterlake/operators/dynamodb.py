"""Key-value store change streams: typed attribute images to operational events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from letterlake.functions.clock import epoch_millis, instant, iso_text
from letterlake.functions.text import CORRUPT, empty_to_null, parse_object
from letterlake.operators.decode import COORDINATES
from letterlake.operators.routing import source_id
from letterlake.schemas import strings

# Attribute type tags, and the identity of operational events.
SCALAR_TAGS = ("S", "N", "BOOL")
OPERATIONAL_EVENT_TYPE = "mail.operational.status_changed"
OPERATIONAL_SOURCE = "dynamodb.mail_tracking"

ITEM = strings(
    "message_id",
    "mail_id",
    "correlation_id",
    "tenant_id",
    "trace_id",
    "status",
    "mailbox_id",
    "processing_stage",
    "error_code",
    "error_message",
    "provider",
    "updated_at",
    "last_updated_at",
)


_BATCH = T.StructType([T.StructField("Records", T.ArrayType(T.VariantType()))])


def parse_records(topic: DataFrame) -> DataFrame:
    """Coordinates, raw value and ``Records``; topic records without a value are skipped."""
    batches = topic.where(F.col("value").isNotNull())
    return parse_object(batches, "value", _BATCH, [*COORDINATES, "value"])


def rejection() -> Column:
    """Why a topic record holds no stream records; NULL for one that does."""
    return F.when(F.col(CORRUPT).isNotNull(), F.lit("not_json_object")).when(
        F.col("Records").isNull(), F.lit("no_records")
    )


def numbered_records(parsed: DataFrame) -> DataFrame:
    """One row per entry of ``Records``, numbered within its topic record; ``record`` is a variant."""
    return parsed.select(*COORDINATES, F.posexplode("Records").alias("record_no", "record"))


def stream_records(topic: DataFrame) -> DataFrame:
    return numbered_records(parse_records(topic))


def new_images(records: DataFrame) -> DataFrame:
    """The ``NewImage`` of each record; records without one (removals) and empty ones are skipped."""
    image = F.try_variant_get(F.col("record"), "$.dynamodb.NewImage", "variant")
    images = records.select(*COORDINATES, "record_no", F.explode(F.array(image)).alias("image"))
    attributes = F.try_variant_get(F.col("image"), "$", "map<string, variant>")
    return images.where(F.size(attributes) > 0)


def attribute(image: Column, path: str, kind: T.DataType) -> Column:
    """The tagged attribute at ``path`` of a variant as a value of the declared type.

    Text keeps the digits of a number. Maps and lists unfold by the declared struct and array
    types; an attribute under an unknown tag passes through as its JSON text.
    """
    if isinstance(kind, T.StructType):
        members = f"{path}.M"
        fields = [
            attribute(image, f"{members}.{field.name}", field.dataType).alias(field.name)
            for field in kind.fields
        ]
        return F.when(F.try_variant_get(image, members, "variant").isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType):
        items = F.try_variant_get(image, f"{path}.L", "array<variant>")
        return F.transform(items, lambda item: attribute(item, "$", kind.elementType))
    scalars = [F.try_variant_get(image, f"{path}.{tag}", "string") for tag in SCALAR_TAGS]
    is_null = F.try_variant_get(image, f"{path}.NULL", "boolean").isNotNull()
    value = F.coalesce(*scalars, F.when(~is_null, F.try_variant_get(image, path, "string")))
    return value if isinstance(kind, T.StringType) else value.try_cast(kind)


def _tags(image: Column, names: list[str]) -> Column:
    """The scalar tags of some attributes, read in one walk through the image."""
    kinds = ", ".join([*(f"{tag}: string" for tag in SCALAR_TAGS), "`NULL`: boolean"])
    fields = ", ".join(f"`{name}`: struct<{kinds}>" for name in names)
    return F.try_variant_get(image, "$", f"struct<{fields}>")


def unmarshal(images: DataFrame, schema: T.StructType, image: str = "image") -> DataFrame:
    """Adds a column per schema field, read from the attribute image."""
    texts = [field.name for field in schema.fields if isinstance(field.dataType, T.StringType)]
    tagged = images.select("*", F.explode(F.array(_tags(F.col(image), texts))).alias("_tags")) if texts else images

    def text(name: str) -> Column:
        tags = F.col("_tags").getField(name)
        other = F.try_variant_get(F.col(image), f"$.{name}", "string")
        return F.coalesce(*[tags.getField(tag) for tag in SCALAR_TAGS], F.when(tags.getField("NULL").isNull(), other))

    item = F.struct(
        *[
            (text(field.name) if field.name in texts else attribute(F.col(image), f"$.{field.name}", field.dataType)).alias(field.name)
            for field in schema.fields
        ]
    )
    return tagged.select(*images.columns, F.inline(F.array(item)))


def ddb_to_operational(topic: DataFrame, processing_time: str) -> DataFrame:
    return operational_events(stream_records(topic), processing_time)


def operational_events(records: DataFrame, processing_time: str) -> DataFrame:
    """Operational status events from the stream's new images, 18 columns."""
    items = unmarshal(new_images(records), ITEM)
    now = instant(processing_time)
    millis = epoch_millis(now)
    record = F.col("record_no").cast("string")
    message_id = F.coalesce(
        empty_to_null(F.col("message_id")),
        empty_to_null(F.col("mail_id")),
        F.concat_ws("-", source_id("gen-"), record),
    )

    def known(name: str) -> Column:
        return F.coalesce(name, F.lit("unknown"))

    updated_at = F.coalesce(
        empty_to_null(F.col("updated_at")), empty_to_null(F.col("last_updated_at")), iso_text(now)
    )
    payload = F.to_json(
        F.struct(
            known("status").alias("status"),
            known("mailbox_id").alias("mailbox_id"),
            known("processing_stage").alias("processing_stage"),
            "error_code",
            "error_message",
            "provider",
            updated_at.alias("updated_at"),
        ),
        {"ignoreNullFields": "false"},
    )
    return items.select(
        F.concat_ws("-", source_id("ddb-"), record).alias("event_id"),
        F.lit(OPERATIONAL_EVENT_TYPE).alias("event_type"),
        F.lit("1.0.0").alias("event_version"),
        millis.alias("event_time"),
        millis.alias("ingested_at"),
        F.lit(OPERATIONAL_SOURCE).alias("source_system"),
        "tenant_id",
        message_id.alias("message_id"),
        F.coalesce(empty_to_null(F.col("correlation_id")), message_id).alias("correlation_id"),
        "trace_id",
        F.lit("system").alias("actor_type"),
        known("status").alias("status"),
        known("mailbox_id").alias("mailbox_id"),
        known("processing_stage").alias("processing_stage"),
        "error_code",
        "error_message",
        "provider",
        payload.alias("payload_json"),
    )
