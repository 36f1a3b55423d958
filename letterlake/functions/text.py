"""Column helpers for untrusted text and JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt"


def is_blank(column: Column) -> Column:
    """NULL, empty, or only whitespace of any script (not just the ASCII space)."""
    return column.isNull() | column.rlike(r"\A\p{javaWhitespace}*\z")


def blank_to_null(column: Column) -> Column:
    return F.when(~is_blank(column), column)


def empty_to_null(column: Column) -> Column:
    return F.nullif(column, F.lit(""))


def parse_object(df: DataFrame, source: str, schema: T.StructType, keep: list[Column | str]) -> DataFrame:
    """Adds the fields of the JSON object in ``source`` and a ``_corrupt`` column.

    The object is emitted through a one-element generator: Catalyst would copy ``from_json`` into
    every filter on a parsed field and parse each record again, but it pushes nothing below a
    generator. ``_corrupt`` holds the raw text when it is not a JSON object.
    """
    fields = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(F.col(source), fields, {"columnNameOfCorruptRecord": CORRUPT})
    return df.select(*keep, F.inline(F.array(parsed)))


def parse_variant(df: DataFrame, source: Column, name: str) -> DataFrame:
    """Adds ``name``: the JSON text as a variant, NULL when it does not parse; parsed once per row."""
    return df.select("*", F.explode(F.array(F.try_parse_json(source))).alias(name))


def variant_text(variant: str, *paths: str) -> Column:
    """Text of the first path that is present and not JSON null."""
    found = [F.try_variant_get(F.col(variant), f"$.{path}", "string") for path in paths]
    return found[0] if len(found) == 1 else F.coalesce(*found)
