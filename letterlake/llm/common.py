"""What the operators share: stored intermediate tables and ASCII-only lower case."""

from __future__ import annotations

from functools import reduce
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from letterlake.session import scratch_path


def kept(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` written to the shared folder and read back.

    Cuts the lineage: a lost executor costs no earlier work, and values that depend on a partition's
    number are fixed from here on. As a scan, the result can also be split by a skewed join.
    """
    path = scratch_path(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(text: str | Column) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def whole_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, doc_id, text): each row whole in ``doc``, so that its columns clash with no inner name."""
    return docs.select(F.struct("*").alias("doc"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other letter as it is (``lower`` would change accented ones too)."""
    pairs = zip(ascii_uppercase, ascii_lowercase, strict=True)
    replaced = reduce(lambda value, pair: F.replace(value, F.lit(pair[0]), F.lit(pair[1])), pairs, text)
    # On a text of ASCII alone the two are the same, and lower is one pass.
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(replaced)
