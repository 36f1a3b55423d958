"""Exact deduplication by naming blocks.

Each normalised text is cut into blocks of a fixed number of bytes. The distinct blocks are sorted
and numbered, so a block's name stands for exactly one content. Adjacent names are then paired, the
distinct pairs sorted and numbered in turn, until each document has one name. Texts are equal when
their names are, without trust in any hash.

The blocks' texts cross the network once, already combined in the map tasks. Their occurrences look
up names by a 128-bit fingerprint; the dictionary is checked to hold one block per fingerprint, and
the naming starts again with another fingerprint if it does not.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from letterlake.llm.common import kept, table, text_or_empty, whole_rows

BLOCK_BYTES = 4096
# Bits below the level in a name: room for the partition number (25) and the row in it (33).
_NAME_BITS = 58

Fingerprint = Callable[[Column, int], Column]


def normal_text(text: str | Column) -> Column:
    """Every run of ASCII white space as one space; null as empty."""
    return F.regexp_replace(text_or_empty(text), r"[\x20\x09-\x0D]+", " ")


def fingerprint(block: Column, seed: int) -> Column:
    return F.struct(F.xxhash64(block, F.lit(2 * seed)).alias("a"), F.xxhash64(F.lit(2 * seed + 1), block).alias("b"))


def _blocks(text: Column, size: int) -> Column:
    data = text.cast("binary")
    count = F.greatest(F.ceil(F.octet_length(data) / size), F.lit(1))
    return F.transform(F.sequence(F.lit(0), count.cast("int") - 1), lambda i: F.substring(data, i * size + 1, F.lit(size)))


def _named(values: DataFrame, level: int) -> DataFrame:
    """The distinct rows of ``values``, numbered in sorted order within their hash partition."""
    order = values.distinct().sortWithinPartitions(*values.columns)
    return order.withColumn("name", F.shiftleft(F.lit(level).cast("bigint"), _NAME_BITS).bitwiseOR(F.monotonically_increasing_id()))


def _block_names(texts: DataFrame, size: int, make: Fingerprint) -> tuple[int, DataFrame]:
    """The first seed under which no two blocks share a fingerprint, and the names by fingerprint."""
    blocks = texts.select(F.explode(_blocks(F.col("normal"), size)).alias("block"))
    seed = 0
    while True:
        names = kept(_named(blocks, 0).select(make(F.col("block"), seed).alias("key"), "name"), "block-names")
        if names.groupBy("key").count().where("count > 1").isEmpty():
            return seed, names.select("key.*", "name")
        seed += 1


def document_names(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES, make: Fingerprint = fingerprint
) -> DataFrame:
    """One row per input row: ``row`` (its number), ``doc_id``, ``text_sha256``, ``name``.

    Rows have the same name exactly when their normalised texts are equal. A null text is empty;
    null or repeated ids do no harm, as rows are told apart by ``row``.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), normal_text(text_col).alias("normal"))
    seed, names = _block_names(texts, block_bytes, make)
    keys = F.transform(_blocks(F.col("normal"), block_bytes), lambda block: make(block, seed))
    rows = kept(
        texts.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            F.sha2(F.col("normal").cast("binary"), 256).alias("text_sha256"),
            keys.alias("keys"),
        ),
        "rows",
    )
    levels = (rows.agg(F.max(F.size("keys"))).first()[0] or 1) - 1
    places = rows.select("row", F.size("keys").alias("width"), F.posexplode("keys").alias("place", "key"))
    current = kept(places.select("row", "width", "place", "key.*").join(names, ["a", "b"]).select("row", "width", "place", "name"), "level-0")
    done = [current.where("width = 1").select("row", "name")]
    for level in range(1, levels.bit_length() + 1):
        pairs = (
            current.where("width > 1")
            .groupBy("row", "width", F.shiftright("place", 1).alias("place"))
            .agg(
                F.max(F.when(F.col("place") % 2 == 0, F.col("name"))).alias("left"),
                F.max(F.when(F.col("place") % 2 == 1, F.col("name"))).alias("right"),
            )
        )
        pairs = kept(pairs, f"pairs-{level}")
        names = kept(_named(pairs.where("right is not null").select("left", "right"), level), f"names-{level}")
        # The last name of an odd number has no partner and goes up as it is.
        current = kept(
            pairs.join(names, ["left", "right"], "left").select(
                "row", F.shiftright(F.col("width") + 1, 1).alias("width"), "place", F.coalesce("name", "left").alias("name")
            ),
            f"level-{level}",
        )
        done.append(current.where("width = 1").select("row", "name"))
    whole = done[0]
    for part in done[1:]:
        whole = whole.unionByName(part)
    return rows.drop("keys").join(whole, "row")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES, make: Fingerprint = fingerprint) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256, identity.

    Of equal texts the row with the smallest id stays (a null id comes last; of repeated rows of one
    id, the first read). An empty table gives an empty result; other columns are not looked at.
    """
    names = kept(document_names(docs, id_col, text_col, block_bytes, make), "names")
    order = F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "row")
    groups = kept(names.groupBy("name").agg(F.min(order).alias("first"), F.count("*").alias("group_size")), "groups")
    return names.join(groups, "name").select(
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"),
        "text_sha256",
        F.col("name").alias("identity"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each text, all columns as they were."""
    stays = exact_dedup(docs, id_col, text_col).where("kept").select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"))
    keyed = whole_rows(docs, id_col, text_col).select("doc", "doc_id", F.sha2(normal_text("text").cast("binary"), 256).alias("sha"))
    found = keyed.join(stays, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("sha") == F.col("_sha")), "left_semi")
    # Rows repeated with their id: one of them.
    repeats = Window.partitionBy("doc_id", "sha").orderBy("sha")
    return found.withColumn("n", F.row_number().over(repeats)).where("n = 1").select("doc.*")


def op5_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents")).drop("identity")


# DuckDB: \s in its patterns has no vertical tab, so the class is spelled out.
ORACLE = r"""
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, sha256(normal) AS text_sha256
FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS normal FROM documents)
WINDOW same AS (PARTITION BY normal)
"""
