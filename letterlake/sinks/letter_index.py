"""A stored index of dead letters: which token stands where in which letter.

A posting is a token of a letter with its positions there. Postings lie in hash buckets of their tokens,
sorted by token and with bloom filters, and become visible with the commit of the batch whose letters they
index. A phrase is found by reading its tokens' buckets alone, and of those the row groups that admit the
tokens: a letter holds the phrase where the positions of its tokens, each shifted by the token's place in
the phrase, have one in common. No letter is tokenised again, and only the batches of the letters found
are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from letterlake.functions.sizes import broadcast_if_small
from letterlake.operators.decode import token_list
from letterlake.schemas import DEAD_LETTER
from letterlake.sinks.commits import FileSet, Snapshot, TableLog
from letterlake.sinks.tables import BATCH_KEY, read_batches

TABLE = "dead_letter_tokens"
BUCKETS = 64
LETTER = ("writer", "batch_id", "kafka_topic", "kafka_partition", "kafka_offset", "payload_hash")
SCHEMA = T.StructType(
    [
        T.StructField("token", T.StringType()),
        T.StructField("positions", T.ArrayType(T.IntegerType())),
        *BATCH_KEY,
        *[DEAD_LETTER[name] for name in LETTER[2:5]],
        T.StructField("payload_hash", T.LongType()),
        T.StructField("bucket", T.IntegerType()),
    ]
)
WRITE = {
    "parquet.bloom.filter.enabled#token": "true",
    "parquet.bloom.filter.adaptive.enabled": "true",
    "parquet.block.size": str(16 * 1024 * 1024),
}


def _bucket(token):
    return F.pmod(F.xxhash64(token), F.lit(BUCKETS)).cast("int")


def _identified(letters: DataFrame) -> DataFrame:
    # Coordinates of folders of text lines may repeat; the payload tells such letters apart.
    return letters.withColumn("payload_hash", F.xxhash64("raw_payload"))


def postings(letters: DataFrame) -> DataFrame:
    """One row per letter and distinct token. A letter without a payload or token has none."""
    token = F.posexplode(token_list(F.col("raw_payload"))).alias("position", "token")
    found = _identified(letters).select(*LETTER, token)
    # A letter's tokens are counted where they stand, in the map tasks; equal letters once.
    placed = found.groupBy("token", *LETTER).agg(F.sort_array(F.collect_set("position")).alias("positions"))
    return placed.withColumn("bucket", _bucket(F.col("token"))).select(*SCHEMA.fieldNames())


def _sorted(rows: DataFrame) -> DataFrame:
    return rows.hint("rebalance", "bucket").sortWithinPartitions("bucket", "token")


def record(log: TableLog, letters: DataFrame, batch_id: int, writer: str) -> FileSet:
    """Writes the postings of a batch of letters, to be committed with it."""
    batch = letters.withColumns({"writer": F.lit(writer), "batch_id": F.lit(batch_id).cast("bigint")})
    return log.write(_sorted(postings(batch)), TABLE, "bucket", **WRITE)


def compact(log: TableLog, fan: int) -> Snapshot:
    return log.compact(TABLE, SCHEMA, "bucket", _sorted, fan, **WRITE)


def holders(log: TableLog, phrase: str) -> DataFrame:
    """The letters (``LETTER``) that hold the phrase's tokens one after the other.

    Nothing for a phrase without tokens.
    """
    spark = log.spark
    wanted = spark.range(1).select(F.posexplode(token_list(F.lit(phrase))).alias("place", "token"))
    places = wanted.withColumn("bucket", _bucket(F.col("token"))).collect()  # as long as the phrase
    tokens = sorted({row.token for row in places})
    buckets = sorted({f"bucket={row.bucket}" for row in places})
    rows = log.read(log.snapshot(), TABLE, SCHEMA, buckets).where(F.col("token").isin(tokens))
    if not places:
        return rows.select(*LETTER)
    # The places of a token in the phrase, then where the phrase would start for each.
    of_token = {token: [row.place for row in places if row.token == token] for token in tokens}
    known = F.create_map(*[x for token, at in of_token.items() for x in (F.lit(token), F.array(*map(F.lit, at)))])
    starts = F.transform(known[F.col("token")], lambda place: F.transform("positions", lambda position: position - place))
    everywhere = F.reduce(starts, starts[0], F.array_intersect)
    # Equal letters have equal postings; those of one letter are as many as the phrase has tokens.
    per_letter = rows.select(*LETTER, "token", everywhere.alias("starts")).where(F.size("starts") > 0)
    lists = F.collect_set(F.struct("token", "starts"))
    met = per_letter.groupBy(*LETTER).agg(lists.alias("lists")).where(F.size("lists") == len(tokens))
    common = F.reduce("lists", F.col("lists")[0]["starts"], lambda kept, one: F.array_intersect(kept, one["starts"]))
    return met.where(F.size(common) > 0).select(*LETTER)


def search(spark: SparkSession, root: str, phrase: str) -> DataFrame:
    """The stored dead letters that hold the phrase; equal to ``search_dead_letters`` over all of them."""
    found = holders(TableLog(spark, root), phrase).persist()
    letters = _identified(read_batches(spark, f"{root}/dead_letters", DEAD_LETTER))
    same = [F.col(f"letter.{name}").eqNullSafe(F.col(f"found.{name}")) for name in LETTER[2:]]
    batch = [F.col(f"letter.{name}") == F.col(f"found.{name}") for name in LETTER[:2]]
    kept = letters.alias("letter").join(broadcast_if_small(found).alias("found"), [*batch, *same], "left_semi")
    return kept.select(*DEAD_LETTER.fieldNames())
