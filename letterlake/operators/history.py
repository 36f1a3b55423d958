"""The course of single messages: their state at a moment, and the order of their stages.

Both compare an event with the one before it. A window per message would gather a very busy message
in one task, so events are compared inside blocks of a minute first; then the blocks of a message,
one row each, are compared among themselves. Events without a time are in no course: their place in it
is unknown. Events of one moment follow each other by arrival and id, as in the latest state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from letterlake.functions.text import is_blank
from letterlake.operators.lifecycle import LIFECYCLE_STAGES, classify

_PLACE = ("event_time", "ingested_at", "event_id")
_STATE = ("event_type", "latest_status", "failure_code")


def _minute(at: str) -> Column:
    return F.expr(f"timestampdiff(MINUTE, timestamp_ntz'1970-01-01 00:00:00', {at})")


def _placed(lifecycle: DataFrame) -> DataFrame:
    return lifecycle.where(~is_blank(F.col("message_id")) & F.col("event_time").isNotNull())


def state_as_of(lifecycle: DataFrame, questions: DataFrame) -> DataFrame:
    """The state of a message at a moment, for each row (``message_id``, ``as_of``) of ``questions``.

    The last event at or before the moment tells the state; ``state_since`` is its time. A question
    from before the first event, about an unknown message or without a moment has a null state.
    Repeated questions are answered each.
    """
    state = F.struct(*_PLACE, *_STATE)
    events = _placed(lifecycle).select("message_id", F.col("event_time").alias("at"), F.lit(False).alias("asked"), state.alias("state"))
    asked = questions.select("message_id", F.col("as_of").alias("at"), F.lit(True).alias("asked"))
    rows = events.unionByName(asked, allowMissingColumns=True).withColumn("block", _minute("at"))
    # An event at the very moment comes before the question.
    until = Window.partitionBy("message_id", "block").orderBy("at", "asked", "state.ingested_at", "state.event_id")
    inside = rows.withColumn("own", F.last("state", ignorenulls=True).over(until.rowsBetween(Window.unboundedPreceding, 0)))
    earlier = Window.partitionBy("message_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("message_id", "block").agg(F.max("state").alias("newest"))
    carried = blocks.select("message_id", "block", F.last("newest", ignorenulls=True).over(earlier).alias("carried"))
    found = inside.where("asked").join(carried, ["message_id", "block"], "left").withColumn("found", F.coalesce("own", "carried"))
    return found.select(
        "message_id",
        F.col("at").alias("as_of"),
        F.col("found.event_id").alias("event_id"),
        *[F.col(f"found.{name}").alias(name) for name in _STATE],
        F.col("found.event_time").alias("state_since"),
    )


def stage_steps(lifecycle: DataFrame) -> DataFrame:
    """How each message went through the numbered stages; events outside them are passed over.

    One row per message: ``path``, the stages in order of first entry; ``staged_events``; and how many
    steps from an event to the next went on by one stage (``forward``), over at least one stage
    (``skipped``), stayed (``repeated``) or went back (``backward``); ``never_entered``, the stages
    below the deepest one that the message was never in.
    """
    place = F.struct(*_PLACE)
    staged = classify(_placed(lifecycle)).where("lifecycle_stage is not null")
    staged = staged.select("message_id", F.col("lifecycle_stage").alias("stage"), *_PLACE).withColumn("block", _minute("event_time"))
    inside = Window.partitionBy("message_id", "block").orderBy(*_PLACE)
    across = Window.partitionBy("message_id").orderBy("block")
    events = staged.select("message_id", F.lag("stage").over(inside).alias("before"), "stage", place.alias("place"))
    blocks = staged.groupBy("message_id", "block").agg(F.min_by("stage", place).alias("entered"), F.max_by("stage", place).alias("left"))
    borders = blocks.select("message_id", F.lag("left").over(across).alias("before"), F.col("entered").alias("stage"))
    steps = events.unionByName(borders, allowMissingColumns=True)
    by = F.col("stage") - F.col("before")
    # At most one entry per stage, so the path is short however long the message's history.
    entries = {stage: F.min(F.when(F.col("stage") == stage, F.col("place"))) for stage in LIFECYCLE_STAGES}
    counted = steps.groupBy("message_id").agg(
        F.count("place").alias("staged_events"),
        F.count_if(by == 1).alias("forward"),
        F.count_if(by > 1).alias("skipped"),
        F.count_if(by == 0).alias("repeated"),
        F.count_if(by < 0).alias("backward"),
        F.max("stage").alias("deepest"),
        *[entry.alias(f"entry_{stage}") for stage, entry in entries.items()],
    )
    entered = F.array_sort(F.filter(F.array(*[F.struct(F.col(f"entry_{s}").alias("place"), F.lit(s).alias("stage")) for s in entries]), lambda x: x["place"].isNotNull()))
    path = F.array_join(F.transform(entered, lambda x: x["stage"].cast("string")), ">")
    return counted.select(
        "message_id",
        "staged_events",
        path.alias("path"),
        "forward",
        "skipped",
        "repeated",
        "backward",
        (F.col("deepest") - F.size(entered)).alias("never_entered"),
    )


def stage_violations(lifecycle: DataFrame) -> DataFrame:
    """Messages that left the order of stages: a step back, or one over a stage."""
    return stage_steps(lifecycle).where("skipped > 0 or backward > 0")
