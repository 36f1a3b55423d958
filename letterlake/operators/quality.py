"""Data-quality checks: failing-row counts per relation, freshness, and a gate."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from letterlake.functions.clock import duration, instant


@dataclass(frozen=True)
class Checks:
    """Declared expectations of one relation."""

    not_null: tuple[str, ...] = ()
    not_empty: tuple[str, ...] = ()
    non_negative: tuple[str, ...] = ()
    between_zero_and_one: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    unique_combination: tuple[tuple[str, ...], ...] = ()


# The expectations declared for sources and marts.
SOURCE_CHECKS = {
    "landing_events": Checks(
        not_null=("event_id", "tenant_id", "event_type", "event_ts"),
        not_empty=("tenant_id", "event_type"),
        unique_combination=(("event_id",),),
    ),
    "dim_customer_tenant": Checks(
        not_null=("tenant_id",), not_empty=("tenant_id",), unique=("tenant_id",)
    ),
    "dim_customer_event_type": Checks(
        not_null=("event_type",), not_empty=("event_type",), unique=("event_type",)
    ),
    "fct_daily_customer_delivery": Checks(
        not_null=("tenant_id", "event_date"),
        non_negative=("delivered_count", "opened_count", "clicked_count"),
        unique_combination=(("tenant_id", "event_date"),),
    ),
}

MART_CHECKS = {
    "customer_delivery_summary": Checks(
        not_null=("tenant_id", "event_date"),
        non_negative=("tenant_lifetime_events",),
        between_zero_and_one=("open_rate", "click_through_rate", "delivery_success_rate"),
    ),
    "customer_tenant": Checks(not_null=("tenant_id",), unique=("tenant_id",)),
    "event_type": Checks(not_null=("event_type",), unique=("event_type",)),
    "campaign_performance": Checks(
        not_null=("tenant_id", "campaign_id", "event_date"),
        non_negative=("requested_count", "delivered_count"),
        between_zero_and_one=("open_rate", "click_through_rate"),
        unique_combination=(("tenant_id", "campaign_id", "event_date"),),
    ),
    "template_performance": Checks(
        not_null=("tenant_id", "template_id", "event_date"),
        non_negative=("requested_count", "delivered_count"),
        between_zero_and_one=("open_rate", "click_through_rate"),
        unique_combination=(("tenant_id", "template_id", "event_date"),),
    ),
    "internal_mail_tracking": Checks(
        not_null=("message_id", "latest_event_type", "latest_event_time"), unique=("message_id",)
    ),
    "dim_tenant": Checks(not_null=("tenant_id",), unique=("tenant_id",)),
    "dim_provider": Checks(not_null=("provider_id",), unique=("provider_id",)),
    "fct_mail_lifecycle": Checks(
        not_null=("event_id", "event_type", "message_id", "correlation_id"), unique=("event_id",)
    ),
}


@dataclass(frozen=True)
class Freshness:
    loaded_at: str
    warn_after: str
    error_after: str


# Allowed age of the newest row.
FRESHNESS = {
    "landing_events": Freshness("event_ts", "2h", "6h"),
    "dim_customer_tenant": Freshness("last_seen_at", "6h", "24h"),
    "dim_customer_event_type": Freshness("last_seen_at", "6h", "24h"),
    "fct_daily_customer_delivery": Freshness("event_date", "1d", "2d"),
}


def not_null(column: str) -> Column:
    return F.col(column).isNull()


def not_empty(column: str) -> Column:
    return F.trim(F.col(column)) == ""


def non_negative(column: str) -> Column:
    return F.col(column) < 0


def between_zero_and_one(column: str) -> Column:
    return (F.col(column) < 0) | (F.col(column) > 1)


ROW_CHECKS = {
    "not_null": not_null,
    "not_empty": not_empty,
    "non_negative": non_negative,
    "between_zero_and_one": between_zero_and_one,
}


def failing_rows(df: DataFrame, check: str, column: str) -> DataFrame:
    """The rows that break a row check, for inspection."""
    return df.where(ROW_CHECKS[check](column))


def row_failures(df: DataFrame, relation: str, checks: list[tuple[str, str]]) -> DataFrame:
    """Failure counts of all row checks in one pass over the relation."""
    counts = [
        F.count_if(ROW_CHECKS[check](column)).alias(f"n{i}") for i, (check, column) in enumerate(checks)
    ]
    results = [
        F.struct(
            F.lit(check).alias("check"),
            F.lit(relation).alias("relation"),
            F.lit(column).alias("column"),
            F.col(f"n{i}").alias("failures"),
        )
        for i, (check, column) in enumerate(checks)
    ]
    return df.agg(*counts).select(F.inline(F.array(*results)))


def duplicate_keys(df: DataFrame, columns: tuple[str, ...], nulls_count: bool) -> DataFrame:
    """Key values held by more than one row; NULL is a value only where ``nulls_count`` is set."""
    rows = df
    if not nulls_count:
        for column in columns:
            rows = rows.where(F.col(column).isNotNull())
    return rows.groupBy(*columns).agg(F.count("*").alias("rows")).where(F.col("rows") > 1)


def key_failures(df: DataFrame, relation: str, columns: tuple[str, ...], combination: bool) -> DataFrame:
    """Number of duplicated key values."""
    return duplicate_keys(df, columns, nulls_count=combination).agg(
        F.lit("unique_combination" if combination else "unique").alias("check"),
        F.lit(relation).alias("relation"),
        F.lit(", ".join(columns)).alias("column"),
        F.count("*").alias("failures"),
    )


def run_checks(df: DataFrame, relation: str, checks: Checks) -> DataFrame:
    """check, relation, column, failures for every expectation of the relation."""
    per_row = [
        (name, column) for name in ROW_CHECKS for column in getattr(checks, name)
    ]
    results = [row_failures(df, relation, per_row)] if per_row else []
    results += [key_failures(df, relation, (column,), False) for column in checks.unique]
    results += [key_failures(df, relation, columns, True) for columns in checks.unique_combination]
    report = results[0]
    for result in results[1:]:
        report = report.unionByName(result)
    return report


def freshness(df: DataFrame, relation: str, rule: Freshness, now: str) -> DataFrame:
    """pass, warn or error by the age of the newest row; an empty relation is an error."""
    newest = F.max(F.col(rule.loaded_at).cast("timestamp_ntz"))
    age = F.unix_seconds(instant(now).cast("timestamp")) - F.unix_seconds(
        F.col("newest").cast("timestamp")
    )
    warn, error = (int(duration(text).total_seconds()) for text in (rule.warn_after, rule.error_after))
    status = (
        F.when(F.col("newest").isNull() | (age > error), F.lit("error"))
        .when(age > warn, F.lit("warn"))
        .otherwise(F.lit("pass"))
    )
    return df.agg(newest.alias("newest")).select(
        F.lit(relation).alias("relation"), "newest", age.alias("age_seconds"), status.alias("status")
    )


class QualityError(RuntimeError):
    """A checked relation has failing rows."""


def require(relations: Mapping[str, DataFrame], suite: Mapping[str, Checks]) -> None:
    """Raises when any check fails; what depends on these relations is then not built."""
    failed = []
    for name, df in relations.items():
        if name in suite:
            # One row per declared check.
            report = run_checks(df, name, suite[name]).where(F.col("failures") > 0).collect()
            failed += [f"{r['relation']}.{r['column']} {r['check']}: {r['failures']}" for r in report]
    if failed:
        raise QualityError("; ".join(sorted(failed)))
