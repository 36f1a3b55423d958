"""The semantic layer as a graph of stored relations: landing table and records in, marts out."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from letterlake.operators import activity, latest, quality
from letterlake.operators.staging import stage_events
from letterlake.plans import graph, marts
from letterlake.plans.graph import Relation, Source
from letterlake.sinks.commits import TableLog
from letterlake.sources.lakehouse import (
    DIM_CUSTOMER_EVENT_TYPE,
    DIM_CUSTOMER_TENANT,
    FCT_DAILY_CUSTOMER_DELIVERY,
    LANDING_EVENTS,
)

ROLLUP = "activity_rollup"
CHECKS = quality.SOURCE_CHECKS | quality.MART_CHECKS


def rollup_of(landing: DataFrame) -> DataFrame:
    """The one pass over the landing table that everything below builds on."""
    return activity.activity_rollup(stage_events(landing))


def _summary(fact: DataFrame, tenants: DataFrame) -> DataFrame:
    return marts.customer_delivery_summary(marts.delivery_daily_metrics(fact, tenants))


def _campaigns(rollup: DataFrame) -> DataFrame:
    return marts.campaign_performance(activity.campaign_daily_metrics(rollup), activity.campaign_dimension(rollup))


def _templates(rollup: DataFrame) -> DataFrame:
    return marts.template_performance(activity.template_daily_metrics(rollup), activity.template_dimension(rollup))


SOURCES_LAYER, CORE_LAYER, MART_LAYER = range(3)
DIMENSIONS = (DIM_CUSTOMER_TENANT, DIM_CUSTOMER_EVENT_TYPE)
RELATIONS = (
    Relation(ROLLUP, SOURCES_LAYER, (LANDING_EVENTS,), rollup_of),
    Relation(DIM_CUSTOMER_TENANT, CORE_LAYER, (ROLLUP,), activity.tenant_dimension),
    Relation(DIM_CUSTOMER_EVENT_TYPE, CORE_LAYER, (ROLLUP,), activity.event_type_dimension),
    Relation(FCT_DAILY_CUSTOMER_DELIVERY, CORE_LAYER, (ROLLUP,), activity.daily_delivery_fact),
    Relation("fct_mail_lifecycle", CORE_LAYER, ("lifecycle_records", "operational_records"), marts.fct_mail_lifecycle),
    Relation("customer_delivery_summary", MART_LAYER, (FCT_DAILY_CUSTOMER_DELIVERY, DIM_CUSTOMER_TENANT), _summary),
    Relation("customer_tenant", MART_LAYER, (DIM_CUSTOMER_TENANT,), marts.customer_tenant),
    Relation("event_type", MART_LAYER, (DIM_CUSTOMER_EVENT_TYPE,), marts.event_type),
    Relation("reporting_dimensions", MART_LAYER, DIMENSIONS, marts.reporting_dimensions),
    Relation("campaign_performance", MART_LAYER, (ROLLUP,), _campaigns),
    Relation("template_performance", MART_LAYER, (ROLLUP,), _templates),
    Relation("internal_mail_tracking", MART_LAYER, ("fct_mail_lifecycle",), latest.latest_per_message),
    Relation("dim_tenant", MART_LAYER, ("accounts", "orders"), marts.dim_tenant),
    Relation("dim_provider", MART_LAYER, ("suppliers", "nations", "regions"), marts.dim_provider),
)
MARTS = tuple(relation.name for relation in RELATIONS if relation.layer == MART_LAYER or relation.name == "fct_mail_lifecycle")
SOURCES = (LANDING_EVENTS, "lifecycle_records", "operational_records", "accounts", "orders", "suppliers", "nations", "regions")


def register_views(relations: dict[str, DataFrame]) -> None:
    """Makes relations queryable by name in SQL."""
    for name, df in relations.items():
        df.createOrReplaceTempView(name)


def checked(kind: str) -> list[str]:
    """The relations and sources with a check of this kind."""
    return [name for name, checks in CHECKS.items() if getattr(checks, kind)]


def observing(names: Iterable[str]) -> tuple[str, ...]:
    """The relations to build so that the checks of ``names`` are counted; a source's are by those that read it."""
    names = set(names)
    return tuple(relation.name for relation in RELATIONS if relation.name in names or names.intersection(relation.inputs).intersection(SOURCES))


def _buildable(sources: Mapping[str, Source], names: Iterable[str]) -> list[str]:
    """Those of the relations whose every source is given."""
    found = []
    for name in names:
        try:
            graph.in_order(RELATIONS, sources, [name])
        except KeyError:
            continue
        found.append(name)
    return found


def stored_layer(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The relations of the last build below ``root``, all of one version."""
    log = TableLog(spark, root)
    snapshot = log.snapshot()
    return {relation.name: graph.stored(log, snapshot, relation.name) for relation in RELATIONS if snapshot.sets(relation.name)}


def build_semantic_layer(
    spark: SparkSession,
    landing: DataFrame,
    root: str,
    *,
    more: Mapping[str, Callable[[], DataFrame]] | None = None,
    version: int | str = 0,
    gate: bool = False,
    only: tuple[str, ...] | None = None,
) -> dict[str, DataFrame]:
    """Writes the relations below ``root`` and returns the stored marts.

    The landing table is read and its payloads are parsed once, for the rollup. ``more`` gives the other
    ``SOURCES``; marts whose sources are not given are left out. With ``only`` the relations that it names,
    marts or not, are built and returned, and what they need is built. ``version`` is that of the sources: what is stored from the same one is not built
    again, and what is not affected by a new one neither. Readers of an earlier build are not disturbed.

    With ``gate`` the layers build in order and stop at the first failing check: no mart is written
    from sources that break their expectations.
    """
    given = {LANDING_EVENTS: lambda: landing, **(more or {})}
    sources = {name: Source(rows, str(version)) for name, rows in given.items()}
    wanted = _buildable(sources, MARTS if only is None else [relation.name for relation in RELATIONS if relation.name in only])
    log = TableLog(spark, root)
    snapshot = graph.build(log, RELATIONS, sources, CHECKS, wanted=wanted, gate=gate)
    return {name: graph.stored(log, snapshot, name) for name in wanted}
